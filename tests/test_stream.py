"""Streamed snapshots produce the same history as sequential batch merges; replays are no-ops."""

import os

from snapledger.operators import scd2
from snapledger.sources import publish
from snapledger.streaming import scd2_sink

RUNS = [("2024-01-01 00:00:00", [("a", 1), ("b", 2)]),
        ("2024-02-01 00:00:00", [("a", 1), ("b", 3), ("c", 4)]),
        ("2024-03-01 00:00:00", [("a", 5), ("c", 4)])]


def _snap(spark, rows):
    return scd2.with_hash(spark.createDataFrame(rows, "key string, v long"), key="key")


def test_stream_equals_batch(spark, tmp_path):
    man = str(tmp_path / "manifests")
    for i, (ts, rows) in enumerate(RUNS):
        path = str(tmp_path / "in" / f"run={i}")
        _snap(spark, rows).repartition(3).write.parquet(path)      # several files per snapshot
        scd2_sink.announce(spark, man, ts, path)
    root = str(tmp_path / "table")
    scd2_sink.run(spark, man, root, "key", str(tmp_path / "cp"), max_files_per_trigger=1)
    streamed, v = publish.checkout(spark, root)
    h = scd2.empty_history(_snap(spark, RUNS[0][1]))
    for ts, rows in RUNS:
        h = scd2.merge(h, _snap(spark, rows), ts, "key")
    cols = ["key", "v", "attr_hash", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, h.select(cols).collect()))
    # replaying every manifest (fresh checkpoint) changes nothing
    scd2_sink.run(spark, man, root, "key", str(tmp_path / "cp2"))
    assert publish.checkout(spark, root)[1] == v


def test_manifests_out_of_order(spark, tmp_path):
    """Announced newest first and handed out one by one: the history is that of the runs in order."""
    man, root = str(tmp_path / "manifests"), str(tmp_path / "table")
    for i, (ts, rows) in reversed(list(enumerate(RUNS))):
        path = str(tmp_path / "in" / f"run={i}")
        _snap(spark, rows).write.parquet(path)
        scd2_sink.announce(spark, man, ts, path)
    assert sorted(os.listdir(man))[0].startswith(".") or all(n.endswith(".json") for n in os.listdir(man) if n[0] not in "._")
    scd2_sink.run(spark, man, root, "key", str(tmp_path / "cp"), max_files_per_trigger=1)
    h = scd2.empty_history(_snap(spark, RUNS[0][1]))
    for ts, rows in RUNS:
        h = scd2.merge(h, _snap(spark, rows), ts, "key")
    cols = ["key", "v", "attr_hash", "valid_from", "valid_to", "is_current"]
    streamed = publish.checkout(spark, root)[0]
    assert sorted(map(tuple, streamed.select(cols).collect())) == sorted(map(tuple, h.select(cols).collect()))
    # a manifest that comes after a later run was merged is set aside, not lost, and does not stop the stream
    late, next_ = str(tmp_path / "in" / "late"), str(tmp_path / "in" / "next")
    _snap(spark, [("q", 1)]).write.parquet(late)
    scd2_sink.announce(spark, man, "2024-02-15 00:00:00", late)
    _snap(spark, [("a", 6)]).write.parquet(next_)
    scd2_sink.announce(spark, man, "2024-04-01 00:00:00", next_)
    for _ in range(2):                                                   # a restart meets it again
        scd2_sink.run(spark, man, root, "key", str(tmp_path / "cp"), max_files_per_trigger=1)
        assert [(r.run_ts, r.status) for r in scd2_sink.refused(spark, man).collect()] == [("2024-02-15 00:00:00", "refused")]
    last = publish.checkout(spark, root)[0].where("is_current").collect()
    assert [(r.key, r.v) for r in last] == [("a", 6)]
