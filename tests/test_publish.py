"""Versioned publish: exclusive pointer creation, stale baselines, idempotent merges, rollback."""

import json
import os

import pytest
from pyspark.sql import functions as F

from snapledger.operators import scd2
from snapledger.operators.gates import GateError
from snapledger.sources import publish, store


def snap(spark, rows):
    df = spark.createDataFrame(rows, "key string, v long")
    return scd2.with_hash(df, key="key")


def test_merge_commit_checkout_and_noop(spark, tmp_path):
    root = str(tmp_path / "tbl")
    v0, ch0 = publish.merge_and_commit(spark, root, snap(spark, [("a", 1), ("b", 2)]), "2024-01-01 00:00:00", "key")
    v1, ch1 = publish.merge_and_commit(spark, root, snap(spark, [("a", 1), ("b", 3), ("c", 4)]), "2024-02-01 00:00:00", "key")
    v2, ch2 = publish.merge_and_commit(spark, root, snap(spark, [("a", 1), ("b", 3), ("c", 4)]), "2024-03-01 00:00:00", "key")
    assert (v0, v1, v2) == (0, 1, 2) and ch0 and ch1 and not ch2
    hist, v = publish.checkout(spark, root)
    assert v == 2 and hist.count() == 4 and hist.filter("is_current").count() == 3
    # a run that changes nothing writes a pointer, no data
    assert publish.read_pointer(spark, root, 2)["open"] == publish.read_pointer(spark, root, 1)["open"]
    assert len(os.listdir(f"{root}/data")) == 2
    # replaying an already-applied run commits nothing, in any spelling of its time
    again = snap(spark, [("c", 4), ("b", 3), ("a", 1)])
    assert publish.merge_and_commit(spark, root, again, "2024-02-01 00:00:00", "key") == (2, False)
    assert publish.merge_and_commit(spark, root, again, "2024-2-1 00:00:00", "key") == (2, False)
    # the same time with other rows, or a run before the last one, is never dropped in silence
    for ts in ("2024-02-01 00:00:00", "2024-02-15 00:00:00", "2023-12-31 00:00:00"):
        with pytest.raises(GateError):
            publish.merge_and_commit(spark, root, snap(spark, [("z", 9)]), ts, "key")
    # only open rows were rewritten: the closed part is its own directory
    ptr = publish.read_pointer(spark, root, 1)
    assert len(ptr["closed"]) == 1 and publish.read_version(spark, root, 1, "closed").count() == 1


def test_merge_touches_only_buckets_that_changed(spark, tmp_path):
    """Folders of buckets without a changed key stay as they are; history is that of plain merges, also when all keys go."""
    root = str(tmp_path / "buckets")
    rows = [(f"k{i}", i) for i in range(200)]
    runs = [rows, [(k, v + (k == "k7")) for k, v in rows if k != "k9"] + [("new", 1)], rows[:3], [], rows[:2]]
    plain = scd2.empty_history(snap(spark, rows))
    for i, r in enumerate(runs):
        s, ts = snap(spark, r or rows).where("true" if r else "false"), f"2024-0{i + 1}-01 00:00:00"
        publish.merge_and_commit(spark, root, s, ts, "key", buckets=16)
        plain = scd2.merge(plain, s, ts, "key")
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        cols = ["key", "v", "valid_from", "valid_to", "is_current"]
        got = publish.checkout(spark, root)[0]
        assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, plain.select(cols).collect()), key=str)
    one, two = (publish.read_pointer(spark, root, v)["open"] for v in (0, 1))
    touched = {str(r["b"]) for r in spark.createDataFrame([("k7",), ("k9",), ("new",)], "key string").select(publish.bucket_of("key", 16).alias("b")).collect()}
    assert len(one) == 16 and {b for b in one if two.get(b) != one[b]} == touched and len(touched) == 3
    written = {d for _, ds, _ in os.walk(f"{root}/{next(iter(two[b] for b in touched)).split('/_open')[0]}/_open=true") for d in ds}
    assert written == {f"_bucket={b}" for b in touched}
    assert publish.read_pointer(spark, root, 3)["open"].keys() == {"none"} and publish.archive_bytes(spark, root) > 0


def test_run_times_are_utc():
    assert publish.canonical_ts("2024-01-01T00:00:00+09:00") == "2023-12-31 15:00:00"
    assert publish.canonical_ts("2024-01-01T00:00:00+00:00") == publish.canonical_ts("2024-01-01 00:00:00") == "2024-01-01 00:00:00"


def test_concurrent_writers_one_wins(spark, tmp_path):
    root = str(tmp_path / "race")
    s = snap(spark, [("a", 1)])
    open_rows, _ = scd2.merge_parts(scd2.empty_history(s), s, "2024-01-01 00:00:00", "key")
    assert publish.commit_version(spark, root, open_rows, None, None) == 0
    # two writers from baseline 0: both write data, only the first pointer creation succeeds
    pointer = json.dumps(publish.read_pointer(spark, root, 0))
    assert publish.create_whole(spark, f"{root}/commits/1.json", pointer)
    assert not publish.create_whole(spark, f"{root}/commits/1.json", pointer)
    with pytest.raises(publish.StaleBaseline):
        publish.commit_version(spark, root, open_rows, None, 0)
    with pytest.raises(publish.StaleBaseline):       # lost at the pointer: its own data goes
        publish._publish_pointer(spark, root, publish._write_versions(s.withColumn("is_current", F.lit(True)), root, None), json.loads(pointer), 0, None)
    assert len(os.listdir(f"{root}/data")) == 1
    assert [f for f in os.listdir(f"{root}/commits") if f.endswith(".tmp")] == []


def test_truncated_pointer_does_not_brick_the_table(spark, tmp_path):
    root = str(tmp_path / "crash")
    publish.merge_and_commit(spark, root, snap(spark, [("a", 1)]), "2024-01-01 00:00:00", "key")
    for text in ("", '{"open": "da'):
        with open(f"{root}/commits/1.json", "w") as f:
            f.write(text)
        assert publish.latest_version(spark, root) == 0
    (tmp_path / "crash" / "commits" / "_2.json.abc.tmp").write_text("{")
    assert publish.merge_and_commit(spark, root, snap(spark, [("a", 2)]), "2024-02-01 00:00:00", "key") == (1, True)
    assert publish.checkout(spark, root)[0].count() == 2


def test_failed_write_keeps_previous_version(spark, tmp_path):
    root = str(tmp_path / "rollback")
    publish.merge_and_commit(spark, root, snap(spark, [("a", 1)]), "2024-01-01 00:00:00", "key")
    bad = snap(spark, [("a", 2)]).withColumn("v", F.when(F.col("v") == 2, F.raise_error("boom")).cast("long"))
    with pytest.raises(Exception):
        publish.merge_and_commit(spark, root, bad, "2024-02-01 00:00:00", "key")
    hist, v = publish.checkout(spark, root)
    assert v == 0 and hist.count() == 1


def test_open_history_bootstrap(spark, tmp_path):
    s = snap(spark, [("a", 1)])
    with pytest.raises(FileNotFoundError):
        store.open_history(spark, str(tmp_path / "none"), s.schema)
    h = store.open_history(spark, str(tmp_path / "none"), s.schema, create=True)
    assert h.count() == 0 and h.columns[-3:] == ["valid_from", "valid_to", "is_current"]


def test_ledger_roundtrip(spark, tmp_path):
    s = snap(spark, [("a", 1), ("b", 2)])
    counts = scd2.merge_counts(scd2.classify(s.limit(0), s, "key"))
    row = store.ledger_row(counts, store.run_id("2024-01-01 00:00:00"), "2024-01-01 00:00:00", "2024-01-01 01:00:00",
                           server_count=3)
    path = str(tmp_path / "ledger")
    store.record_run(row, path)
    r = store.read_ledger(spark, path).first()
    assert r.new_parcels == 2 and r.server_count == 3 and r.run_id.startswith("2024-01-01-") and len(r.run_id) == 19
    assert store.size_bytes(spark.read.parquet(path)) > 0


def test_artifact_sorted_and_slim(spark, tmp_path):
    from snapledger.operators import geo
    df = spark.createDataFrame([(k, -149.9 + k * 0.01, 61.2) for k in range(20)], "k long, lon double, lat double")
    cur = df.select("k", geo.square(F.col("lon"), F.col("lat")).alias("geom"), F.lit("h").alias("attr_hash"))
    art = publish.build_current_artifact(cur, "k")
    assert "attr_hash" not in art.columns and {"centroid_lon", "centroid_lat"} <= set(art.columns)
    path = str(tmp_path / "artifact")
    publish.write_artifact(art, path, "k")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == list(range(20))
    assert os.path.isdir(path)


def test_raw_directory_retired_only_after_commit(spark, tmp_path):
    raw = tmp_path / "raw" / "run1"
    raw.mkdir(parents=True)
    (raw / "page-00000.ndjson").write_text("{}\n")
    root = str(tmp_path / "tbl_raw")
    publish.merge_and_commit(spark, root, snap(spark, [("a", 1)]), "2024-01-01 00:00:00", "key",
                             raw_path=str(raw), keep_raw=False)
    assert not raw.exists()
    kept = tmp_path / "raw" / "run2"
    kept.mkdir()
    bad = snap(spark, [("a", 2)]).withColumn("v", F.when(F.col("v") == 2, F.raise_error("boom")).cast("long"))
    with pytest.raises(Exception):
        publish.merge_and_commit(spark, root, bad, "2024-02-01 00:00:00", "key", raw_path=str(kept), keep_raw=False)
    assert kept.exists()        # a failed run keeps its raw input
