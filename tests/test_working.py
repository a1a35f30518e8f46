"""Pull and push: each refusal, force, and the order of archive and artifact."""

import os

import pytest
from pyspark.sql import functions as F

from snapledger.operators import checks as ck
from snapledger.operators import scd2
from snapledger.sources import publish, working


def merged(spark, hist, rows, ts):
    snap = scd2.with_hash(spark.createDataFrame(rows, "key string, v long"), key="key")
    return scd2.merge(scd2.empty_history(snap) if hist is None else hist, snap, ts, "key")


def values(df):
    return sorted((r.key, r.v, r.is_current) for r in df.collect())


def test_push_and_pull(spark, tmp_path):
    a, b, archive, art = (str(tmp_path / n) for n in ("a", "b", "archive", "artifact"))
    with pytest.raises(FileNotFoundError):
        working.push(spark, a, archive, art, "key")
    assert working.pull(spark, archive, a) is None and working.history(spark, a) is None
    working.replace(spark, a, merged(spark, None, [("x", 1), ("y", 2)], "2024-01-01 00:00:00"))
    assert working.push(spark, a, archive, art, "key") == 0 and working.lineage(spark, a) == 0       # created
    assert working.pull(spark, archive, b) == 0 and working.lineage(spark, b) == 0
    # b goes on and publishes; a is stale then and refused, also after its own work
    working.replace(spark, b, merged(spark, working.history(spark, b), [("x", 5)], "2024-02-01 00:00:00"))
    assert working.push(spark, b, archive, art, "key") == 1
    full = [("x", 1, False), ("x", 5, True), ("y", 2, False)]
    assert values(publish.checkout(spark, archive)[0]) == full
    working.replace(spark, a, merged(spark, working.history(spark, a), [("x", 9)], "2024-02-02 00:00:00"))
    with pytest.raises(publish.StaleBaseline):
        working.push(spark, a, archive, art, "key")
    assert publish.latest_version(spark, archive) == 1 and sorted(os.listdir(art)) == ["0", "1"]
    assert working.push(spark, a, archive, art, "key", force=True) == 2                                 # force overwrites
    assert (("x", 9, True) in values(publish.checkout(spark, archive)[0])) and working.lineage(spark, a) == 2
    assert [tuple(r) for r in spark.read.parquet(f"{art}/2").select("key", "v").collect()] == [("x", 9)]
    assert "attr_hash" not in spark.read.parquet(f"{art}/2").columns


def test_a_copy_born_here_is_not_overwritten(spark, tmp_path):
    a, b, archive, art = (str(tmp_path / n) for n in ("a", "b", "archive", "artifact"))
    for w, v in ((a, 1), (b, 2)):
        working.replace(spark, w, merged(spark, None, [("x", v)], "2024-01-01 00:00:00"))
    assert working.push(spark, a, archive, art, "key") == 0
    with pytest.raises(working.LocalCopy):
        working.pull(spark, archive, b)
    with pytest.raises(publish.StaleBaseline):                     # nor does it overwrite what is there
        working.push(spark, b, archive, art, "key")
    assert values(working.history(spark, b)) == [("x", 2, True)]
    assert working.pull(spark, archive, b, force=True) == 0 and values(working.history(spark, b)) == [("x", 1, True)]


def test_checks_stand_before_the_archive(spark, tmp_path):
    a, archive, art = (str(tmp_path / n) for n in ("a", "archive", "artifact"))
    working.replace(spark, a, merged(spark, None, [("x", -1)], "2024-01-01 00:00:00"))
    bad = [ck.row("positive", "current", F.col("v") < 0), ck.row("warned", "current", F.col("v") < 0, severity="warn")]
    with pytest.raises(ck.ChecksFailed):
        working.push(spark, a, archive, art, "key", bad)
    assert publish.latest_version(spark, archive) is None and not os.path.exists(art)
    assert working.push(spark, a, archive, art, "key", bad[1:]) == 0 and working.push(spark, a, archive, art, "key", bad, force=True) == 1
