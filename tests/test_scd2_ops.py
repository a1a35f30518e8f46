"""SCD2 operators on small frames: as-of joins by ranges equal plain ones; timeline; pages and numbers by ranges."""

from pyspark.sql import functions as F

from snapledger.operators import scd2


def _history(spark):
    rows = [("k1", "a", "2024-01-01", "2024-02-01", False), ("k1", "b", "2024-02-01", None, True),
            ("k2", "c", "2024-01-15", None, True)]
    return spark.createDataFrame(rows, "key string, attr_hash string, vf string, vt string, is_current boolean") \
        .select("key", "attr_hash", F.col("vf").cast("timestamp_ntz").alias("valid_from"),
                F.col("vt").cast("timestamp_ntz").alias("valid_to"), "is_current")


def test_sliced_as_of_join_equals_plain(spark):
    """A key with most facts, one with most versions, facts before, between and after versions, and without key or time."""
    h = [("hot", f"2024-01-{d:02d}", f"2024-01-{d + 1:02d}" if d < 20 else None) for d in range(1, 21) if d != 7]
    h += [(f"k{i}", "2024-01-05", "2024-01-10") for i in range(40)] + [("many", f"2023-{m:02d}-{d:02d}", f"2023-{m:02d}-{d + 1:02d}") for m in range(1, 13) for d in range(1, 27)]
    hist = spark.createDataFrame([(*r, f"h{n}", r[2] is None) for n, r in enumerate(h)], "key string, vf string, vt string, attr_hash string, is_current boolean").select(
        "key", F.col("vf").cast("timestamp_ntz").alias("valid_from"), F.col("vt").cast("timestamp_ntz").alias("valid_to"), "attr_hash", "is_current")
    f = [(i, "hot", f"2024-01-{i % 28 + 1:02d} {i % 24:02d}:00:00") for i in range(900)] + [(1000 + i, f"k{i % 50}", f"2024-01-{i % 15 + 1:02d}") for i in range(300)]
    f += [(2000 + i, "many", f"2023-{i % 12 + 1:02d}-{i % 28 + 1:02d}") for i in range(300)] + [(3000, None, "2024-01-05"), (3001, "hot", None), (3002, "hot", "2024-01-08"), (3002, "hot", "2024-01-08")]
    facts = spark.createDataFrame(f, "id int, fk string, at string").select("id", "fk", F.col("at").cast("timestamp_ntz").alias("ts"))
    for how in ("left", "inner"):
        plain, sliced = (sorted(map(tuple, scd2.as_of_join(facts, hist, "fk", "ts", "key", how, "v_", sliced=x).select("id", "ts", "v_attr_hash", "v_key").collect()), key=str)
                         for x in (False, True))
        assert plain == sliced and len(sliced) > 800
    # the same with many small ranges
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = scd2.as_of_join(facts, hist, "fk", "ts", "key", "inner", "v_", sliced=True).select("id", "ts", "v_attr_hash", "v_key")
        assert sorted(map(tuple, again.collect()), key=str) == plain
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pages_and_numbers_by_ranges(spark):
    from snapledger.operators import explore
    rows = [(i * 7 % 1000, f"r{i}") for i in range(1000)] + [(None, "none")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(6)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    starts = explore.page_starts(df, ["k", "v"], 25)
    for p in (0, 1, 17, 40):
        assert [tuple(r) for r in explore.page(df, ["k", "v"], p, 25, starts).collect()] == want[25 * p: 25 * p + 25]
    assert explore.page(df, ["k"], 41).count() == 0 and explore.page(df.where("false"), ["k"], 0).count() == 0
    assert [r["nth"] for r in explore.numbered(df, ["k"]).orderBy(F.asc_nulls_first("k")).collect()] == list(range(1001))
    plan = explore.page(df, ["k"], 3, 25, explore.page_starts(df, ["k"], 25))._jdf.queryExecution().toString()
    assert "GlobalLimit" not in plan and "Offset" not in plan


def test_timeline(spark):
    t = {(r.key, r.version_no): r.n_versions for r in scd2.timeline(_history(spark), "key").collect()}
    assert t == {("k1", 1): 2, ("k1", 2): 2, ("k2", 1): 1}
