"""Property tests: random snapshot sequences, random names, random values."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapledger.functions.text import clean_owner_name
from snapledger.operators import checks as ck
from snapledger.operators import scd2, stats

KEYS = ["a", "b", "c", "d", "e"]
# a snapshot: for each key either absent or a small value
snapshot = st.dictionaries(st.sampled_from(KEYS), st.integers(0, 2), max_size=5)
RUN_TIMES = ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def _snap(spark, d):
    df = spark.createDataFrame(sorted(d.items()), "key string, v long")
    return scd2.with_hash(df, key="key")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(snapshot, min_size=1, max_size=4))
def test_merge_invariants_and_backfill(spark, snaps):
    snaps = [s for s in snaps]
    h = scd2.empty_history(_snap(spark, {"a": 0}))
    stacked = None
    for i, (s, t) in enumerate(zip(snaps, RUN_TIMES), start=1):
        sd = _snap(spark, s)
        h = scd2.merge(h, sd, t, "key")
        part = sd.withColumn("seq", F.lit(i)).withColumn("run_ts", F.lit(t).cast("timestamp_ntz"))
        stacked = part if stacked is None else stacked.unionByName(part)
    rows = h.collect()
    # invariants
    res = {r.name: r.violations for r in ck.run_all({"h": h}, [
        ck.unique("one_current", "h", ["key"], where=F.col("is_current")),
        ck.intervals_disjoint("disjoint", "h", ["key"]),
        ck.row("ordered", "h", F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))),
        ck.row("current_iff_open", "h", F.col("is_current") != F.col("valid_to").isNull()),
    ]).collect()}
    assert res == {"one_current": 0, "disjoint": 0, "ordered": 0, "current_iff_open": 0}
    # current rows are exactly the last snapshot
    assert sorted((r.key, r.v) for r in rows if r.is_current) == sorted(snaps[-1].items())
    # the one-pass backfill equals the sequential merges
    b = scd2.history_from_snapshots(stacked, "key", "seq", RUN_TIMES[:len(snaps)], ts_col="run_ts")
    cols = ["key", "v", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, b.select(cols).collect())) == sorted(map(tuple, h.select(cols).collect()))
    # merging the last snapshot again changes nothing
    again = scd2.merge(h, _snap(spark, snaps[-1]), "2025-01-01 00:00:00", "key")
    assert again.count() == len(rows)


names = st.text(alphabet=list("ABC %&/\\:0123456789O"), max_size=40)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(names, min_size=50, max_size=200))
def test_cleaner_idempotent_and_no_double_space(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n string")
    c = clean_owner_name(F.col("n"))
    bad = df.filter((clean_owner_name(c) != c) | c.contains("  ")).count()
    assert bad == 0


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.floats(0, 1e6)), min_size=1, max_size=300))
def test_histogram_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    h = stats.share_histogram(df, "g", stats.linear_bin(F.col("v"), 1000, 20000))
    tot = {r.area: (r.s, r.n) for r in h.groupBy("area").agg(F.sum("share").alias("s"), F.sum("n").alias("n")).collect()}
    for g, (s, n) in tot.items():
        assert abs(s - 1.0) < 1e-9
        assert n == sum(1 for r in rows if r[0] == g)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e6, 1e6))), max_size=40))
def test_exact_median(spark, rows):
    import statistics

    from snapledger.operators import stats
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    want = {g: statistics.median([float(v) for k, v in rows if k == g and v is not None])
            for g in {k for k, v in rows if v is not None}}
    got = {r.g: r.m for r in stats.exact_median(df, "g", "v", "m", most=3).collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - want[g]) <= 1e-9 * max(1, abs(want[g])) for g in want)


def test_exact_medians_of_any_distribution(spark):
    """An outlier, infinities, whole numbers beyond 2^53, decimals and a hot value, narrowed in several rounds."""
    import random
    import statistics
    from decimal import Decimal

    from snapledger.operators import stats
    rnd = random.Random(1)
    rows = [("outlier", float(i % 997), 2 ** 60 + i, Decimal(i)) for i in range(2000)] + [("outlier", 1e300, 1, None)]
    rows += [("inf", x, None, None) for x in [float("-inf")] * 3 + [float(i) for i in range(500)] + [float("inf")] * 4]
    rows += [("hot", 7.0 if rnd.random() < 0.7 else rnd.random() * 1e9, rnd.randrange(-5, 5), Decimal(rnd.randrange(9))) for _ in range(1500)]
    rows += [(None, float(i) ** 3, 5, None) for i in range(301)] + [("none", None, None, None)]
    df = spark.createDataFrame(rows, "g string, v double, w long, x decimal(20,0)").repartition(5)
    got = {r.g: r for r in stats.exact_medians(df, "g", {"v_m": "v", "w_m": "w", "x_m": "x"}, most=40).collect()}
    assert got.keys() == {"outlier", "inf", "hot", None}
    for g, r in got.items():
        for name, at in (("v_m", 1), ("w_m", 2), ("x_m", 3)):
            there = [x[at] for x in rows if x[0] == g and x[at] is not None]
            want = float(statistics.median_low(there)) / 2 + float(statistics.median_high(there)) / 2 if there else None
            assert r[name] == want, (g, name, r[name], want)
