"""End-to-end staging + SCD2 merge on synthetic snapshots (shared sequential state)."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapledger.operators import gates, scd2
from snapledger.plans import parcels

T1 = [{"id": "P1", "owner": "ALICE", "value": 100000},
      {"id": "P2", "owner": "BOB", "value": 200000, "parts": 2, "lon": -149.8},
      {"id": "P3", "owner": "CARO", "value": 300000, "lon": -149.7}]
T2 = [{"id": "P1", "owner": "DAVE", "value": 150000},
      {"id": "P2", "owner": "BOB", "value": 200000, "parts": 2, "lon": -149.8},
      {"id": "P4", "owner": "ERIN", "value": 400000, "lon": -149.6}]


def counts(cur, snap):
    r = scd2.merge_counts(scd2.classify(cur, snap, "parcel_id")).first()
    return [r.distinct_keys, r.new, r.changed, r.retired, r.unchanged]


def stage(spark, path):
    return parcels.stage_parcels(spark, path, as_of_year=2026)


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    from tests.conftest import feature_lines
    root = tmp_path_factory.mktemp("merge")
    paths = {}
    for name, ps in (("t1", T1), ("t2", T2)):
        d = root / name
        d.mkdir()
        (d / "page-00000.ndjson").write_text(feature_lines(ps))
        paths[name] = str(d)
    s1, s2 = stage(spark, paths["t1"]), stage(spark, paths["t2"])
    h0 = scd2.empty_history(s1)
    c1 = counts(scd2.current(h0).drop("valid_from"), s1)
    h1 = scd2.merge(h0, s1, "2024-07-01 00:00:00", "parcel_id").cache()
    c2 = counts(scd2.current(h1).drop("valid_from"), s2)
    h2 = scd2.merge(h1, s2, "2026-07-01 00:00:00", "parcel_id").cache()
    c3 = counts(scd2.current(h2).drop("valid_from"), s2)
    h3 = scd2.merge(h2, s2, "2026-07-02 00:00:00", "parcel_id").cache()
    return dict(c1=c1, c2=c2, c3=c3, h1=h1, h2=h2, h3=h3, s1=s1, s2=s2)


def test_t1_all_new(runs):
    assert runs["c1"] == [3, 3, 0, 0, 0]


def test_t2_each_kind_once(runs):
    assert runs["c2"] == [3, 1, 1, 1, 1]
    h = runs["h2"]
    assert h.count() == 5
    assert h.filter("is_current").count() == 3


def test_t3_remerge_is_noop(runs):
    assert runs["c3"] == [3, 0, 0, 0, 3]
    assert runs["h3"].count() == 5
    assert sorted(map(tuple, runs["h3"].collect())) == sorted(map(tuple, runs["h2"].collect()))


@pytest.mark.parametrize("t,key,owner", [("2025-01-01 00:00:00", "P1", "ALICE"),
                                          ("2026-07-02 00:00:00", "P1", "DAVE"),
                                          ("2025-01-01 00:00:00", "P3", "CARO"),
                                          ("2026-07-02 00:00:00", "P3", None)])
def test_as_of(runs, t, key, owner):
    rows = scd2.as_of(runs["h2"], t).filter(F.col("parcel_id") == key).select("owner_name").collect()
    assert (rows[0][0] if rows else None) == owner


def test_multipart_parcel(runs):
    p2 = runs["s1"].filter("parcel_id = 'P2'").first()
    assert p2.feature_count == 2
    assert p2.area_m2 > 1000
    assert len(p2.geom) == 2


def test_golden_equal_area(runs):
    p1 = runs["s1"].filter("parcel_id = 'P1'").first()
    assert p1.area_m2 == pytest.approx(5991.288, abs=1e-3)


def test_volatile_not_hashed_and_epoch_cast(runs):
    p1 = runs["s1"].filter("parcel_id = 'P1'").first()
    assert p1.pubdate == dt.datetime(2026, 7, 1)


def test_unkeyed_dropped_and_counted(spark, write_snapshot):
    path = write_snapshot("unkeyed", T1, raw_lines=['{"Parcel_ID": "", "Owner_Name": "X"}', '{"Owner_Name": "Y"}'])
    obs = Observation("stage")
    snap = parcels.stage_parcels(spark, path, 2026, obs)
    assert snap.count() == 3
    assert obs.get["dropped_unkeyed"] == 2
    assert obs.get["source_features"] == 6


def test_first_value_skips_nulls(spark, write_snapshot):
    ps = [{"id": "Q1", "owner": None, "value": 5, "parts": 2, "extra_later": {"Owner_Name": "LATER"}}]
    snap = parcels.stage_parcels(spark, write_snapshot("nulls", ps), 2026)
    assert snap.first().owner_name == "LATER"


def test_reappearing_key_is_new_and_flagged(spark, write_snapshot):
    from snapledger.operators import checks as ck
    s1 = parcels.stage_parcels(spark, write_snapshot("a", T1), 2026)
    s2 = parcels.stage_parcels(spark, write_snapshot("b", [p for p in T1 if p["id"] != "P3"]), 2026)
    h = scd2.empty_history(s1)
    for s, t in ((s1, "2024-01-01 00:00:00"), (s2, "2025-01-01 00:00:00"), (s1, "2026-01-01 00:00:00")):
        h = scd2.merge(h, s, t, "parcel_id")
    p3 = h.filter("parcel_id = 'P3'").orderBy("valid_from").collect()
    assert len(p3) == 2 and p3[0].valid_to == dt.datetime(2025, 1, 1) and p3[1].valid_from == dt.datetime(2026, 1, 1)
    res = {r.name: r for r in ck.run_all({"history": h}, [
        ck.no_consecutive_duplicates("dup", "history", ["parcel_id"]),
        ck.intervals_disjoint("overlap", "history", ["parcel_id"])]).collect()}
    assert res["dup"].violations == 1 and res["dup"].status == "fail"
    assert res["overlap"].violations == 0


def test_repeated_run_time_rejected(runs):
    with pytest.raises(gates.GateError):
        gates.assert_ts_after(runs["h2"], "2026-07-01 00:00:00")
    gates.assert_ts_after(runs["h2"], "2026-07-03 00:00:00")


def test_backfill_equals_sequential_merges(runs):
    s1 = runs["s1"].withColumn("seq", F.lit(1)).withColumn("run_ts", F.lit("2024-07-01 00:00:00").cast("timestamp_ntz"))
    s2 = runs["s2"].withColumn("seq", F.lit(2)).withColumn("run_ts", F.lit("2026-07-01 00:00:00").cast("timestamp_ntz"))
    b = scd2.history_from_snapshots(s1.unionByName(s2), "parcel_id", "seq",
                                    ["2024-07-01 00:00:00", "2026-07-01 00:00:00"], ts_col="run_ts")
    cols = ["parcel_id", "attr_hash", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, b.select(cols).collect())) == sorted(map(tuple, runs["h2"].select(cols).collect()))


def test_shrink_and_completeness_gates():
    gates.assert_not_shrunk(100, 95)
    with pytest.raises(gates.GateError):
        gates.assert_not_shrunk(100, 94)
    gates.assert_not_shrunk(100, 10, allow_shrink=True)
    gates.assert_not_shrunk(0, 0)
    gates.assert_complete(99, 100)
    with pytest.raises(gates.GateError):
        gates.assert_complete(98, 100)


def test_change_feed(runs):
    ch = scd2.changes_between(runs["h2"], "parcel_id", ["owner_name", "appraised_total_value"]).collect()
    got = sorted((r.parcel_id, r.attribute, r.old_value, r.new_value) for r in ch)
    assert got == [("P1", "appraised_total_value", "100000.0", "150000.0"), ("P1", "owner_name", "ALICE", "DAVE")]
