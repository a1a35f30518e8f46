"""Centroid and validity by batches: as the expressions tell them; the audit's tables are written once each."""

import datetime as dt

from pyspark.sql import functions as F

from snapledger.operators import geo, rings
from snapledger.plans import audit_fixture, parcels

NAN = float("nan")


def ring(*corners):
    return [[list(map(float, c)) for c in (*corners, corners[0])]]


SQUARE = ring((-150, 61), (-149.9, 61), (-149.9, 61.1), (-150, 61.1))
STAR = ring((0, 3), (2, -3), (-3, 1), (3, 1), (-2, -3))                   # turns one way, but twice around
SHAPES = {
    "square": [SQUARE], "clockwise": [[SQUARE[0][::-1]]], "two": [SQUARE, ring((1, 1), (2, 1), (2, 3))],
    "hole": [ring((0, 0), (9, 0), (9, 9), (0, 9)) + ring((1, 1), (1, 2), (2, 2), (2, 1))], "hexagon": [ring((0, 0), (2, -1), (4, 0), (4, 2), (2, 3), (0, 2))],
    "concave": [ring((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))], "crossing": [ring((0, 0), (1, 1), (1, 0), (0, 0.5))], "star": [STAR],
    "flat": [ring((0, 0), (1, 0), (1, 0), (0, 0))], "short": [[[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]], "open": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]]]],
    "far": [ring((0, 0), (200, 0), (200, 5), (0, 5))], "nan": [ring((0, 0), (1, 0), (1, NAN), (0, 1))], "null": None, "nothing": [],
    "null number": [ring((0, 0), (1, 0), (1, 1), (0, 1)), [[[0.0, 0.0], [1.0, None], [1.0, 1.0], [0.0, 0.0]]]], "null ring": [[None]],
    "null point": [[[[0.0, 0.0], None, [1.0, 1.0], [0.0, 0.0]]]], "height": [[[[0.0, 0.0, 5.0], [1.0, 0.0, 5.0], [1.0, 1.0, 5.0], [0.0, 0.0, 5.0]]]],
}


def test_batches_tell_what_the_expressions_tell(spark):
    rows = spark.createDataFrame(list(SHAPES.items()), f"name string, geom {geo.MULTIPOLYGON}").coalesce(1)
    g, told = F.col("geom"), F.col("told")
    found = rows.withColumn("told", rings.told(g)).select(
        "name", "told", geo.centroid(g).alias("c"), rings.centroid(told, g).alias("c2"), geo.is_valid(g).alias("v"), rings.is_valid(told, g).alias("v2")).collect()
    by = {r.name: r for r in found}
    assert {n: (str(r.c), r.v) for n, r in by.items()} == {n: (str(r.c2), r.v2) for n, r in by.items()}
    assert {n for n, r in by.items() if not r.told or not r.told.plain} == {"null", "nothing", "null number", "null ring", "null point"}
    # only these are left to the expressions
    assert {n for n, r in by.items() if r.told and r.told.plain and r.told.valid is None} == {"concave", "crossing", "star"}
    assert by["hexagon"].v2 and by["hole"].v2 and by["concave"].v2 and not by["star"].v2 and not by["flat"].v2


def test_audit_writes_history_and_artifact_only(spark, tmp_path, monkeypatch):
    """The measured rows and the labels are views of the history; the rows that no merge writes come from one scan."""
    day = dt.datetime(1996, 1, 2)
    spark.createDataFrame([(k, k % 7, "OFP"[k % 3], 1000.0 + k, day, "1-URGENT") for k in range(300)], "o_orderkey long, o_custkey long, o_orderstatus string, "
                          "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(k, f"Customer {k}", k % 2, 10.0, "BUILDING") for k in range(7)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(0, "ALGERIA", 0), (1, "PERU", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(str(tmp_path / "nation.parquet"))
    written, cut = [], audit_fixture.cut_lineage
    monkeypatch.setattr(audit_fixture, "cut_lineage", lambda df, name: (written.append(name), cut(df, name))[1])
    tables = audit_fixture.tables(spark, str(tmp_path))
    assert written == ["audit-parcels", "audit-history", "audit-history", "audit-history", "audit-artifact"]
    runs = [dt.datetime.fromisoformat(t) for t in audit_fixture.RUNS]
    now = dt.datetime.fromisoformat(audit_fixture.AS_OF)
    rows = [tuple(r) for r in tables["history"].where("k in (1, 2, 3, 4, 5)").select("k", parcels.KEY, "valid_from", "valid_to", "is_current").collect()]
    days = lambda n: dt.timedelta(days=n)
    for ghost in ((1, "", runs[0], runs[1], False), (2, "2", runs[2] + days(1), None, True), (3, "3", runs[0] - days(10), runs[0] - days(11), False),
                  (4, "4", runs[0] - days(5), runs[0] - days(4), True), (5, "5", now + days(2), now + days(3), False)):
        assert rows.count(ghost) == 1, ghost
    measured = tables["current"].agg(F.count_if("geom_valid").alias("valid"), F.count(F.lit(1)).alias("n")).first()
    assert 0 < measured.valid < measured.n == tables["history"].where("is_current").count()
