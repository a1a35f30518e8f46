"""Geometry expressions against closed-form values."""

import pytest
from pyspark.sql import functions as F

from snapledger.operators import geo


@pytest.fixture(scope="module")
def sq(spark):
    return spark.createDataFrame([(-149.9, 61.2)], "lon double, lat double").select(
        geo.square(F.col("lon"), F.col("lat")).alias("g"))


def test_golden_area_centroid_bbox(sq):
    r = sq.select(geo.area_m2(F.col("g")).alias("a"), geo.centroid(F.col("g")).alias("c"),
                  geo.bbox(F.col("g")).alias("b")).first()
    assert r.a == pytest.approx(5991.2877, abs=1e-3)
    assert r.c.lon == pytest.approx(-149.8995) and r.c.lat == pytest.approx(61.2005)
    assert (r.b.xmin, r.b.ymin, r.b.xmax, r.b.ymax) == pytest.approx((-149.9, 61.2, -149.899, 61.201))


def test_hole_and_multipolygon(spark):
    outer = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]   # either orientation
    other = [[10.0, 0.0], [11.0, 0.0], [11.0, 1.0], [10.0, 1.0], [10.0, 0.0]]
    df = spark.createDataFrame([([[outer, hole], [other]],)], f"g {geo.MULTIPOLYGON}")
    r = df.select(geo.planar_area(F.col("g")).alias("a"), geo.centroid(F.col("g")).alias("c")).first()
    assert r.a == pytest.approx(16 - 1 + 1)
    # moments: 16*(2,2) - 1*(1.5,1.5) + 1*(10.5,0.5) over area 16
    assert r.c.lon == pytest.approx((32 - 1.5 + 10.5) / 16) and r.c.lat == pytest.approx((32 - 1.5 + 0.5) / 16)


def test_parse_geojson(spark):
    df = spark.createDataFrame([('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}',),
                                ('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]]]}',),
                                ('{"type":"Point","coordinates":[0,0]}',)], "t string")
    g = [r[0] for r in df.select(geo.parse_geojson(F.col("t"))).collect()]
    assert g[0] == g[1] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]] and g[2] is None


def test_validity(spark):
    bad = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.5, 0.5]]]]          # not closed
    thin = [[[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]]                       # too few points
    good = [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]
    df = spark.createDataFrame([(bad,), (thin,), (good,), (None,)], f"g {geo.MULTIPOLYGON}")
    assert [r[0] for r in df.select(geo.is_valid(F.col("g"))).collect()] == [False, False, True, None]


def test_distance_and_radius(sq):
    r = sq.select(geo.distance_m(F.col("g"), -149.8995, 61.2005).alias("inside"),
                  geo.distance_m(F.col("g"), -149.9, 61.19).alias("south")).first()
    assert r.inside == 0.0
    assert r.south == pytest.approx(1113, rel=0.01)
    near = sq.select(geo.near_centroid(F.lit(-149.8995), F.lit(61.2005), -149.8995, 61.2095, 1500)).first()[0]
    assert near is True


def test_quantise_keeps_small_rings(spark):
    ring = [[0.0, 0.0], [0.000001, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    df = spark.createDataFrame([([[ring]],)], f"g {geo.MULTIPOLYGON}")
    q = df.select(geo.quantise(F.col("g")).alias("q")).first().q
    assert q == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]
    tiny = [[0.0, 0.0], [0.000001, 0.0], [0.000001, 0.000001], [0.0, 0.0]]
    df2 = spark.createDataFrame([([[tiny]],)], f"g {geo.MULTIPOLYGON}")
    assert df2.select(geo.quantise(F.col("g"))).first()[0] == [[tiny]]


def test_within_distance_of_shapes_of_any_size(spark):
    """A large shape over the point is found however far its corners are."""
    df = spark.createDataFrame([("large", -149.95, 61.15, 0.1), ("near", -149.9, 61.2, 0.001), ("huge, off", -149.0, 61.0, 0.5),
                                ("edge", -149.9, 61.2025, 0.001)], "k string, lon double, lat double, side double")
    x1, y1 = F.col("lon") + F.col("side"), F.col("lat") + F.col("side")
    ring = F.array(F.array("lon", "lat"), F.array(x1, "lat"), F.array(x1, y1), F.array("lon", y1), F.array("lon", "lat"))
    df = df.withColumn("g", F.array(F.array(ring)))
    got = {r.k for r in df.filter(geo.within_distance(F.col("g"), -149.8995, 61.2005, 250)).collect()}
    exact = {r.k for r in df.filter(geo.distance_m(F.col("g"), -149.8995, 61.2005) <= 250).collect()}
    assert got == exact == {"large", "near", "edge"}
    assert {r.k for r in df.filter(geo.within_distance(F.col("g"), -149.8995, 61.2005, 100)).collect()} == {"large", "near"}


def test_radius_out_of_range_is_an_error(spark):
    from snapledger.operators import explore
    with pytest.raises(ValueError):
        explore.radius(F.lit(0.0), F.lit(0.0), 0.0, 0.0, 50_000)


def test_self_crossing_ring_is_invalid(spark):
    bow = [[[[0.0, 0.0], [2.0, 2.0], [2.0, 0.0], [0.0, 1.0], [0.0, 0.0]]]]
    concave = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.0], [0.0, 4.0], [0.0, 0.0]]]]
    holed = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 1.0]]]]
    df = spark.createDataFrame([(bow,), (concave,), (holed,)], f"g {geo.MULTIPOLYGON}")
    assert [r[0] for r in df.select(geo.is_valid(F.col("g"))).collect()] == [False, True, True]


def test_quantise_drops_points_on_a_line(spark):
    ring = [[0.0, 0.0], [0.5, 0.0], [0.75, 0.0], [1.0, 0.0], [1.0, 0.00003], [1.0, 1.0], [0.0, 0.0]]
    spike = [[0.0, 0.0], [1.0, 0.0], [0.5, 0.0], [0.5, 1.0], [0.0, 0.0]]
    df = spark.createDataFrame([([[ring]],), ([[spike]],)], f"g {geo.MULTIPOLYGON}")
    got = [r[0] for r in df.select(geo.quantise(F.col("g"))).collect()]
    assert got[0] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]] and got[1] == [[spike]]
