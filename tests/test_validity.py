"""Validity of tables of geometries: every reason, rings of very many points, and shapes of every sort against SQL."""

import math
import random

from snapledger.operators import geo, validity
from tools.oracle_check import compare


def closed(points):
    return [[float(x), float(y)] for x, y in [*points, points[0]]]


SQ = [(0, 0), (10, 0), (10, 10), (0, 10)]


def test_reasons(spark):
    circle = [(math.cos(2 * math.pi * i / 10_000), math.sin(2 * math.pi * i / 10_000)) for i in range(10_000)]
    wild = list(circle)
    wild[2500], wild[7500] = wild[7500], wild[2500]                     # two spikes right through the ring
    rnd = random.Random(1)
    star = [(r * math.cos(t), r * math.sin(t)) for t, r in ((2 * math.pi * i / 600, rnd.uniform(0.5, 1.0)) for i in range(600))]
    rows = {
        "square": ([[closed(SQ)]], None), "circle": ([[closed(circle)]], None), "star": ([[closed(star)]], None),
        "circle crossed": ([[closed(wild)]], "rings cross"),
        "bow tie": ([[closed([(0, 0), (10, 9), (10, 0), (0, 10)])]], "rings cross"),
        "holes that cross": ([[closed(SQ), closed([(1, 1), (1, 5), (5, 5), (5, 1)]), closed([(3, 3), (3, 8), (8, 8), (8, 3)])]], "rings cross"),
        "hole on the border": ([[closed(SQ), closed([(0, 2), (0, 8), (5, 8), (5, 2)])]], "rings share a border"),
        "hole that touches": ([[closed(SQ), closed([(2, 5), (5, 8), (10, 5), (5, 2)])]], None),
        "hole outside": ([[closed(SQ), closed([(12, 2), (12, 8), (18, 8), (18, 2)])]], "a hole lies outside its shell"),
        "hole in a hole": ([[closed(SQ), closed([(1, 1), (1, 9), (9, 9), (9, 1)]), closed([(3, 3), (3, 6), (6, 6), (6, 3)])]], "a hole lies in a hole"),
        "island": ([[closed(SQ), closed([(1, 1), (1, 9), (9, 9), (9, 1)])], [closed([(3, 3), (6, 3), (6, 6), (3, 6)])]], None),
        "polygon in a polygon": ([[closed(SQ)], [closed([(3, 3), (6, 3), (6, 6), (3, 6)])]], "polygons overlap"),
        "touching itself": ([[closed([(0, 0), (10, 0), (5, 5), (10, 10), (0, 10), (5, 5)])]], "a ring touches itself"),
        "open": ([[closed(SQ)[:-1] + [[3.0, 4.0]]]], "a ring is open"), "two points": ([[closed([(0, 0), (1, 1)])]], "a ring has too few points"),
        "line": ([[closed([(0, 0), (1, 0), (2, 0)])]], "a ring has no area"), "far": ([[closed([(0, 0), (500, 0), (0, 1)])]], "a coordinate is not finite"),
    }
    df = spark.createDataFrame([(k, g) for k, (g, _) in rows.items()] + [("none", None)], f"key string, geom {geo.MULTIPOLYGON}").repartition(4)
    got = {r["key"]: (r["valid"], r["reason"]) for r in validity.validity(df, "key").collect()}
    assert got == {k: (why is None, why) for k, (_, why) in rows.items()} | {"none": (None, None)}
    by_row = {r["key"]: r["v"] for r in df.where("key in ('square', 'star', 'bow tie', 'open', 'line')").select("key", geo.is_valid(df["geom"]).alias("v")).collect()}
    assert by_row == {"square": True, "star": True, "bow tie": False, "open": False, "line": False}


def _judged(spark, rnd):
    def box(x, y, w, h, back=False):
        c = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        return closed(c[::-1] if back else c)
    rows = []
    for k in range(200):
        geom = []
        for _ in range(rnd.randint(1, 2)):
            shell = box(*(rnd.randint(0, 4) for _ in "xy"), *(rnd.randint(2, 8) for _ in "wh"))
            if rnd.random() < 0.2:
                shell[2] = [float(rnd.randint(0, 8)), float(rnd.randint(0, 8))]
            geom.append([shell, *[box(*(rnd.randint(0, 6) for _ in "xy"), *(rnd.randint(1, 3) for _ in "wh"), True) for _ in range(rnd.choice([0, 0, 1, 2]))]])
        rows += [(k, geom)] * (2 if k % 50 == 7 else 1)
    return validity.validity(spark.createDataFrame(rows, f"key long, geom {geo.MULTIPOLYGON}").repartition(4), "key")


def test_rows_and_joins_agree(spark, monkeypatch):
    """Geometries of few points, judged in their rows, get the reasons that joins give them; only the others are joined."""
    joined, crossings = [], validity.crossings
    monkeypatch.setattr(validity, "crossings", lambda rows: joined.append(rows.count()) or crossings(rows))
    within = sorted(map(str, _judged(spark, random.Random(3)).collect()))
    assert sum(joined) <= 8                                          # keys that come twice
    monkeypatch.setattr(validity, "SMALL", 0)
    assert sorted(map(str, _judged(spark, random.Random(3)).collect())) == within and sum(joined) > 100


def test_sql(spark):
    assert {r[0] for r in compare(spark, "/root/testdata/sf0.001", ["geo_valid", "geo_validity"]).values()} == {"match"}
