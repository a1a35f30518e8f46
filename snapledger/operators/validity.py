"""Validity of whole tables of geometries, as joins over edges.

``geo.validity`` judges what a row can tell by itself: closed rings, enough points, finite coordinates, some area.  Whether
rings cross or touch where they must not is a question about pairs of edges.  A geometry of few points (``SMALL``) forms them inside
its row, without a shuffle.  Of larger ones each edge is filed under cells of its own size and meets only edges whose boxes meet
its own (``dissolve.meeting``), so a ring of n points costs about n and no row, task or group holds pairs that are far apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.operators import dissolve, geo
from snapledger.session import cut_lineage, deal

ASIDE = 1e-9               # how far inside a ring, in degrees, its test point lies
SMALL = 200                # points of a geometry that is judged in its row; pairs inside a row grow with the square


def _edges(rows: DataFrame) -> DataFrame:
    """(k, p, r, i, n, ax, ay, bx, by): edge i of n of ring r of polygon p, with its box."""
    ring = rows.select("k", F.posexplode("geom").alias("p", "polygon")).select("k", "p", F.posexplode("polygon").alias("r", "ring"))
    e = ring.select("k", "p", "r", (F.size("ring") - 1).alias("n"), F.posexplode(F.arrays_zip(
        F.slice("ring", 1, F.size("ring") - 1).alias("a"), F.slice("ring", 2, F.size("ring") - 1).alias("b"))).alias("i", "e"))
    e = e.select("k", "p", "r", "i", "n", F.col("e.a")[0].alias("ax"), F.col("e.a")[1].alias("ay"), F.col("e.b")[0].alias("bx"), F.col("e.b")[1].alias("by"))
    return e.select("*", F.least("ax", "bx").alias("x0"), F.least("ay", "by").alias("y0"), F.greatest("ax", "bx").alias("x1"), F.greatest("ay", "by").alias("y1"))


def _side(a: str, b: str, x: Column, y: Column) -> Column:
    return (F.col(f"{b}x") - F.col(f"{a}x")) * (y - F.col(f"{a}y")) - (F.col(f"{b}y") - F.col(f"{a}y")) * (x - F.col(f"{a}x"))


def _between(a: str, b: str, c: str) -> Column:
    """Whether c, on the line of a and b, lies strictly between them."""
    along = (F.col(f"{c}x") - F.col(f"{a}x")) * (F.col(f"{b}x") - F.col(f"{a}x")) + (F.col(f"{c}y") - F.col(f"{a}y")) * (F.col(f"{b}y") - F.col(f"{a}y"))
    long = F.pow(F.col(f"{b}x") - F.col(f"{a}x"), 2) + F.pow(F.col(f"{b}y") - F.col(f"{a}y"), 2)
    return (along > 0) & (along < long)


def crossings(rows: DataFrame) -> DataFrame:
    """(k, reason) of the geometries (k, geom) whose rings cross, touch themselves or share a stretch of border."""
    e = cut_lineage(_edges(rows).where("ax <> bx OR ay <> by"), "valid-edges")
    named = F.struct("p", "r", "i", "n", "ax", "ay", "bx", "by")
    boxes = ["x0", "y0", "x1", "y1"]
    pairs = dissolve.meeting(e.select("k", *boxes, named.alias("f")), e.select("k", *boxes, named.alias("g")), ["f"], ["g"]).where("f <> g")
    flat = pairs.select("k", "f", "g", *[F.col(f"{s}.{c}").alias(f"{s}{c}") for s in "fg" for c in ("ax", "ay", "bx", "by")])
    ga, gb = (_side("fa", "fb", F.col(f"g{c}x"), F.col(f"g{c}y")) for c in "ab")
    fa, fb = (_side("ga", "gb", F.col(f"f{c}x"), F.col(f"f{c}y")) for c in "ab")
    crossing = (ga * gb < 0) & (fa * fb < 0)
    same = lambda a, b: (F.col(f"{a}x") == F.col(f"{b}x")) & (F.col(f"{a}y") == F.col(f"{b}y"))
    equal = (same("fa", "ga") & same("fb", "gb")) | (same("fa", "gb") & same("fb", "ga"))
    onto = ((ga == 0) & _between("fa", "fb", "ga")) | ((gb == 0) & _between("fa", "fb", "gb")) | (
        (fa == 0) & _between("ga", "gb", "fa")) | ((fb == 0) & _between("ga", "gb", "fb"))
    shared = (ga == 0) & (gb == 0) & (equal | onto)
    touching = onto | equal | same("fa", "ga") | same("fa", "gb") | same("fb", "ga") | same("fb", "gb")
    one_ring = (F.col("f.p") == F.col("g.p")) & (F.col("f.r") == F.col("g.r"))
    gap = F.abs(F.col("f.i") - F.col("g.i"))
    neighbours = (gap == 1) | (gap == F.col("f.n") - 1)
    why = (F.when(crossing, "rings cross").when(shared, "rings share a border")
           .when(one_ring & ~neighbours & touching, "a ring touches itself"))
    return flat.withColumn("reason", why).where("reason IS NOT NULL").select("k", "reason").distinct()


def _inner_points(rows: DataFrame) -> DataFrame:
    """(k, p, r, x, y): a point just inside each ring, beside the middle of its first edge."""
    ring = rows.select("k", F.posexplode("geom").alias("p", "polygon")).select("k", "p", F.posexplode("polygon").alias("r", "ring"))
    ring = ring.where(F.size("ring") >= 4).withColumn("left", F.signum(geo._ring_moments(F.col("ring"))["a"]))
    a, b = F.col("ring")[0], F.col("ring")[1]
    long = F.hypot(b[0] - a[0], b[1] - a[1])
    return ring.where(long > 0).select("k", "p", "r", ((a[0] + b[0]) / 2 - F.col("left") * ASIDE * (b[1] - a[1]) / long).alias("x"),
                                       ((a[1] + b[1]) / 2 + F.col("left") * ASIDE * (b[0] - a[0]) / long).alias("y"))


def misplaced(rows: DataFrame) -> DataFrame:
    """(k, reason) of the geometries with a hole outside its shell, a hole in a hole, or a polygon in another one's inside."""
    at = _inner_points(rows).select("*", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    several = rows.where((F.size("geom") > 1) | F.exists("geom", lambda p: F.size(p) > 1)).select("k")
    at = cut_lineage(at.join(several, "k", "left_semi"), "valid-points")
    ring = rows.join(several, "k", "left_semi").select("k", F.posexplode("geom").alias("op", "polygon")).select(
        "k", "op", "polygon", F.posexplode("polygon").alias("orr", "ring"))
    box = geo.bbox(F.array(F.array(F.col("ring"))))
    ring = ring.withColumn("b", box).select("k", "op", "orr", F.array("ring").alias("alone"), F.when(F.col("orr") == 0, F.col("polygon")).alias("polygon"),
                                            F.col("b.xmin").alias("x0"), F.col("b.ymin").alias("y0"), F.col("b.xmax").alias("x1"), F.col("b.ymax").alias("y1"))
    met = dissolve.meeting(at, ring, ["p", "r", "x", "y"], ["op", "orr", "alone", "polygon"])
    met = met.where("NOT (p = op AND r = orr)").where(dissolve._covers(F.col("alone"), F.col("x"), F.col("y")))
    in_shell = met.where("r > 0 AND p = op AND orr = 0").select("k", "p", "r").distinct()
    out = at.where("r > 0").join(in_shell, ["k", "p", "r"], "left_anti").select("k", F.lit("a hole lies outside its shell").alias("reason"))
    nested = met.where("r > 0 AND p = op AND orr > 0").select("k", F.lit("a hole lies in a hole").alias("reason"))
    over = met.where("r = 0 AND p <> op AND orr = 0").where(dissolve._covers(F.col("polygon"), F.col("x"), F.col("y")))
    return out.unionByName(nested).unionByName(over.select("k", F.lit("polygons overlap").alias("reason"))).distinct()


# ----------------------------------------------------------------------------- geometries of few points, in their row
def _edges_within(geom: Column) -> Column:
    """``_edges`` of one geometry, with their levels."""
    def of_ring(ring, p, r):
        def edge(b, i):
            a = ring[i]
            x0, y0, x1, y1 = F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
            return F.struct(p.alias("p"), r.alias("r"), i.alias("i"), (F.size(ring) - 1).alias("n"), a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by"),
                            x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), dissolve._level_of(x0, y0, x1, y1).alias("level"))
        return F.transform(F.slice(ring, 2, F.size(ring) - 1), edge)
    each = F.flatten(F.transform(geom, lambda polygon, p: F.flatten(F.transform(polygon, lambda ring, r: of_ring(ring, p, r)))))
    return F.filter(each, lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))


def _crossings_within(geom: Column) -> Column:
    """The reasons of ``crossings`` for one geometry."""
    def side(e, o, end):
        return (e["bx"] - e["ax"]) * (o[f"{end}y"] - e["ay"]) - (e["by"] - e["ay"]) * (o[f"{end}x"] - e["ax"])

    def between(e, o, end):
        along = (o[f"{end}x"] - e["ax"]) * (e["bx"] - e["ax"]) + (o[f"{end}y"] - e["ay"]) * (e["by"] - e["ay"])
        return (along > 0) & (along < F.pow(e["bx"] - e["ax"], 2) + F.pow(e["by"] - e["ay"], 2))

    def why(f, g):
        def told(d):
            same = lambda a, b: (f[f"{a}x"] == g[f"{b}x"]) & (f[f"{a}y"] == g[f"{b}y"])
            equal = (same("a", "a") & same("b", "b")) | (same("a", "b") & same("b", "a"))
            onto = ((d["ga"] == 0) & between(f, g, "a")) | ((d["gb"] == 0) & between(f, g, "b")) | (
                (d["fa"] == 0) & between(g, f, "a")) | ((d["fb"] == 0) & between(g, f, "b"))
            touching = onto | same("a", "a") | same("a", "b") | same("b", "a") | same("b", "b")
            one_ring = (f["p"] == g["p"]) & (f["r"] == g["r"])
            gap = F.abs(f["i"] - g["i"])
            return (F.when((d["ga"] * d["gb"] < 0) & (d["fa"] * d["fb"] < 0), "rings cross").when((d["ga"] == 0) & (d["gb"] == 0) & (equal | onto), "rings share a border")
                    .when(one_ring & (gap != 1) & (gap != f["n"] - 1) & touching, "a ring touches itself"))
        return geo._let(F.struct(*[side(e, o, end).alias(s + end) for s, e, o in (("g", f, g), ("f", g, f)) for end in "ab"]), told)

    def pairs(edges):
        def met(f):
            near = F.filter(edges, lambda g: (f["level"] <= g["level"]) & dissolve._near(f, g) & ((f["i"] != g["i"]) | (f["r"] != g["r"]) | (f["p"] != g["p"])))
            return F.transform(near, lambda g: why(f, g))
        return F.flatten(F.transform(edges, met))
    return geo._let(_edges_within(geom), pairs)


def _misplaced_within(geom: Column) -> Column:
    """The reasons of ``misplaced`` for one geometry."""
    def point(ring):
        a, b = ring[0], ring[1]

        def beside(m):
            return F.when(m["long"] > 0, F.struct(((a[0] + b[0]) / 2 - m["left"] * ASIDE * (b[1] - a[1]) / m["long"]).alias("x"),
                                                  ((a[1] + b[1]) / 2 + m["left"] * ASIDE * (b[0] - a[0]) / m["long"]).alias("y")))
        return F.when(F.size(ring) >= 4, geo._let(F.struct(F.hypot(b[0] - a[0], b[1] - a[1]).alias("long"), F.signum(geo.ring_area(ring)).alias("left")), beside))

    def why(at, polygon, p, r):
        covers = lambda rings: dissolve._covers(rings, at["x"], at["y"])
        nested = F.size(F.filter(polygon, lambda ring, o: (o > 0) & (o != r) & covers(F.array(ring)))) > 0
        over = F.size(F.filter(geom, lambda other, o: (o != p) & covers(F.array(other[0])) & covers(other))) > 0
        return F.array(F.when(at.isNotNull() & (r > 0) & ~covers(F.array(polygon[0])), "a hole lies outside its shell"),
                       F.when(at.isNotNull() & (r > 0) & nested, "a hole lies in a hole"), F.when(at.isNotNull() & (r == 0) & over, "polygons overlap"))
    each = F.flatten(F.transform(geom, lambda polygon, p: F.flatten(F.transform(polygon, lambda ring, r: geo._let(point(ring), lambda at: why(at, polygon, p, r))))))
    several = (F.size(geom) > 1) | F.exists(geom, lambda polygon: F.size(polygon) > 1)
    return F.when(several, each).otherwise(F.array().cast("array<string>"))


def validity(df: DataFrame, key: str, geom: str = "geom") -> DataFrame:
    """(key, valid, reason) of every row of ``df``: valid as simple features are, the first reason by name if not; NULL for no geometry.

    ``key`` tells rows apart.  Rings must be closed, with four points or more, finite, of some area, and must not
    cross, touch themselves or share a stretch of border; holes lie in their shell and not in each other, polygons
    not in each other's inside.  Rings may touch others in single points.
    """
    rows = cut_lineage(df.select(F.col(key).alias("k"), F.col(geom).alias("geom")), "valid-rows")
    # rows that share a key are judged together, as ever, by joins
    points = F.aggregate("geom", F.lit(0), lambda n, polygon: n + F.aggregate(polygon, F.lit(0), lambda m, ring: m + F.size(ring)))
    apart = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max(points).alias("points")).where((F.col("k").isNotNull()) & ((F.col("n") > 1) | (F.col("points") > SMALL)))
    apart = cut_lineage(apart.select("k"), "valid-apart")
    own = geo.shape(F.col("geom"))
    plain = (F.when(F.col("geom").isNull(), None).when(~own["closed"], "a ring is open").when(~own["enough_points"], "a ring has too few points")
             .when(~own["finite"], "a coordinate is not finite").when(~own["nonzero_area"], "a ring has no area"))
    reasons = F.array_min(F.concat(_crossings_within(F.col("geom")), _misplaced_within(F.col("geom"))))
    few, told = rows, None
    if not apart.isEmpty():
        few, some = rows.join(apart, "k", "left_anti"), rows.join(apart, "k", "left_semi")
        told = some.select("k", plain.alias("own"), F.col("geom").isNull().alias("none"))
        sound = some.join(told.where("own IS NULL AND NOT none").select("k"), "k", "left_semi")
        bad = crossings(sound).unionByName(misplaced(sound)).groupBy("k").agg(F.min("reason").alias("reason"))
        told = told.join(bad, "k", "left").withColumn("reason", F.coalesce("own", "reason"))
    judged = deal(few).select("k", F.col("geom").isNull().alias("none"), F.coalesce(plain, F.when(F.col("geom").isNotNull() & F.col("k").isNotNull(), reasons)).alias("reason"))
    told = judged if told is None else judged.unionByName(told.select("k", "none", "reason"))
    return told.select(F.col("k").alias(key), F.when(~F.col("none"), F.col("reason").isNull()).alias("valid"), "reason")
