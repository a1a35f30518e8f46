"""Registered queries: staging collapse, year cleaning, geometry measures, radius filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapledger.operators import explore, geo, stage
from snapledger.plans import parcelish
from snapledger.plans.registry import register
from snapledger.plans.tables import table
from snapledger.session import deal
from snapledger.sources.fields import FieldSpec

P = f"WITH p AS ({parcelish.duck_sql()})"
POINT = (-149.5, 61.004)
RADIUS = 1500.0
WITHIN = 500.0
SIDE = 0.001


# --------------------------------------------------------------- oracle-side projection (DuckDB SQL text)
def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    s = f"sin(radians({lat}))"
    q = f"((1 - {geo._E2!r}) * ({s} / (1 - {geo._E2!r} * {s} * {s}) - (1 / (2 * {geo._E!r})) * ln((1 - {geo._E!r} * {s}) / (1 + {geo._E!r} * {s}))))"
    rho = f"({geo.GRS80_A!r} * sqrt({geo._C!r} - {geo._N!r} * {q}) / {geo._N!r})"
    th = f"({geo._N!r} * radians({lon} - ({geo.ALBERS_LON_0!r})))"
    return f"({rho} * sin({th}))", f"({geo._RHO0!r} - {rho} * cos({th}))"


def _square_corners(lon: str, lat: str, side: float):
    lo1, la1 = f"({lon} + {side!r})", f"({lat} + {side!r})"
    return [(lon, lat), (lo1, lat), (lo1, la1), (lon, la1)]


def _square_area_sql(lon: str, lat: str, side: float = SIDE) -> str:
    return ring_area_sql(_square_corners(lon, lat, side))


def ring_area_sql(corners: list[tuple[str, str]]) -> str:
    """Equal-area m2 of a ring with four corners."""
    pts = [_albers_sql(f"({x})", f"({y})") for x, y in corners]
    x0, y0 = pts[0]
    rel = [(f"({x} - {x0})", f"({y} - {y0})") for x, y in pts]
    cr1 = f"({rel[1][0]} * {rel[2][1]} - {rel[2][0]} * {rel[1][1]})"
    cr2 = f"({rel[2][0]} * {rel[3][1]} - {rel[3][0]} * {rel[2][1]})"
    return f"abs({cr1} / 2 + {cr2} / 2)"


def _square_distance_sql(lon: str, lat: str, px: float, py: float, side: float = SIDE) -> str:
    """Projected distance from a point to a square: 0 inside (ray parity), else nearest edge."""
    pts = [_albers_sql(x, y) for x, y in _square_corners(lon, lat, side)]
    qx, qy = _albers_sql(repr(px), repr(py))
    segs, hits = [], []
    for i in range(4):
        (ax, ay), (bx, by) = pts[i], pts[(i + 1) % 4]
        vx, vy = f"({bx} - {ax})", f"({by} - {ay})"
        l2 = f"({vx} * {vx} + {vy} * {vy})"
        t = f"greatest(0.0, least(1.0, (({qx} - {ax}) * {vx} + ({qy} - {ay}) * {vy}) / {l2}))"
        cx, cy = f"({ax} + {t} * {vx})", f"({ay} + {t} * {vy})"
        segs.append(f"sqrt(({qx} - {cx}) * ({qx} - {cx}) + ({qy} - {cy}) * ({qy} - {cy}))")
        hits.append(f"CASE WHEN (({ay}) > {qy}) <> (({by}) > {qy}) AND {qx} < ({bx} - {ax}) * ({qy} - {ay}) / ({by} - {ay}) + {ax} THEN 1 ELSE 0 END")
    inside = "((" + " + ".join(hits) + ") % 2 = 1)"
    return f"CASE WHEN {inside} THEN 0.0 ELSE least({', '.join(segs)}) END"


def _parcels(spark, d):
    return parcelish.parcels(spark, d, with_geometry=True)


# --------------------------------------------------------------- staging
LINE_FIELDS = [FieldSpec("l_partkey", "part_key", "bigint"), FieldSpec("l_suppkey", "supp_key", "bigint"),
               FieldSpec("return_flag", "return_flag", "string"), FieldSpec("l_quantity", "quantity", "double"),
               FieldSpec("l_shipdate", "last_ship", "timestamp", volatile=True)]
PART_SIDE_E6 = 40   # part squares are 40 micro-degrees wide


def _dec6(v: str) -> str:
    """Integer micro-degrees -> decimal text, identically in Spark SQL and DuckDB."""
    return (f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END || CAST(CAST((abs({v}) - abs({v}) % 1000000) / 1000000 AS BIGINT) AS STRING)"
            f" || '.' || lpad(CAST(abs({v}) % 1000000 AS STRING), 6, '0'))")


def _ring_text(x: str, y: str, side: int, ident: str) -> str:
    pts = [(x, y), (f"({x} + {side})", y), (f"({x} + {side})", f"({y} + {side})"), (x, f"({y} + {side})"), (x, y)]
    inner = " || ',' || ".join(f"'[' || {_dec6(px)} || ',' || {_dec6(py)} || ']'" for px, py in pts)
    # braces doubled: the text is a format template for both spark.sql(..., lineitem=df) and str.format
    return ("'{{\"type\":\"Polygon\",\"id\":\"' || " + ident + " || '\",\"coordinates\":[[' || "
            + inner + " || ']]}}'")


# the record's own content, so parts that differ anywhere also differ in their tie-break
_IDENT = ("CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) || '/' || "
          "CAST(CAST(l_quantity AS BIGINT) AS STRING) || '/' || coalesce(return_flag, '')")

# lineitem as raw multi-part records: key = order, part = line number, one small square per line.
# The source repeats (order, line) pairs, so the md5 of the geometry text really breaks ties.
LINE_PARTS_SQL = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
             CASE WHEN l_discount < 0.02 THEN NULL ELSE l_returnflag END AS return_flag,
             -150000000 + (l_orderkey % 500) * 2000 + (l_linenumber - 1) * 250 + (l_partkey % 5) * 50 AS x6,
             61000000 + (CAST((l_orderkey - l_orderkey % 500) / 500 AS BIGINT) % 250) * 2000 AS y6
           FROM {{lineitem}})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, return_flag, l_quantity, l_shipdate, x6, y6,
       {_ring_text('x6', 'y6', PART_SIDE_E6, _IDENT)} AS geom_text
FROM l"""


def line_parts(spark, d):
    return spark.sql(LINE_PARTS_SQL, lineitem=deal(table(spark, d, "lineitem")))


_ORD = "lpad(CAST(l_linenumber AS VARCHAR), 6, '0') || md5(coalesce(geom_text, ''))"
_AREA = _square_area_sql("(x6 / 1000000)", "(y6 / 1000000)", PART_SIDE_E6 / 1e6)


@register("stage_collapse", f"""
WITH raw AS ({LINE_PARTS_SQL.format(lineitem="lineitem")}),
agg AS (SELECT l_orderkey AS order_key,
  arg_min(l_partkey, {_ORD}) FILTER (WHERE l_partkey IS NOT NULL) AS part_key,
  arg_min(l_suppkey, {_ORD}) FILTER (WHERE l_suppkey IS NOT NULL) AS supp_key,
  arg_min(return_flag, {_ORD}) FILTER (WHERE return_flag IS NOT NULL) AS return_flag,
  arg_min(l_quantity, {_ORD}) FILTER (WHERE l_quantity IS NOT NULL) AS quantity,
  max(l_shipdate) AS last_ship,
  CAST(count(*) AS INTEGER) AS feature_count
FROM raw GROUP BY l_orderkey),
areas AS (SELECT l_orderkey, round(sum({_AREA}), 3) AS area_m2
          FROM (SELECT DISTINCT l_orderkey, geom_text, x6, y6 FROM raw) GROUP BY l_orderkey)
SELECT agg.*, areas.area_m2 FROM agg JOIN areas ON areas.l_orderkey = agg.order_key""")
def q_stage_collapse(spark, d):
    # attributes: first non-NULL value in part order; geometry: measures of the distinct parts,
    # never a collected list -- one scan, two aggregation levels (hot keys spread at level 1)
    c = stage.collapse_two_level(line_parts(spark, d), "l_orderkey", LINE_FIELDS, "l_linenumber",
                                 "geom_text", key_dst="order_key")
    return c.select("order_key", *[f.dst for f in LINE_FIELDS], "feature_count",
                    F.round("area_m2", 3).alias("area_m2"))


def _year_fixture(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", (F.lit(1800) + F.col("p_size") * 5).cast("string").alias("year_built"),
        (F.lit(1830) + F.col("p_size") * 4).cast("smallint").alias("year_built_min"),
        (F.lit(1850) + F.col("p_size") * 4).cast("smallint").alias("year_built_max"))


def _yr(c):
    return f"CASE WHEN coalesce(TRY_CAST({c} AS INTEGER) BETWEEN 1850 AND 2027, false) THEN {c} END AS {c}"


@register("stage_clean_years", f"""
WITH f AS (SELECT p_partkey, CAST(1800 + p_size * 5 AS VARCHAR) AS year_built,
                  CAST(1830 + p_size * 4 AS SMALLINT) AS year_built_min,
                  CAST(1850 + p_size * 4 AS SMALLINT) AS year_built_max FROM part)
SELECT p_partkey, {_yr('year_built')}, {_yr('year_built_min')}, {_yr('year_built_max')} FROM f""")
def q_stage_clean_years(spark, d):
    return stage.clean_years(_year_fixture(spark, d), ("year_built", "year_built_min", "year_built_max"), 2026)


# --------------------------------------------------------------- geometry
@register("geo_area", f"{P} SELECT parcel_id, round({_square_area_sql('sw_lon', 'sw_lat')}, 3) AS area_m2 FROM p")
def q_geo_area(spark, d):
    return _parcels(spark, d).select("parcel_id", F.round(geo.area_m2(F.col("geom")), 3).alias("area_m2"))


@register("geo_centroid", f"""{P}
SELECT parcel_id, round(sw_lon + {SIDE / 2!r}, 6) AS centroid_lon, round(sw_lat + {SIDE / 2!r}, 6) AS centroid_lat FROM p""")
def q_geo_centroid(spark, d):
    c = geo.centroid(F.col("geom"))
    return _parcels(spark, d).select("parcel_id", F.round(c["lon"], 6).alias("centroid_lon"),
                                     F.round(c["lat"], 6).alias("centroid_lat"))


@register("geo_bbox", f"""{P}
SELECT parcel_id, sw_lon AS xmin, sw_lat AS ymin, sw_lon + {SIDE!r} AS xmax, sw_lat + {SIDE!r} AS ymax FROM p""")
def q_geo_bbox(spark, d):
    return _parcels(spark, d).select("parcel_id", geo.bbox(F.col("geom")).alias("b")).select("parcel_id", "b.*")


# a square's corners by key: in order, crossed, on one line, or with an open end
@register("geo_valid", f"""{P}, k AS (SELECT CAST(parcel_id AS BIGINT) AS k FROM p),
told AS (SELECT k % 100 = 11 AS none, k % 10 = 3 AS crossed, k % 50 = 9 AS flat, k % 10 = 7 AS open FROM k)
SELECT count(*) AS parcels, count(*) FILTER (none) AS without, count(*) FILTER (NOT none AND NOT (crossed OR flat OR open)) AS valid,
       count(*) FILTER (NOT none AND crossed) AS crossed, count(*) FILTER (NOT none AND open) AS open FROM told""")
def q_geo_valid(spark, d):
    """Validity row by row: which parcels' rings are sound, and why the others are not."""
    p = _parcels(spark, d).select(F.col("parcel_id").cast("bigint").alias("k"), "geom")
    r = F.col("geom")[0][0]
    crossed, flat, opened = F.array(r[0], r[2], r[1], r[3], r[0]), F.array(r[0], r[1], r[0], r[1], r[0]), F.array(r[0], r[1], r[2], r[3], r[1])
    ring = F.when(F.col("k") % 10 == 3, crossed).when(F.col("k") % 50 == 9, flat).when(F.col("k") % 10 == 7, opened).otherwise(r)
    v = p.select(F.when(F.col("k") % 100 != 11, geo.validity(F.array(F.array(ring)))).alias("v"))
    return v.agg(F.count(F.lit(1)).alias("parcels"), F.count_if(F.col("v").isNull()).alias("without"), F.count_if("v.valid").alias("valid"),
                 F.count_if(~F.col("v.simple")).alias("crossed"), F.count_if(~F.col("v.closed")).alias("open"))


# Shapes by their rings' corners, the first corner not repeated: {kind: [polygon: [ring]]}; the last one is written open.
_SQ = [(0, 0), (10, 0), (10, 10), (0, 10)]
SHAPES = [
    [[_SQ]], [[[(0, 0), (10, 10), (10, 0), (0, 10)]]], [[_SQ, [(2, 2), (2, 8), (8, 8), (8, 2)]]], [[_SQ, [(5, 5), (5, 15), (8, 15), (8, 5)]]],
    [[_SQ, [(12, 2), (12, 8), (18, 8), (18, 2)]]], [[_SQ, [(1, 1), (1, 9), (9, 9), (9, 1)], [(3, 3), (3, 6), (6, 6), (6, 3)]]],
    [[_SQ], [[(20, 0), (30, 0), (30, 10), (20, 10)]]], [[_SQ], [[(5, 5), (15, 5), (15, 15), (5, 15)]]], [[_SQ], [[(3, 3), (6, 3), (6, 6), (3, 6)]]],
    [[_SQ, [(1, 1), (1, 9), (9, 9), (9, 1)]], [[(3, 3), (6, 3), (6, 6), (3, 6)]]], [[[(0, 0), (10, 0), (20, 0), (10, 0), (10, 10), (0, 10)]]],
    [[_SQ, [(2, 5), (5, 8), (10, 5), (5, 2)]]], [[_SQ], [[(10, 2), (20, 2), (20, 8), (10, 8)]]], [[[(0, 0), (10, 0), (5, 5), (10, 10), (0, 10), (5, 5)]]],
    [[_SQ]],
]


def _shape_edges() -> str:
    return ", ".join(f"({kind}, {p}, {r}, {i}, {len(ring)}, {ring[i][0]}, {ring[i][1]}, {ring[(i + 1) % len(ring)][0]}, {ring[(i + 1) % len(ring)][1]})"
                     for kind, polygons in enumerate(SHAPES) for p, rings in enumerate(polygons) for r, ring in enumerate(rings) for i in range(len(ring)))


# every pair of edges of a shape, and every corner of a ring against every other ring, in whole numbers
@register("geo_validity", f"""
WITH e(kind, p, r, i, n, x1, y1, x2, y2) AS (VALUES {_shape_edges()}),
pairs AS (SELECT f.kind, f.p = g.p AND f.r = g.r AS one_ring, abs(f.i - g.i) IN (1, f.n - 1) AS neighbours,
    (f.x2 - f.x1) * (g.y1 - f.y1) - (f.y2 - f.y1) * (g.x1 - f.x1) AS ga, (f.x2 - f.x1) * (g.y2 - f.y1) - (f.y2 - f.y1) * (g.x2 - f.x1) AS gb,
    (g.x2 - g.x1) * (f.y1 - g.y1) - (g.y2 - g.y1) * (f.x1 - g.x1) AS fa, (g.x2 - g.x1) * (f.y2 - g.y1) - (g.y2 - g.y1) * (f.x2 - g.x1) AS fb,
    least(greatest(f.x1, f.x2), greatest(g.x1, g.x2)) - greatest(least(f.x1, f.x2), least(g.x1, g.x2)) AS wide,
    least(greatest(f.y1, f.y2), greatest(g.y1, g.y2)) - greatest(least(f.y1, f.y2), least(g.y1, g.y2)) AS high
  FROM e f JOIN e g ON f.kind = g.kind AND (f.p, f.r, f.i) < (g.p, g.r, g.i)),
crossed AS (SELECT DISTINCT kind FROM pairs WHERE (ga * gb < 0 AND fa * fb < 0) OR (ga = 0 AND gb = 0 AND wide >= 0 AND high >= 0 AND wide + high > 0)
    OR (one_ring AND NOT neighbours AND ga * gb <= 0 AND fa * fb <= 0 AND wide >= 0 AND high >= 0)),
inside AS (SELECT c.kind, c.p, c.r, c.i, o.p AS op, o.r AS orr, count(*) FILTER ((o.y1 > c.y1 + 0.001) <> (o.y2 > c.y1 + 0.001)
      AND c.x1 + 0.0013 < (o.x2 - o.x1) * (c.y1 + 0.001 - o.y1) / nullif(CAST(o.y2 - o.y1 AS DOUBLE), 0) + o.x1) % 2 AS odd
  FROM e c JOIN e o ON o.kind = c.kind AND (o.p, o.r) <> (c.p, c.r) GROUP BY ALL),
ringed AS (SELECT kind, p, r, op, orr, 2 * sum(odd) > count(*) AS within FROM inside GROUP BY ALL),
wrong AS (SELECT DISTINCT kind FROM ringed WHERE (r > 0 AND op = p AND orr = 0 AND NOT within) OR (r > 0 AND op = p AND orr > 0 AND within)
  UNION SELECT a.kind FROM ringed a WHERE a.r = 0 AND a.op <> a.p AND a.orr = 0 AND a.within
    AND NOT EXISTS (SELECT 1 FROM ringed h WHERE h.kind = a.kind AND h.p = a.p AND h.r = 0 AND h.op = a.op AND h.orr > 0 AND h.within)),
bad AS (SELECT kind FROM crossed UNION SELECT kind FROM wrong UNION SELECT {len(SHAPES) - 1})
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN (o_orderkey % {len(SHAPES)}) NOT IN (SELECT kind FROM bad) END AS valid FROM orders""")
def q_geo_validity(spark, d):
    """Shapes of every sort, laid out by order: which are valid.  Rows of an order count once."""
    from snapledger.operators import validity

    x, y = F.lit(-150.0) + (F.col("o_orderkey") % 500) / 500, F.lit(61.0) + (F.col("o_orderkey") % 301) / 400

    def ring(corners, is_open=False):
        return F.array(*[F.array(x + a * 2.0 ** -14, y + b * 2.0 ** -14) for a, b in (corners if is_open else [*corners, corners[0]])])
    geom = F.lit(None)
    for kind, polygons in enumerate(SHAPES):
        shape = F.array(*[F.array(*[ring(r, kind == len(SHAPES) - 1) for r in rings]) for rings in polygons])
        geom = F.when(F.col("o_orderkey") % len(SHAPES) == kind, shape).otherwise(geom)
    orders = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 97 != 0, geom).alias("geom"))
    return validity.validity(orders, "o_orderkey").select("o_orderkey", "valid")


@register("geo_within", f"""{P}
SELECT parcel_id, round({_square_distance_sql('sw_lon', 'sw_lat', *POINT)}, 3) AS distance_m FROM p
WHERE {_square_distance_sql('sw_lon', 'sw_lat', *POINT)} <= {WITHIN!r}""")
def q_geo_within(spark, d):
    p = _parcels(spark, d).filter(geo.within_distance(F.col("geom"), *POINT, WITHIN))
    return p.select("parcel_id", F.round(geo.distance_m(F.col("geom"), *POINT), 3).alias("distance_m"))


@register("near_centroid", f"""{P}, c AS (SELECT parcel_id, sw_lon + {SIDE / 2!r} AS lon, sw_lat + {SIDE / 2!r} AS lat FROM p)
SELECT parcel_id FROM c
WHERE pow((lon - ({POINT[0]!r})) * {geo.math.cos(geo.math.radians(POINT[1])) * geo.METERS_PER_DEGREE!r}, 2)
    + pow((lat - {POINT[1]!r}) * {geo.METERS_PER_DEGREE!r}, 2) < {RADIUS * RADIUS!r}""")
def q_near_centroid(spark, d):
    p = _parcels(spark, d)
    c = p.select("parcel_id", geo.centroid(F.col("geom")).alias("c"))
    return c.filter(explore.radius(F.col("c.lon"), F.col("c.lat"), POINT[0], POINT[1], RADIUS)).select("parcel_id")


@register("map_feed", f"""{P}, c AS (SELECT *, sw_lon + {SIDE / 2!r} AS lon, sw_lat + {SIDE / 2!r} AS lat FROM p)
SELECT parcel_id, owner_name, appraised_total_value FROM c
WHERE pow((lon - ({POINT[0]!r})) * {geo.math.cos(geo.math.radians(POINT[1])) * geo.METERS_PER_DEGREE!r}, 2)
    + pow((lat - {POINT[1]!r}) * {geo.METERS_PER_DEGREE!r}, 2) < {RADIUS * RADIUS!r}""")
def q_map_feed(spark, d):
    p = _parcels(spark, d)
    c = geo.centroid(F.col("geom"))
    p = p.withColumn("centroid_lon", c["lon"]).withColumn("centroid_lat", c["lat"])
    sel = explore.radius(F.col("centroid_lon"), F.col("centroid_lat"), POINT[0], POINT[1], RADIUS)
    return explore.map_feed(p, ["parcel_id", "owner_name"], "appraised_total_value", "geom", sel).drop("geom")


@register("current_artifact", f"""{P}
SELECT parcel_id, owner_name, appraised_total_value,
       round(sw_lon + {SIDE / 2!r}, 6) AS centroid_lon, round(sw_lat + {SIDE / 2!r}, 6) AS centroid_lat,
       round(sw_lon, 5) AS q_xmin, round(sw_lat, 5) AS q_ymin,
       round(sw_lon + {SIDE!r}, 5) AS q_xmax, round(sw_lat + {SIDE!r}, 5) AS q_ymax,
       FALSE AS has_attr_hash
FROM p""")
def q_current_artifact(spark, d):
    """Published current rows: no change hash, geometry snapped to the 1e-5 grid, centroids added."""
    from snapledger.operators import scd2
    from snapledger.sources import publish

    p = _parcels(spark, d).select("parcel_id", "owner_name", "appraised_total_value", "geom")
    cur = scd2.with_hash(p, key="parcel_id")
    art = publish.build_current_artifact(cur, "parcel_id")
    b = geo.bbox(F.col("geom"))
    return art.select(
        "parcel_id", "owner_name", "appraised_total_value",
        F.round("centroid_lon", 6).alias("centroid_lon"), F.round("centroid_lat", 6).alias("centroid_lat"),
        b["xmin"].alias("q_xmin"), b["ymin"].alias("q_ymin"), b["xmax"].alias("q_xmax"), b["ymax"].alias("q_ymax"),
        F.lit("attr_hash" in art.columns).alias("has_attr_hash"))


# --------------------------------------------------------------- union of parts
# An order is a rectangle of its customer, in micro-degrees: some share borders, overlap, lie in each other or apart.
RECTANGLES_SQL = """
SELECT o_custkey AS customer, -150000000 + (o_custkey % 400) * 5000 + (o_orderkey % 5) * 60 AS x, 61000000 + (o_custkey % 7) * 5000 + (o_orderkey % 3) * 60 AS y,
       CASE WHEN o_orderkey % 4 < 2 THEN 60 ELSE 90 END AS w, CASE WHEN o_orderkey % 2 = 0 THEN 60 ELSE 30 END AS h
FROM {orders}"""


@register("geo_collect", f"""
WITH r AS (SELECT DISTINCT * FROM ({RECTANGLES_SQL.format(orders="orders")})),
xs AS (SELECT customer, x AS edge FROM r UNION SELECT customer, x + w FROM r),
ys AS (SELECT customer, y AS edge FROM r UNION SELECT customer, y + h FROM r),
gx AS (SELECT customer, edge AS x0, lead(edge) OVER (PARTITION BY customer ORDER BY edge) AS x1 FROM xs),
gy AS (SELECT customer, edge AS y0, lead(edge) OVER (PARTITION BY customer ORDER BY edge) AS y1 FROM ys),
cells AS (SELECT gx.customer, x0, x1, y0, y1, EXISTS (SELECT 1 FROM r WHERE r.customer = gx.customer AND r.x <= x0 AND r.x + r.w >= x1
            AND r.y <= y0 AND r.y + r.h >= y1) AS inside
          FROM gx JOIN gy ON gx.customer = gy.customer WHERE x1 IS NOT NULL AND y1 IS NOT NULL),
sides AS (SELECT *, coalesce(lag(inside) OVER (PARTITION BY customer, y0 ORDER BY x0), false) AS west,
            coalesce(lead(inside) OVER (PARTITION BY customer, y0 ORDER BY x0), false) AS east,
            coalesce(lag(inside) OVER (PARTITION BY customer, x0 ORDER BY y0), false) AS south,
            coalesce(lead(inside) OVER (PARTITION BY customer, x0 ORDER BY y0), false) AS north FROM cells),
sums AS (SELECT customer, sum((x1 - x0) * (y1 - y0)) AS area, sum((y1 - y0) * (CAST(NOT west AS INTEGER) + CAST(NOT east AS INTEGER))
            + (x1 - x0) * (CAST(NOT south AS INTEGER) + CAST(NOT north AS INTEGER))) AS border FROM sides WHERE inside GROUP BY customer)
SELECT customer, (SELECT count(*) FROM r WHERE r.customer = sums.customer) AS n_parts, CAST(area AS BIGINT) AS area, CAST(border AS BIGINT) AS border,
       EXISTS (SELECT 1 FROM r a JOIN r b ON a.customer = b.customer AND (a.x, a.y, a.w, a.h) <> (b.x, b.y, b.w, b.h)
               AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h WHERE a.customer = sums.customer) AS parts_overlap
FROM sums""")
def q_geo_collect(spark, d):
    """Union of each customer's rectangles: area and length of the border, in micro-degrees, from the stitched polygons."""
    from snapledger.operators import dissolve

    r = spark.sql(RECTANGLES_SQL, orders=table(spark, d, "orders"))
    x, y, x1, y1 = (F.expr(e) / 1e6 for e in ("x", "y", "x + w", "y + h"))
    ring = F.array(F.array(x, y), F.array(x1, y), F.array(x1, y1), F.array(x, y1), F.array(x, y))
    polygons, told = dissolve.dissolve(r.select("customer", F.array(F.array(ring)).alias("geom")), "customer")

    def length(ring):
        return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), F.lit(0.0), lambda total, i: total + F.abs(ring[i][0] - ring[i - 1][0]) + F.abs(ring[i][1] - ring[i - 1][1]))
    each = polygons.select("customer", geo.planar_area(F.array(F.col("polygon"))).alias("area"),
                           F.aggregate(F.transform("polygon", length), F.lit(0.0), lambda a, b: a + b).alias("border"))
    sums = each.groupBy("customer").agg(F.round(F.sum("area") * 1e12).cast("bigint").alias("area"), F.round(F.sum("border") * 1e6).cast("bigint").alias("border"))
    return sums.join(told, "customer").select("customer", "n_parts", "area", "border", "parts_overlap")
