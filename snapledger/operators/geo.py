"""Planar geometry on nested arrays, as native Column expressions (no per-row library).

A geometry is a multipolygon ``array<array<array<array<double>>>>``:
polygons -> rings (first = outer, rest = holes) -> points -> [lon, lat].
Everything below is built from ``transform`` / ``aggregate`` / ``sequence`` so it
stays in the JVM and scales with the table like any other projection.

Area uses a closed-form ellipsoidal Albers equal-area projection (GRS80,
standard parallels 55/65, origin 50N 154W); shoelace sums are taken relative
to each ring's first point to avoid cancellation in large coordinates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MULTIPOLYGON = "array<array<array<array<double>>>>"
POLYGON = "array<array<array<double>>>"

# --- fixed values: projection parameters -------------------------------------
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101
ALBERS_LAT_1, ALBERS_LAT_2, ALBERS_LAT_0, ALBERS_LON_0 = 55.0, 65.0, 50.0, -154.0
METERS_PER_DEGREE = 111320.0
# -----------------------------------------------------------------------------

_f = 1.0 / GRS80_INV_F
_E2 = 2 * _f - _f * _f
_E = math.sqrt(_E2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * math.log((1 - _E * s) / (1 + _E * s)))


def _m(phi: float) -> float:
    s = math.sin(phi)
    return math.cos(phi) / math.sqrt(1 - _E2 * s * s)


_p1, _p2, _p0 = (math.radians(v) for v in (ALBERS_LAT_1, ALBERS_LAT_2, ALBERS_LAT_0))
_N = (_m(_p1) ** 2 - _m(_p2) ** 2) / (_q(_p2) - _q(_p1))
_C = _m(_p1) ** 2 + _N * _q(_p1)
_RHO0 = GRS80_A * math.sqrt(_C - _N * _q(_p0)) / _N


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) metres in the equal-area conic projection."""
    phi = F.radians(lat)
    s = F.sin(phi)
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * F.ln((1 - _E * s) / (1 + _E * s)))
    rho = GRS80_A * F.sqrt(_C - _N * q) / _N
    theta = _N * F.radians(lon - ALBERS_LON_0)
    return rho * F.sin(theta), _RHO0 - rho * F.cos(theta)


def parse_geojson(text: Column) -> Column:
    """GeoJSON Polygon / MultiPolygon text -> multipolygon array (other types -> NULL)."""
    typ = F.get_json_object(text, "$.type")
    poly = F.from_json(text, f"struct<coordinates: {POLYGON}>").getField("coordinates")
    multi = F.from_json(text, f"struct<coordinates: {MULTIPOLYGON}>").getField("coordinates")
    return F.when(typ == "Polygon", F.array(poly)).when(typ == "MultiPolygon", multi)


def to_geojson(geom: Column) -> Column:
    return F.when(geom.isNotNull(), F.to_json(F.struct(F.lit("MultiPolygon").alias("type"),
                                                      geom.alias("coordinates"))))


def canonical_text(geom: Column) -> Column:
    """Stable text for hashing/shipping: JSON of the polygons in sorted order."""
    return F.to_json(F.array_sort(geom))


def collect_parts(parts: Column) -> Column:
    """Aggregate: union of part geometries as one multipolygon of distinct polygons, sorted.

    Exact for interior-disjoint parts (the source's multi-part records).
    """
    return F.flatten(F.array_sort(F.collect_set(parts)))


def _albers_point(p: Column) -> Column:
    """[x, y] for one [lon, lat] point; sin(lat) and rho are bound once (same arithmetic as ``albers``)."""
    def with_s(s):
        q = (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * F.ln((1 - _E * s) / (1 + _E * s)))
        rho = GRS80_A * F.sqrt(_C - _N * q) / _N
        theta = _N * F.radians(p[0] - ALBERS_LON_0)
        return _let(rho, lambda r: F.array(r * F.sin(theta), _RHO0 - r * F.cos(theta)))
    return _let(F.sin(F.radians(p[1])), with_s)


def project(geom: Column) -> Column:
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, _albers_point)))


def _from_first(ring: Column) -> Column:
    """The ring's points relative to its first one, as structs (x, y): read out of the nested arrays once."""
    return F.transform(ring, lambda p: F.struct((p[0] - ring[0][0]).alias("x"), (p[1] - ring[0][1]).alias("y")))


def _ring_moments(ring: Column) -> Column:
    """struct(a, mx, my): signed area and first moments (computed relative to the ring's
    first point, shifted back to absolute coordinates in the finish step)."""
    def step(acc, p):        # the accumulator carries the point before; the first point adds nothing
        cr = acc["x"] * p["y"] - p["x"] * acc["y"]
        return F.struct(p["x"].alias("x"), p["y"].alias("y"), (acc["a"] + cr / 2).alias("a"),
                        (acc["mx"] + (acc["x"] + p["x"]) * cr / 6).alias("mx"), (acc["my"] + (acc["y"] + p["y"]) * cr / 6).alias("my"))

    def finish(m):
        return F.struct(m["a"].alias("a"), (m["mx"] + m["a"] * ring[0][0]).alias("mx"),
                        (m["my"] + m["a"] * ring[0][1]).alias("my"))

    start = F.struct(*[F.lit(0.0).alias(n) for n in ("x", "y", "a", "mx", "my")])
    # rings with fewer than 4 points contribute nothing
    return F.when(F.size(ring) < 4, finish(_zero())).otherwise(F.aggregate(_from_first(ring), start, step, finish))


def ring_area(ring: Column) -> Column:
    """The signed area alone, by the arithmetic of ``_ring_moments``."""
    def step(acc, p):
        return F.struct(p["x"].alias("x"), p["y"].alias("y"), (acc["a"] + (acc["x"] * p["y"] - p["x"] * acc["y"]) / 2).alias("a"))
    start = F.struct(*[F.lit(0.0).alias(n) for n in ("x", "y", "a")])
    return F.when(F.size(ring) < 4, 0.0).otherwise(F.aggregate(_from_first(ring), start, step, lambda m: m["a"]))


def _zero() -> Column:
    return F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))


def _poly_moments(poly: Column) -> Column:
    """Outer ring positive, holes negative, whatever the ring orientation."""
    rings = F.transform(poly, lambda ring, i: F.struct(_ring_moments(ring).alias("m"), i.alias("i")))

    def step(acc, r):
        w = F.when(r["i"] == 0, 1.0).otherwise(-1.0) * F.signum(r["m"]["a"])
        return F.struct((acc["a"] + w * r["m"]["a"]).alias("a"), (acc["mx"] + w * r["m"]["mx"]).alias("mx"),
                        (acc["my"] + w * r["m"]["my"]).alias("my"))

    return F.aggregate(rings, _zero(), step)


def _moments(geom: Column, finish=None) -> Column:
    def add(acc, m):
        return F.struct((acc["a"] + m["a"]).alias("a"), (acc["mx"] + m["mx"]).alias("mx"),
                        (acc["my"] + m["my"]).alias("my"))
    polys = F.transform(geom, _poly_moments)
    return F.aggregate(polys, _zero(), add) if finish is None else F.aggregate(polys, _zero(), add, finish)


def planar_area(geom: Column) -> Column:
    return F.when(geom.isNotNull(), _area(geom))


def _area(geom: Column) -> Column:
    def of_polygon(poly):
        rings = F.transform(poly, lambda ring, i: F.struct(ring_area(ring).alias("a"), i.alias("i")))
        return F.aggregate(rings, F.lit(0.0), lambda acc, r: acc + F.when(r["i"] == 0, 1.0).otherwise(-1.0) * F.signum(r["a"]) * r["a"])
    return F.abs(F.aggregate(F.transform(geom, of_polygon), F.lit(0.0), lambda acc, a: acc + a))


def area_m2(geom: Column) -> Column:
    """Equal-area m²: outer rings minus holes, summed over polygons."""
    return F.when(geom.isNotNull(), _area(project(geom)))          # the test is on what is given: no shape is projected for it


def centroid(geom: Column) -> Column:
    """struct(lon, lat): area-weighted centroid in degrees (NULL when the area is zero)."""
    def finish(m):
        ok = m["a"] != 0
        return F.struct(F.when(ok, m["mx"] / m["a"]).alias("lon"), F.when(ok, m["my"] / m["a"]).alias("lat"))
    return F.when(geom.isNotNull(), _moments(geom, finish))


def _points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bbox(geom: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    def told(pts):
        xs, ys = F.transform(pts, lambda p: p[0]), F.transform(pts, lambda p: p[1])
        return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                        F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))
    return _let(_points(geom), told)


def shape(geom: Column) -> Column:
    """struct of what rings say one by one: closed, enough_points (>= 4), finite, nonzero_area."""
    rings = F.flatten(geom)
    return F.struct(
        F.forall(rings, lambda r: (r[0][0] == r[F.size(r) - 1][0]) & (r[0][1] == r[F.size(r) - 1][1])).alias("closed"),
        F.forall(rings, lambda r: F.size(r) >= 4).alias("enough_points"),
        # NaN is above every number
        F.forall(_points(geom), lambda p: (F.size(p) >= 2) & (F.abs(p[0]) <= 180) & (F.abs(p[1]) <= 90)).alias("finite"),
        F.forall(geom, lambda poly: F.abs(ring_area(poly[0])) > 0).alias("nonzero_area"))


def validity(geom: Column) -> Column:
    """struct of reasons and ``valid``: ``shape``, and ``simple``: no ring crosses itself (pairs of a ring's own
    segments, tested within the row unless the ring is convex).  For rings against each other and rings of very many
    points see ``operators.validity``."""
    parts = shape(geom)
    bound = F.transform(F.flatten(geom), lambda r: F.transform(r, lambda p: F.array(p[0], p[1])))
    simple = ~F.exists(bound, lambda r: ~_convex(r) & _crosses_itself(r))
    return F.struct(parts["closed"].alias("closed"), parts["enough_points"].alias("enough_points"), parts["finite"].alias("finite"),
                    parts["nonzero_area"].alias("nonzero_area"), simple.alias("simple"),
                    (parts["closed"] & parts["enough_points"] & parts["finite"] & parts["nonzero_area"] & simple).alias("valid"))


def _convex(r: Column) -> Column:
    """Whether a ring of four corners turns one way only: such a ring can't cross itself."""
    def turn(i, j, k):
        return (r[j][0] - r[i][0]) * (r[k][1] - r[j][1]) - (r[j][1] - r[i][1]) * (r[k][0] - r[j][0])
    turns = [turn(0, 1, 2), turn(1, 2, 3), turn(2, 3, 0), turn(3, 0, 1)]
    left, right = turns[0] > 0, turns[0] < 0
    for t in turns[1:]:
        left, right = left & (t > 0), right & (t < 0)
    return F.when(F.size(r) == 5, left | right).otherwise(False)


def _crosses_itself(r: Column) -> Column:
    """Whether two segments of a ring cross properly (each one's ends on either side of the other)."""
    n = F.size(r) - 1

    def side(a, b, p):
        return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])

    def crosses(i, j):
        a, b, c, d = r[i], r[i + 1], r[j], r[j + 1]
        return (side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)

    def with_later(i):
        return F.when(i + 2 < n, F.exists(F.sequence(i + 2, n - 1), lambda j: crosses(i, j))).otherwise(False)

    return F.when(n >= 4, F.exists(F.sequence(F.lit(0), n - 1), with_later)).otherwise(False)


def is_valid(geom: Column) -> Column:
    return F.when(geom.isNotNull(), validity(geom)["valid"])


def quantise(geom: Column, tol: float = 1e-5) -> Column:
    """Snap to a ``tol`` grid, drop consecutive repeated points and points on the straight line
    between their neighbours; a ring that would fall below 4 points keeps its original vertices."""
    digits = round(-math.log10(tol))
    exact = math.isclose(10.0 ** -digits, tol)

    def snap(v):
        return F.round(v, digits) if exact else F.round(v / tol) * tol

    def ring_fn(r):
        snapped = F.transform(r, lambda p: F.array(snap(p[0]), snap(p[1])))

        def dedupe(sn):      # ``sn`` is a bound variable: the snapped ring is computed once
            kept = F.filter(sn, lambda p, i: (i == 0) | (p[0] != sn[i - 1][0]) | (p[1] != sn[i - 1][1]))
            return F.transform(F.transform(F.array(kept), straighten), lambda k: F.when(F.size(k) >= 4, k).otherwise(r))[0]

        def straighten(k):
            def bends(p, i):
                a, b = k[i - 1], k[i + 1]
                off = F.abs((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))
                back = (p[0] - a[0]) * (b[0] - p[0]) + (p[1] - a[1]) * (b[1] - p[1]) < 0
                return back | (off > 1e-3 * tol * (F.abs(b[0] - a[0]) + F.abs(b[1] - a[1])))
            return F.filter(k, lambda p, i: F.when((i == 0) | (i == F.size(k) - 1), True).otherwise(bends(p, i)))
        return _let(snapped, dedupe)
    return F.transform(geom, lambda poly: F.transform(poly, ring_fn))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and bind it to a lambda variable for ``body`` (a one-element transform)."""
    return F.transform(F.array(value), body)[0]


def near_centroid(lon: Column, lat: Column, lon0: float, lat0: float, radius_m: float) -> Column:
    """Cheap radius test on centroids (metres per degree, cos of the query latitude), strict <."""
    cos_lat = math.cos(math.radians(lat0))
    return (F.pow((lon - lon0) * (cos_lat * METERS_PER_DEGREE), 2)
            + F.pow((lat - lat0) * METERS_PER_DEGREE, 2)) < radius_m * radius_m


def radius_bbox(lon: Column, lat: Column, lon0: float, lat0: float, radius_m: float, slack: float = 1.5) -> Column:
    """Conservative degree box around the point: a pushdown-able pre-filter for radius tests."""
    x0, y0, x1, y1 = search_box(lon0, lat0, radius_m, slack)
    return lon.between(x0, x1) & lat.between(y0, y1)


def distance_m(geom: Column, lon0: float, lat0: float) -> Column:
    """Projected distance (m) from the point to the geometry: 0 inside, else nearest edge."""
    px, py = albers(F.lit(lon0), F.lit(lat0))
    pg = project(geom)
    rings = F.flatten(pg)

    def seg_dist(r):
        idx = F.sequence(F.lit(0), F.size(r) - 2)

        def d(i):
            ax, ay, bx, by = r[i][0], r[i][1], r[i + 1][0], r[i + 1][1]
            vx, vy = bx - ax, by - ay
            l2 = vx * vx + vy * vy
            t = F.when(l2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * vx + (py - ay) * vy) / l2))).otherwise(0.0)
            cx, cy = ax + t * vx, ay + t * vy
            return F.sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy))
        return F.array_min(F.transform(idx, d))

    def crossings(r):
        idx = F.sequence(F.lit(0), F.size(r) - 2)

        def c(i):
            ax, ay, bx, by = r[i][0], r[i][1], r[i + 1][0], r[i + 1][1]
            hit = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
            return F.when(hit, 1).otherwise(0)
        return F.aggregate(F.transform(idx, c), F.lit(0), lambda a, b: a + b)

    def inside_poly(poly):
        return F.aggregate(F.transform(poly, crossings), F.lit(0), lambda a, b: a + b) % 2 == 1

    inside = F.exists(pg, inside_poly)
    edge = F.array_min(F.transform(rings, seg_dist))
    return F.when(geom.isNotNull(), F.when(inside, 0.0).otherwise(edge))


def search_box(lon0: float, lat0: float, radius_m: float, slack: float = 1.5) -> tuple[float, float, float, float]:
    """(xmin, ymin, xmax, ymax) in degrees, around everything within the radius."""
    dlat = slack * radius_m / METERS_PER_DEGREE
    dlon = slack * radius_m / (METERS_PER_DEGREE * max(math.cos(math.radians(lat0 + math.copysign(dlat, lat0))), 1e-6))
    return lon0 - dlon, lat0 - dlat, lon0 + dlon, lat0 + dlat


def within_distance(geom: Column, lon0: float, lat0: float, radius_m: float) -> Column:
    """Whether a geometry of any size comes within the radius of the point, by projected distance.

    The exact test runs only where the geometry's bounding box meets the search box.
    """
    x0, y0, x1, y1 = search_box(lon0, lat0, radius_m)
    b = bbox(geom)
    near = (b["xmin"] <= x1) & (b["xmax"] >= x0) & (b["ymin"] <= y1) & (b["ymax"] >= y0)
    return near & (distance_m(geom, lon0, lat0) <= radius_m)


def square(lon: Column, lat: Column, side: float = 0.001) -> Column:
    """Closed 5-point square polygon (counter-clockwise) with its south-west corner at (lon, lat)."""
    x1, y1 = lon + side, lat + side
    ring = F.array(F.array(lon, lat), F.array(x1, lat), F.array(x1, y1), F.array(lon, y1), F.array(lon, lat))
    return F.array(F.array(ring))
