"""Centroid and validity of multipolygons by whole Arrow batches, for tables whose every row is measured.

The sums are those of ``geo.centroid`` and ``geo.validity``, in the same order, taken over the points of a batch at once
instead of a lambda call per point.  What a batch does not tell is left to those expressions, row by row: geometries that hold
a null, nothing, or a point without two coordinates, and whether a ring that is not convex crosses itself.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from snapledger.operators import geo

cloudpickle.register_pickle_by_value(sys.modules[__name__])            # the functions go to executors that have no copy of this package
TOLD = "struct<plain: boolean, lon: double, lat: double, valid: boolean>"


def _children(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(the list that each element is in, the elements, elements per list)."""
    of = pc.list_parent_indices(lists).to_numpy()
    return of, pc.list_flatten(lists), np.bincount(of, minlength=len(lists))


def _null(values: pa.Array) -> np.ndarray:
    return values.is_null().to_numpy(zero_copy_only=False)


def _all(of: np.ndarray, holds: np.ndarray, n: int) -> np.ndarray:
    """For each of n groups, whether it holds for all members."""
    return np.bincount(of, ~holds, minlength=n) == 0


def measure(geom: pa.Array) -> pa.Array:
    """A ``TOLD`` per geometry; ``plain`` is false, or ``valid`` null, where the batch does not tell."""
    n = len(geom)
    row, polys, n_polys = _children(geom)
    poly, rings, n_rings = _children(polys)
    ring, points, n_points = _children(rings)
    point, values, n_values = _children(points)
    if not len(values):
        return pa.array([{"plain": False}] * n, pa.struct([("plain", pa.bool_()), ("lon", pa.float64()), ("lat", pa.float64()), ("valid", pa.bool_())]))
    # what is odd makes everything odd that it is part of
    odd_point = _null(points) | (n_values < 2) | ~_all(point, ~_null(values), len(points))
    odd_ring = _null(rings) | (n_points == 0) | ~_all(ring, ~odd_point, len(rings))
    odd_poly = _null(polys) | (n_rings == 0) | ~_all(poly, ~odd_ring, len(polys))
    plain = ~(_null(geom) | (n_polys == 0) | ~_all(row, ~odd_poly, n))

    last = len(values) - 1
    numbers = values.fill_null(0.0).to_numpy()
    at = np.cumsum(n_values) - n_values
    x, y = numbers[np.minimum(at, last)], numbers[np.minimum(at + 1, last)]
    first = np.minimum(np.cumsum(n_points) - n_points, len(points) - 1)
    x0, y0, x1, y1 = x[first], y[first], x[first + np.maximum(n_points, 1) - 1], y[first + np.maximum(n_points, 1) - 1]
    dx, dy = x - x0[ring], y - y0[ring]
    a, b = np.flatnonzero(ring[1:] == ring[:-1]), np.flatnonzero(ring[1:] == ring[:-1]) + 1
    side = ring[a]

    def total(of, what, m):
        return np.bincount(of, what, minlength=m)                     # adds up in the order of the members

    with np.errstate(all="ignore"):
        cr = dx[a] * dy[b] - dx[b] * dy[a]
        enough = n_points >= 4
        area, mx, my = (np.where(enough, total(side, v, len(rings)), 0.0) for v in (cr / 2, (dx[a] + dx[b]) * cr / 6, (dy[a] + dy[b]) * cr / 6))
        outer = np.arange(len(rings)) == (np.cumsum(n_rings) - n_rings)[poly]
        w = np.where(outer, 1.0, -1.0) * np.sign(area)
        moments = [total(row, total(poly, w * v, len(polys)), n) for v in (area, mx + area * x0, my + area * y0)]
        there = plain & (moments[0] != 0)
        lon, lat = moments[1] / moments[0], moments[2] / moments[0]
        finite = _all(ring, (np.abs(x) <= 180) & (np.abs(y) <= 90), len(rings))
        sound = enough & finite & (x0 == x1) & (y0 == y1) & (~outer | (np.abs(area) > 0))
        convex = sound & _convex(x, y, a, b, side, len(rings))
    sound, convex = (_all(row, _all(poly, v, len(polys)), n) for v in (sound, convex))
    return pa.StructArray.from_arrays(
        [pa.array(plain), pa.array(lon, mask=~there), pa.array(lat, mask=~there), pa.array(convex, mask=~plain | (sound & ~convex))],
        ["plain", "lon", "lat", "valid"])


def _convex(x, y, a, b, side, n) -> np.ndarray:
    """Closed rings that turn one way at every corner, and once around in all: such a ring can't cross itself."""
    ex, ey = x[b] - x[a], y[b] - y[a]
    begins = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    after = np.arange(len(side)) + 1
    after[np.r_[begins[1:], len(side)] - 1] = begins                   # the edge after a ring's last is its first
    turn = ex * ey[after] - ey * ex[after]
    around = np.bincount(side, np.arctan2(turn, ex * ex[after] + ey * ey[after]), minlength=n)
    return (_all(side, turn > 0, n) | _all(side, turn < 0, n)) & (np.abs(around) < 3 * np.pi)


def told(geom: Column) -> Column:
    """``measure`` of a column of geometries, as one column for ``centroid`` and ``is_valid``."""
    @F.arrow_udf(returnType=TOLD)
    def measured(shapes: pa.Array) -> pa.Array:
        return measure(shapes)
    return measured(geom)


def centroid(told: Column, geom: Column) -> Column:
    """As ``geo.centroid``."""
    return F.when(told["plain"], F.struct(told["lon"].alias("lon"), told["lat"].alias("lat"))).otherwise(geo.centroid(geom))


def is_valid(told: Column, geom: Column) -> Column:
    """As ``geo.is_valid``."""
    return F.when(told["valid"].isNotNull(), told["valid"]).otherwise(geo.is_valid(geom))
