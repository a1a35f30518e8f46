"""Cross-filtered exploration: derived columns, selections, fused histograms, profiles.

A selection is a dict ``{view_name: Column or None}``.  Each view is filtered by
the clauses of all *other* views (cross-filter).  Several views' histograms are
answered by ONE scan: rows are unpivoted to (view, bin) and each bin carries
both the background count and the count under that view's cross-filter.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.values import capped, fmt_dollars, guarded, normalise  # noqa: F401
from snapledger.operators import geo
from snapledger.session import cut_lineage

# --- fixed values ------------------------------------------------------------------
DEFAULT_RADIUS_M, MIN_RADIUS_M, MAX_RADIUS_M, RADIUS_STEP_M = 1500, 100, 10000, 100
MAX_BINS = 40
PAGE_SIZE = 25
PALETTE_SIZE = 10
# -----------------------------------------------------------------------------------


def load_explore_table(df: DataFrame, as_of_year: int, now_ts: Column) -> DataFrame:
    """Current rows plus the capped / cleaned columns the filter charts use."""
    return df.withColumns({
        "total_value_capped": capped(F.col("appraised_total_value"), 2000000),
        "land_value_capped": capped(F.col("appraised_land_value"), 1000000),
        "building_value_capped": capped(F.col("appraised_building_value"), 1000000),
        "year_built_clean": guarded(F.col("year_built_min"), 1900, as_of_year),
        "deed_date_clean": guarded(F.col("deed_date"), F.lit("1950-01-01 00:00:00").cast("timestamp_ntz"), now_ts),
    })


def _and(preds: Sequence[Column]) -> Column:
    out = F.lit(True)
    for p in preds:
        out = out & p
    return out


def crossfilter(clauses: dict[str, Column | None]) -> dict[str, Column]:
    """Per view: the AND of every other view's clause (missing clauses are dropped)."""
    return {v: _and([c for w, c in clauses.items() if w != v and c is not None]) for v in clauses}


def is_filtered(df: DataFrame, clauses: dict[str, Column | None]) -> DataFrame:
    """One row: total rows, rows under all clauses, and whether the selection filters anything."""
    allp = _and([c for c in clauses.values() if c is not None])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(allp).alias("selected")) \
        .withColumn("is_filtered", F.col("selected") < F.col("rows"))


def interval(col: Column, lo, hi) -> Column:
    return col.between(lo, hi)


def interval_2d(x: Column, y: Column, x0, x1, y0, y1) -> Column:
    return x.between(x0, x1) & y.between(y0, y1)


def radius(lon: Column, lat: Column, lon0: float, lat0: float, radius_m: float = DEFAULT_RADIUS_M) -> Column:
    """Map brush clause: box pre-filter (pushdown-able) AND the exact centroid distance test."""
    if not MIN_RADIUS_M <= radius_m <= MAX_RADIUS_M:
        raise ValueError(f"radius {radius_m} m is not within {MIN_RADIUS_M} .. {MAX_RADIUS_M}")
    return geo.radius_bbox(lon, lat, lon0, lat0, radius_m) & geo.near_centroid(lon, lat, lon0, lat0, radius_m)


def crossfilter_histograms(df: DataFrame, views: dict[str, Column], clauses: dict[str, Column | None]) -> DataFrame:
    """(view, bin, total, filtered) for every view in one scan; NULL bins dropped."""
    per_view = crossfilter({v: clauses.get(v) for v in views})
    rows = F.array(*[F.struct(F.lit(v).alias("view"), b.cast("double").alias("bin"),
                              per_view[v].alias("hit")) for v, b in views.items()])
    u = df.select(F.inline(rows)).filter(F.col("bin").isNotNull())
    return u.groupBy("view", "bin").agg(F.count(F.lit(1)).alias("total"),
                                        F.count_if(F.col("hit")).alias("filtered"))


def nice_step(raw: Column) -> Column:
    """Smallest of 1, 2, 5 x 10^k that is >= raw (raw > 0)."""
    p = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    m = raw / p
    return F.when(m <= 1, p).when(m <= 2, 2 * p).when(m <= 5, 5 * p).otherwise(10 * p)


def auto_histogram(df: DataFrame, col: Column, maxbins: int = MAX_BINS, name: str = "value") -> DataFrame:
    """Equal-width bins with a 'nice' step giving at most ``maxbins`` bins: (bin_lo, bin_hi, n).

    The min/max pass is a one-row aggregate joined back lazily (no driver round trip).
    """
    x = df.select(col.cast("double").alias(name)).filter(F.col(name).isNotNull())
    st = x.agg(F.min(name).alias("_lo"), F.max(name).alias("_hi"))
    raw = F.greatest((F.col("_hi") - F.col("_lo")) / maxbins, F.lit(1e-12))
    st = st.withColumn("_step", nice_step(raw))
    b = x.crossJoin(st).withColumn("bin_lo", F.floor(F.col(name) / F.col("_step")) * F.col("_step"))
    return b.groupBy("bin_lo", "_step").agg(F.count(F.lit(1)).alias("n")).select(
        "bin_lo", (F.col("bin_lo") + F.col("_step")).alias("bin_hi"), "n")


def density_2d(df: DataFrame, x: Column, y: Column, px: float, py: float) -> DataFrame:
    """Raster counts on a (px, py) pixel grid: (ix, iy, n)."""
    return (df.select(F.floor(x / px).alias("ix"), F.floor(y / py).alias("iy"))
            .filter(F.col("ix").isNotNull() & F.col("iy").isNotNull())
            .groupBy("ix", "iy").agg(F.count(F.lit(1)).alias("n")))


def profile(df: DataFrame, cols: Sequence[str], exact: bool = False) -> DataFrame:
    """Per column in ONE aggregation: rows, nulls, distinct (approx unless exact), min, max (as text)."""
    aggs = []
    for c in cols:
        d = F.count_distinct(c) if exact else F.approx_count_distinct(c)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"), d.alias(f"{c}__distinct"),
                 F.min(c).cast("string").alias(f"{c}__min"), F.max(c).cast("string").alias(f"{c}__max")]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col("__rows").alias("rows"),
                              F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__distinct").alias("distinct"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in cols])
    return wide.select(F.inline(rows))


def top_values(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Per column, the k most frequent non-NULL values (as text), ties broken by value.

    One scan: rows are unpivoted to (column, value), counted with partial
    aggregation, then ranked per column over the aggregated rows only.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k)


def numbered(df: DataFrame, order: Sequence[str], name: str = "nth") -> DataFrame:
    """``df`` with each row's place (from 0) in the order of the columns, NULLs first; no task holds more than a range of it.

    Rows are range-partitioned and written; each range is numbered on its own and starts where the counts of
    the ranges before it end (a row per range).
    """
    dealt = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    own = Window.partitionBy("_range").orderBy(*order)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)                 # over ranges, not rows
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_in")).withColumn("_start", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    placed = dealt.withColumn("_own", F.row_number().over(own) - 1).join(F.broadcast(starts.drop("_in")), "_range")
    return placed.withColumn(name, F.col("_start") + F.col("_own")).drop("_range", "_own", "_start")


def page_starts(df: DataFrame, order: Sequence[str], size: int = PAGE_SIZE) -> DataFrame:
    """(page, *order): the first key of every page, an index to keep beside a table that is read page by page."""
    return numbered(df.select(*order), order).where(F.col("nth") % size == 0).select((F.col("nth") / size).cast("long").alias("page"), *order)


def page(df: DataFrame, order: Sequence[str], page_no: int, size: int = PAGE_SIZE, starts: DataFrame | None = None) -> DataFrame:
    """Rows [page_no * size, (page_no + 1) * size) in key order (the page *is* the feature), read as one range of keys.

    ``order`` must tell rows apart.  ``starts`` is ``page_starts`` where it is at hand; the range's ends are the keys of
    this page and the next, so the scan skips what lies outside and nothing is sorted but the page.
    """
    starts = page_starts(df, order, size) if starts is None else starts
    ends = {r["page"]: r for r in starts.where(F.col("page").isin(page_no, page_no + 1)).collect()}          # two rows
    if page_no not in ends:
        return df.limit(0)

    def key(row) -> Column:
        return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in order])

    first, here = order[0], F.struct(*[F.col(c) for c in order])
    rows = df.where(here >= key(ends[page_no]))
    if ends[page_no][first] is not None:
        rows = rows.where(F.col(first) >= F.lit(ends[page_no][first]))                                       # reaches the scan
    if page_no + 1 in ends:
        rows = rows.where(here < key(ends[page_no + 1]))
        if ends[page_no + 1][first] is not None:
            rows = rows.where(F.col(first).isNull() | (F.col(first) <= F.lit(ends[page_no + 1][first])))
    return rows.sort(*order)


def map_feed(df: DataFrame, cols: Sequence[str], color: str, geom: str, selection: Column | None = None) -> DataFrame:
    d = df.select(*cols, color, geom).filter(F.col(geom).isNotNull())
    if selection is not None:
        d = d.filter(selection)
    return d.orderBy(F.asc_nulls_first(color), *cols)


def category_index(df: DataFrame, col: str, palette: int = PALETTE_SIZE) -> DataFrame:
    """Distinct non-NULL categories, numbered in sorted order (``numbered``), with a palette slot."""
    d = numbered(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], "idx")
    return d.select(col, F.col("idx").cast("int").alias("idx"), F.pmod("idx", F.lit(palette)).cast("int").alias("palette_slot"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """A repeatable pseudo-random sample of ``n`` rows (the limit *is* the feature).

    Rows are ranked by md5(seed || key) and the n smallest kept: a distributed
    top-k (per-partition top n, then a merge of n-row lists), no global sort.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_sample_rank", h).orderBy("_sample_rank", key).limit(n).drop("_sample_rank")
