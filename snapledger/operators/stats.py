"""Bins, share histograms, rates, group summaries, top categories.

All shares are computed *after* aggregation: the window (or join) runs over
(group, bin) rows, whose count is bounded by groups x bins, never by the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.session import cut_lineage

# --- fixed values ------------------------------------------------------------------
M2_PER_ACRE = 4046.8564224
# -----------------------------------------------------------------------------------


def linear_bin(x: Column, width: float, cap: float | None = None) -> Column:
    """floor(x / w) * w as DOUBLE, optionally lumped at ``cap``."""
    b = F.floor(x / width).cast("double") * float(width)
    return F.least(b, F.lit(float(cap))) if cap is not None else b


def log_bin(x: Column, per_decade: int = 4) -> Column:
    """Quarter-decade log bins: 10^(floor(log10(x) * 4) / 4); x <= 0 -> NULL."""
    return F.when(x > 0, F.pow(F.lit(10.0), F.floor(F.log10(x) * per_decade).cast("double") / per_decade))


def decade(year: Column) -> Column:
    """(y // 10) * 10 for non-negative integer years."""
    y = year.cast("int")
    return y - F.pmod(y, F.lit(10))


def share_histogram(df: DataFrame, group: Column | str, bin_expr: Column, bin_name: str = "bin_lo",
                    group_name: str = "area") -> DataFrame:
    """(group, bin, n, share-of-group); NULL bins are dropped like the source rows they come from."""
    g = F.col(group) if isinstance(group, str) else group
    counts = (df.select(g.alias(group_name), bin_expr.alias(bin_name))
              .filter(F.col(bin_name).isNotNull())
              .groupBy(group_name, bin_name).agg(F.count(F.lit(1)).alias("n")))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group_name)))


def rate_by(df: DataFrame, groups: Sequence[Column], pred: Column) -> DataFrame:
    """Per group: n and the share of rows satisfying ``pred`` (NULL counts as no)."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"),
                                   (F.count_if(pred) / F.count(F.lit(1))).alias("rate"))


MEDIAN_ROWS = 100_000      # distinct values of a group that one window puts in order
BORDERS = 63               # quantiles that narrow a larger group in a round


def exact_medians(df: DataFrame, group: str, measures: dict[str, str], most: int = MEDIAN_ROWS) -> DataFrame:
    """(group, *names): the exact median of each (name, value column) per group, without gathering a group in one task.

    All measures come from one pass over ``df``: equal values of a group become one counted row, and the counted
    rows are written.  A group with more than ``most`` of them is narrowed first, all such groups at once:
    ``BORDERS`` quantiles of its counted rows cut it into slices of about equally many rows, whatever the
    distribution, cumulative counts (a few rows a group) tell which slices hold the middle, and only those
    stay, until they have at most ``most`` rows.

    Whole numbers and decimals are ordered as such, beyond 2^53 too; the result is a double.  NULLs don't count; a
    measure without values is NULL, and a group without any value has no row.
    """
    kinds: dict[str, list[str]] = {}
    for name, column in measures.items():
        kind = df.schema[column].dataType.simpleString()
        kind = "decimal(38,0)" if kind == "bigint" else kind if kind.startswith("decimal") else "double"
        kinds.setdefault(kind, []).append(name)
    found = []
    for kind, names in kinds.items():
        values = ", ".join(f"{n}, CAST(`{measures[name]}` AS {kind})" for n, name in enumerate(names))
        rows = df.select(F.col(group).alias("_g"), F.expr(f"stack({len(names)}, {values}) AS (_m, _v)")).where("_v IS NOT NULL")
        counts = cut_lineage(rows.groupBy("_g", "_m", "_v").agg(F.count(F.lit(1)).alias("_n")), "median-counts")
        middle = _middles(counts, most)
        found.append(middle.groupBy("_g").agg(*(F.max(F.when(F.col("_m") == n, F.col("_median"))).alias(name) for n, name in enumerate(names))))
    out = found[0]
    for more in found[1:]:
        more = more.withColumnRenamed("_g", "_h")
        out = out.join(more, F.col("_g").eqNullSafe(F.col("_h")), "full_outer").withColumn("_g", F.coalesce("_g", "_h")).drop("_h")
    return out.select(F.col("_g").alias(group), *measures)


def exact_median(df: DataFrame, group: str, value: str, name: str, most: int = MEDIAN_ROWS) -> DataFrame:
    """(group, name): see ``exact_medians``."""
    return exact_medians(df, group, {name: value}, most)


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}._g").eqNullSafe(F.col(f"{b}._g")) & (F.col(f"{a}._m") == F.col(f"{b}._m"))


def _holds(rank: Column, before: str = "_before", n: str = "_n") -> Column:
    return (F.col(before) < rank) & (F.col(before) + F.col(n) >= rank)


def _ranks() -> tuple[Column, Column]:
    """The places of the lower and the upper middle value."""
    return F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)


def _middles(counts: DataFrame, most: int) -> DataFrame:
    """(_g, _m, _median) of counted rows (_g, _m, _v, _n)."""
    low_rank, high_rank = _ranks()
    sizes = cut_lineage(counts.groupBy("_g", "_m").agg(F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo")), "median-sizes")
    start = sizes.withColumn("_before", F.lit(0).cast("long"))
    left = counts
    # quantiles are doubles: exact values are told by their distance from the least one left
    exact = dict(counts.dtypes)["_v"] != "double"
    away = (F.col("a._v") - F.col("b._lo")).cast("double") if exact else F.col("a._v")
    while not start.where(F.col("_rows") > most).isEmpty():
        large = start.where(F.col("_rows") > most)
        wide = left.alias("a").join(large.alias("b"), _same("a", "b")).select("a.*", "b._total", F.col("b._before").alias("_from"), away.alias("_x"))
        borders = wide.groupBy("_g", "_m").agg(F.percentile_approx("_x", [i / (BORDERS + 1) for i in range(1, BORDERS + 1)]).alias("_borders"))
        at = F.size(F.filter("_borders", lambda x: x < F.col("_x")))
        sliced = wide.alias("a").join(borders.alias("b"), _same("a", "b")).select("a.*", at.alias("_slice"))
        order = Window.partitionBy("_g", "_m").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        sums = (sliced.groupBy("_g", "_m", "_slice").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.first("_total").alias("_total"),
                                                       F.first("_from").alias("_from"))
                .withColumn("_before", F.col("_from") + F.coalesce(F.sum("_n").over(order), F.lit(0))))
        kept = sums.where((F.col("_before") < high_rank) & (F.col("_before") + F.col("_n") >= low_rank))
        inner = sliced.alias("a").join(kept.alias("b"), _same("a", "b") & (F.col("a._slice") == F.col("b._slice")), "left_semi").select("_g", "_m", "_v", "_n")
        small = start.where(F.col("_rows") <= most)
        rest = left.alias("a").join(small.alias("b"), _same("a", "b"), "left_semi")
        inner = cut_lineage(inner, "median-slices")
        least = inner.groupBy("_g", "_m").agg(F.min("_v").alias("_lo"))
        narrowed = kept.groupBy("_g", "_m").agg(F.first("_total").alias("_total"), F.sum("_rows").alias("_rows"), F.min("_before").alias("_before"))
        narrowed = narrowed.alias("a").join(least.alias("b"), _same("a", "b")).select("a.*", "b._lo")
        left, start = rest.unionByName(inner), cut_lineage(small.unionByName(narrowed), "median-sizes")
    inside = Window.partitionBy("_g", "_m").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (left.alias("a").join(start.alias("b"), _same("a", "b")).select("a.*", "b._total", F.col("b._before").alias("_from"))
              .withColumn("_before", F.col("_from") + F.coalesce(F.sum("_n").over(inside), F.lit(0))))
    low, high = (F.max(F.when(_holds(rank), F.col("_v"))).cast("double") for rank in (low_rank, high_rank))
    return ranked.groupBy("_g", "_m").agg(F.when(low == high, low).otherwise(low / 2 + high / 2).alias("_median"))


def with_medians(grouped: DataFrame, df: DataFrame, group: str, measures: dict[str, str]) -> DataFrame:
    """``grouped`` (one row per group) with an exact median per (name, value column); NULL where there are no values."""
    m = exact_medians(df, group, measures).withColumnRenamed(group, "_group")
    return grouped.join(m, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def summary(df: DataFrame, group: Column, measures: dict[str, Column], count_name: str = "parcels") -> DataFrame:
    """Group card: row count plus exact medians of the given measures.  ``group`` must carry an alias."""
    rows = cut_lineage(df.select(group, *[m.alias(f"_{name}") for name, m in measures.items()]), "summary")
    key = rows.columns[0]
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    return with_medians(counts, rows, key, {name: f"_{name}" for name in measures})


def top_categories(df: DataFrame, group: Column, category: Column, k: int = 10,
                   group_name: str = "area", cat_name: str = "category") -> DataFrame:
    """Shares by group for the k categories most common overall (NULL -> 'Unknown').

    Ties in the overall ranking are broken by name.  The top-k set has k rows,
    so the semi join broadcasts a proven-small side.
    """
    counts = (df.select(group.alias(group_name), F.coalesce(category, F.lit("Unknown")).alias(cat_name))
              .groupBy(group_name, cat_name).agg(F.count(F.lit(1)).alias("n")))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group_name)))
    top = (counts.groupBy(cat_name).agg(F.sum("n").alias("_t"))
           .orderBy(F.desc("_t"), cat_name).limit(k).select(cat_name))
    return shares.join(F.broadcast(top), cat_name, "left_semi")


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DISTINCT ON (cols): one row per combination (other columns must be functions of it)."""
    return df.dropDuplicates(list(cols))
