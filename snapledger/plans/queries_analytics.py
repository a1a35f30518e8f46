"""Registered queries: histograms, rates, summaries, top categories, exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapledger.functions.values import ts_ntz
from snapledger.operators import explore, stats
from snapledger.plans import domain, parcelish
from snapledger.plans.registry import register
from snapledger.plans.tables import table
from snapledger.session import cut_lineage

P = f"WITH p AS ({parcelish.duck_sql()})"
AREA = "CASE WHEN tax_district = '4' THEN 'Girdwood' ELSE 'Rest of the Muni' END"
IS_HOME = "property_type = 'Residential' AND appraised_building_value > 0"
HAS_PRE = "exemption_6_type = 'OWNERS PRIMARY RESIDENCE'"
NOW = "2026-07-01 00:00:00"


def _p(spark, d):
    return parcelish.parcels(spark, d, with_geometry=False)


def _share_sql(inner, bin_name="bin_lo"):
    return f"""{P}, binned AS ({inner})
SELECT area, {bin_name}, count(*) AS n, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY area) AS share
FROM binned WHERE {bin_name} IS NOT NULL GROUP BY area, {bin_name}"""


@register("hist_linear", _share_sql(
    f"SELECT {AREA} AS area, least(floor(appraised_total_value / 100000) * 100000, 2000000) AS bin_lo "
    f"FROM p WHERE appraised_total_value > 0"))
def q_hist_linear(spark, d):
    p = _p(spark, d).filter(F.col("appraised_total_value") > 0)
    return stats.share_histogram(p, domain.area_of(), stats.linear_bin(F.col("appraised_total_value"), 100000, 2000000))


@register("hist_exempt_amount", _share_sql(
    f"SELECT {AREA} AS area, floor(exemption_6_amount / 5000) * 5000 AS bin_lo FROM p WHERE {IS_HOME} AND {HAS_PRE}"))
def q_hist_exempt_amount(spark, d):
    p = _p(spark, d).filter(domain.is_home() & domain.has_pre())
    return stats.share_histogram(p, domain.area_of(), stats.linear_bin(F.col("exemption_6_amount"), 5000))


@register("hist_log", _share_sql(
    f"SELECT {AREA} AS area, round(pow(10, floor(log10(appraised_land_value) * 4) / 4), 4) AS bin_lo "
    f"FROM p WHERE appraised_land_value > 0"))
def q_hist_log(spark, d):
    p = _p(spark, d).filter(F.col("appraised_land_value") > 0)
    return stats.share_histogram(p, domain.area_of(), F.round(stats.log_bin(F.col("appraised_land_value")), 4))


@register("hist_decade", _share_sql(
    f"SELECT {AREA} AS area, CAST((year_built_min // 10) * 10 AS INTEGER) AS decade FROM p "
    f"WHERE year_built_min BETWEEN 1900 AND 2026", "decade"))
def q_hist_decade(spark, d):
    p = _p(spark, d).filter(F.col("year_built_min").between(1900, 2026))
    return stats.share_histogram(p, domain.area_of(), stats.decade(F.col("year_built_min")), "decade")


@register("rate_by_bin", f"""{P}
SELECT {AREA} AS area, least(floor(appraised_total_value / 200000) * 200000, 2000000) AS bin_lo,
       count(*) AS n, count(*) FILTER (WHERE {HAS_PRE})::DOUBLE / count(*) AS rate
FROM p WHERE {IS_HOME} GROUP BY 1, 2""")
def q_rate_by_bin(spark, d):
    p = _p(spark, d).filter(domain.is_home())
    return stats.rate_by(p, [domain.area_of().alias("area"),
                             stats.linear_bin(F.col("appraised_total_value"), 200000, 2000000).alias("bin_lo")],
                         domain.has_pre())


@register("group_summary", f"""{P}
SELECT {AREA} AS area, count(*) AS parcels, round(median(appraised_total_value), 2) AS median_value,
       round(median(year_built_min), 2) AS median_year_built
FROM p WHERE property_type = 'Residential' GROUP BY 1""")
def q_group_summary(spark, d):
    p = _p(spark, d).filter(domain.property_filter("Residential"))
    s = stats.summary(p, domain.area_of().alias("area"),
                      {"median_value": domain.value_column("Land + structures"),
                       "median_year_built": F.col("year_built_min")})
    return s.select("area", "parcels", F.round("median_value", 2).alias("median_value"),
                    F.round("median_year_built", 2).alias("median_year_built"))


@register("home_stats", f"""{P}
SELECT {AREA} AS area, count(*) AS homes, count(*) FILTER (WHERE {HAS_PRE}) AS exempt_homes,
       count(*) FILTER (WHERE {HAS_PRE})::DOUBLE / count(*) AS rate,
       round(median(exemption_6_amount) FILTER (WHERE {HAS_PRE}), 2) AS median_amount,
       sum(exemption_6_amount) FILTER (WHERE {HAS_PRE}) AS total_amount
FROM p WHERE {IS_HOME} GROUP BY 1""")
def q_home_stats(spark, d):
    p = _p(spark, d).filter(domain.is_home())
    pre = domain.has_pre()
    rows = cut_lineage(p.select(domain.area_of().alias("area"), pre.alias("pre"), F.when(pre, F.col("exemption_6_amount")).alias("amount")), "homes")
    g = rows.groupBy("area").agg(
        F.count(F.lit(1)).alias("homes"), F.count_if("pre").alias("exempt_homes"),
        (F.count_if("pre") / F.count(F.lit(1))).alias("rate"), F.sum("amount").alias("total_amount"))
    return stats.with_medians(g, rows, "area", {"median_amount": "amount"}).withColumn("median_amount", F.round("median_amount", 2))


# a category is among the ten most common if fewer than ten others stand before it, by number and then by name
@register("top_categories", f"""{P},
named AS (SELECT {AREA} AS area, CASE WHEN land_use IS NULL THEN 'Unknown' ELSE land_use END AS category FROM p),
places AS (SELECT category, count(*) AS rows_in FROM named GROUP BY category),
areas AS (SELECT area, count(*) AS area_rows FROM named GROUP BY area)
SELECT named.area, named.category, count(*) AS n, CAST(count(*) AS DOUBLE) / any_value(areas.area_rows) AS share
FROM named JOIN areas ON areas.area = named.area JOIN places a ON a.category = named.category
WHERE 10 > (SELECT count(*) FROM places b WHERE b.rows_in > a.rows_in OR (b.rows_in = a.rows_in AND b.category < a.category))
GROUP BY named.area, named.category""")
def q_top_categories(spark, d):
    return stats.top_categories(_p(spark, d), domain.area_of(), F.col("land_use"))


# ----------------------------------------------------------------------------- exploration
@register("explore_table", f"""{P}
SELECT parcel_id,
  CASE WHEN appraised_total_value IS NOT NULL THEN least(appraised_total_value, 2000000) END AS total_value_capped,
  CASE WHEN appraised_land_value IS NOT NULL THEN least(appraised_land_value, 1000000) END AS land_value_capped,
  CASE WHEN appraised_building_value IS NOT NULL THEN least(appraised_building_value, 1000000) END AS building_value_capped,
  CASE WHEN year_built_min BETWEEN 1900 AND 2026 THEN year_built_min END AS year_built_clean,
  CASE WHEN deed_date BETWEEN TIMESTAMP '1950-01-01' AND TIMESTAMP '{NOW}' THEN deed_date END AS deed_date_clean
FROM p""")
def q_explore_table(spark, d):
    t = explore.load_explore_table(_p(spark, d), 2026, ts_ntz(NOW))
    return t.select("parcel_id", "total_value_capped", "land_value_capped", "building_value_capped",
                    "year_built_clean", "deed_date_clean")


def _views():
    t = F.col("total_value_capped")
    return {"value": stats.linear_bin(t, 100000),
            "year": stats.decade(F.col("year_built_clean")).cast("double"),
            "building": stats.linear_bin(F.col("building_value_capped"), 100000)}


def _clauses():
    return {"value": explore.interval(F.col("total_value_capped"), 100000, 500000),
            "year": explore.interval(F.col("year_built_clean"), 1950, 1990),
            "building": None}


_XF_BASE = f"""{P}, t AS (SELECT
  CASE WHEN appraised_total_value IS NOT NULL THEN least(appraised_total_value, 2000000) END AS tv,
  CASE WHEN appraised_building_value IS NOT NULL THEN least(appraised_building_value, 1000000) END AS bv,
  CASE WHEN year_built_min BETWEEN 1900 AND 2026 THEN year_built_min END AS yb FROM p)"""


@register("crossfilter_hist", f"""{_XF_BASE}
SELECT 'value' AS view, floor(tv / 100000) * 100000 AS bin, count(*) AS total,
       count(*) FILTER (WHERE yb BETWEEN 1950 AND 1990) AS filtered FROM t WHERE tv IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT 'year', CAST((yb // 10) * 10 AS DOUBLE), count(*),
       count(*) FILTER (WHERE tv BETWEEN 100000 AND 500000) FROM t WHERE yb IS NOT NULL GROUP BY 1, 2
UNION ALL
SELECT 'building', floor(bv / 100000) * 100000, count(*),
       count(*) FILTER (WHERE tv BETWEEN 100000 AND 500000 AND yb BETWEEN 1950 AND 1990)
FROM t WHERE bv IS NOT NULL GROUP BY 1, 2""")
def q_crossfilter_hist(spark, d):
    t = explore.load_explore_table(_p(spark, d), 2026, ts_ntz(NOW))
    return explore.crossfilter_histograms(t, _views(), _clauses())


@register("is_filtered", f"""{_XF_BASE}
SELECT count(*) AS rows, count(*) FILTER (WHERE tv BETWEEN 100000 AND 500000 AND yb BETWEEN 1950 AND 1990) AS selected,
       count(*) FILTER (WHERE tv BETWEEN 100000 AND 500000 AND yb BETWEEN 1950 AND 1990) < count(*) AS is_filtered FROM t""")
def q_is_filtered(spark, d):
    t = explore.load_explore_table(_p(spark, d), 2026, ts_ntz(NOW))
    return explore.is_filtered(t, _clauses())


@register("density_2d", """
SELECT CAST(floor(l_extendedprice / 5000) AS BIGINT) AS ix, CAST(floor(l_quantity / 5) AS BIGINT) AS iy, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def q_density_2d(spark, d):
    li = table(spark, d, "lineitem")
    return explore.density_2d(li, F.col("l_extendedprice"), F.col("l_quantity"), 5000, 5)


@register("auto_hist", """
WITH x AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
r AS (SELECT greatest((hi - lo) / 40, 1e-12) AS raw FROM st),
p AS (SELECT raw, pow(10, floor(log10(raw))) AS p10 FROM r),
s AS (SELECT CASE WHEN raw / p10 <= 1 THEN p10 WHEN raw / p10 <= 2 THEN 2 * p10
                  WHEN raw / p10 <= 5 THEN 5 * p10 ELSE 10 * p10 END AS step FROM p)
SELECT floor(v / step) * step AS bin_lo, floor(v / step) * step + step AS bin_hi, count(*) AS n
FROM x, s GROUP BY 1, 2""")
def q_auto_hist(spark, d):
    return explore.auto_histogram(table(spark, d, "lineitem"), F.col("l_extendedprice"))


_PROFILE_COLS = ("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate", "l_discount")


@register("profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
        count(DISTINCT {c}) AS distinct, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max
        FROM lineitem""" for c in _PROFILE_COLS))
def q_profile(spark, d):
    return explore.profile(table(spark, d, "lineitem"), _PROFILE_COLS, exact=True)


@register("page", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 75")
def q_page(spark, d):
    return explore.page(table(spark, d, "orders"), ["o_orderkey"], 3)


@register("category_index", f"""{P}, c AS (SELECT DISTINCT land_use FROM p WHERE land_use IS NOT NULL)
SELECT land_use, row_number() OVER (ORDER BY land_use) - 1 AS idx,
       (row_number() OVER (ORDER BY land_use) - 1) % 10 AS palette_slot FROM c""")
def q_category_index(spark, d):
    return explore.category_index(_p(spark, d), "land_use")


@register("normalise_fmt", f"""{P}
SELECT parcel_id,
  CASE WHEN appraised_total_value IS NOT NULL
       THEN (least(greatest(appraised_total_value, 0), 2000000) - 0) / 2000000 END AS color_value,
  CASE WHEN year_built_min IS NOT NULL THEN (least(greatest(year_built_min, 1950), 2026) - 1950) / 76.0 END AS color_year,
  coalesce('$' || format('{{:,}}', round(taxable_value)::BIGINT), 'n/a') AS taxable_text
FROM p""")
def q_normalise_fmt(spark, d):
    p = _p(spark, d)
    return p.select("parcel_id",
                    explore.normalise(F.col("appraised_total_value"), 0, 2000000).alias("color_value"),
                    explore.normalise(F.col("year_built_min"), 1950, 2026).alias("color_year"),
                    explore.fmt_dollars(F.col("taxable_value")).alias("taxable_text"))


@register("sample_seeded", """
SELECT doc_id, lang, source, n_chars FROM documents
ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 25""")
def q_sample_seeded(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return explore.sample_rows(docs, "doc_id", 25, seed=7)


_TOP_COLS = ("land_use", "owner_state", "tax_district", "exemption_6_type")


@register("profile_top_values", f"""{P}, u AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM p" for c in _TOP_COLS)}),
c AS (SELECT "column", value, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c)
SELECT * FROM r WHERE rank <= 5""")
def q_profile_top_values(spark, d):
    return explore.top_values(_p(spark, d), _TOP_COLS, 5)
