"""Tables for the parcel audit in which every rule is broken somewhere, and their oracle.

One row per order (``parcelish``), with faults put in by key arithmetic: wrong values in some rows, odd shapes,
three merged runs in which keys come, change, go and return, a few rows that no merge would write, a published
copy that lacks rows, shapes and centroids, and labels that the rules would not give.  Spark merges the runs; the
oracle tells the history in closed form from the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.text import CORPORATE_NAME_PATTERN
from snapledger.functions.values import ts_ntz
from snapledger.operators import geo, rules, scd2
from snapledger.plans import parcelish, parcels
from snapledger.plans.tables import table
from snapledger.session import cut_lineage, deal
from snapledger.sources import publish, store

RUNS = ("2001-07-01 00:00:00", "2001-07-20 00:00:00", "2001-08-04 00:00:00")
AS_OF = "2001-08-20 00:00:00"
_OWNER, _USE = next(iter(rules.OWNER_IDENTIFYING_BASES)), next(iter(rules.USE_IDENTIFYING_BASES))

# Wrong values: column -> (condition on k, value) in order; the same text runs in both engines.
_FAULTS: dict[str, list[tuple[str, str]]] = {
    "owner_name": [("k % 40 = 3", "CAST(NULL AS STRING)"), ("k % 20 = 3", "'  '")],
    "appraised_total_value": [("k % 211 = 1", "CAST(-5 AS DOUBLE)"), ("k % 211 = 2", "CAST(6000000000 AS DOUBLE)")],
    "appraised_land_value": [("k % 211 = 3", "appraised_land_value + 1000")],
    "taxable_value": [("k % 211 = 4", "appraised_total_value + 100"), ("k % 211 = 5", "CAST(NULL AS DOUBLE)"), ("k % 211 = 6", "CAST(0 AS DOUBLE)"),
                      ("k % 30 = 11", "CAST(-1 AS DOUBLE)")],
    "total_exemptions": [("k % 211 = 6", "CAST(0 AS DOUBLE)"), ("k % 211 = 13", "total_exemptions + 1")],
    "appraisal_year": [("k % 211 = 7", "CAST(1980 AS INTEGER)")],
    "exemption_1_type": [("k % 211 = 8", "'MYSTERY'"), ("k % 211 = 16", f"'{_OWNER}'"), ("k % 211 = 17", f"'{_OWNER}'")],
    "exemption_2_type": [("k % 211 = 17", f"'{_USE}'")],
    "exemption_5_type": [("k % 211 = 9", "'NOBODY'")],
    "exemption_6_type": [("k % 211 = 10", "'ELSE'"), ("k % 211 = 16", "'OWNERS PRIMARY RESIDENCE'")],
    "exemption_type_group": [("k % 211 = 11", "'Unsure'"), ("k % 211 = 12", "CASE WHEN exemption_type_group = 'Other' THEN 'No Exemptions' ELSE 'Other' END")],
    "net_taxable_value": [("k % 211 = 14", "CAST(NULL AS DOUBLE)"), ("k % 211 = 15", "CAST(-3 AS DOUBLE)"), ("k % 50 = 21", "net_taxable_value + 10")],
    "tax_district": [("k % 211 = 18", "'4'")],
    "gis_site_city": [("k % 211 = 18", "'Indian'"), ("k % 13 = 5", "'Girdwood'")],
    "sw_lon": [("k % 211 = 22", "sw_lon + 10")],
}
_COLUMNS = [c.strip() for c in """parcel_id, tax_district, property_type, owner_name, parcel_address, gis_site_city, legal_description, appraised_total_value,
appraised_building_value, appraised_land_value, exemption_1_type, exemption_1_amount, exemption_2_type, exemption_2_amount, exemption_5_type,
exemption_5_amount, exemption_6_type, exemption_6_amount, total_exemptions, exemption_type_group, taxable_value, net_taxable_value, year_built,
year_built_min, year_built_max, appraisal_year, deed_date, sw_lon, sw_lat""".split(",")]


def _value(column: str) -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in _FAULTS.get(column, []))
    return f"CASE {whens} ELSE {column} END AS {column}" if whens else column


# shape: N none, X a ring that crosses itself, L a ring without area, else a square of the given side
_FAULTY = f"""
SELECT {', '.join(_value(c) for c in _COLUMNS)}, k,
  CASE WHEN k % 40 = 7 THEN 'X' WHEN k % 211 = 19 THEN 'N' WHEN k % 211 = 20 THEN 'L' ELSE 'S' END AS shape,
  CASE WHEN k % 30 = 13 THEN CAST(0.000005 AS DOUBLE) WHEN k % 211 = 21 THEN CAST(2 AS DOUBLE) ELSE CAST(0.001 AS DOUBLE) END AS side
FROM (SELECT *, CAST(parcel_id AS BIGINT) AS k FROM {{p}})"""


def _corners(x: str, y: str, s: str) -> list[tuple[str, str]]:
    """Corners of a shape's ring, for both engines."""
    up = f"CASE WHEN shape = 'L' THEN {y} ELSE {y} + {s} END"
    return [(x, y), (f"{x} + {s}", f"CASE WHEN shape = 'X' THEN {y} + {s} ELSE {y} END"),
            (f"{x} + {s}", f"CASE WHEN shape = 'X' THEN {y} ELSE {up} END"), (x, f"CASE WHEN shape = 'X' THEN {y} + {s} / 2 ELSE {up} END")]


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = spark.sql(parcelish.PARCELS_SQL, orders=deal(table(spark, sf_dir, "orders")), customer=table(spark, sf_dir, "customer"),
                     nation=table(spark, sf_dir, "nation"))
    b = spark.sql(_FAULTY.format(p="{p}"), p=base)
    points = [F.array(F.expr(x), F.expr(y)) for x, y in _corners("sw_lon", "sw_lat", "side")]
    ring = F.array(*points, points[0])
    return (b.withColumn("geom", F.when(F.col("shape") != "N", F.array(F.array(ring)))).withColumn("area_m2", geo.area_m2(F.col("geom")))
            .withColumn("pubdate", F.col("deed_date")).drop("sw_lon", "sw_lat", "shape", "side"))


def _hashed(rows: DataFrame) -> DataFrame:
    return scd2.with_hash(rows, exclude=("pubdate", "area_m2"), key=parcels.KEY)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """history, current (measured), runs, artifact and categorized; history and artifact are written, the others are views of the history."""
    base = cut_lineage(_faulty(spark, sf_dir), "audit-parcels")
    k = F.col("k")

    def marked(rows: DataFrame, where: Column, mark: str) -> DataFrame:
        return rows.withColumn("legal_description", F.when(where, F.concat("legal_description", F.lit(mark))).otherwise(F.col("legal_description")))

    snaps = [base.where(k % 5 != 0), marked(base.where(k % 7 != 0), k % 11 == 0, " R2"), marked(base, k % 13 == 0, " R3")]
    snaps = [_hashed(s) for s in snaps]
    hist, runs = scd2.empty_history(snaps[0]), None
    for snap, ts in zip(snaps, RUNS):
        counts = scd2.merge_counts(scd2.classify(hist.where("is_current"), snap, parcels.KEY))
        row = store.ledger_row(counts, store.run_id(ts), ts, ts[:11] + "01:00:00", server_count=F.col("distinct_keys"))
        runs = row if runs is None else runs.unionByName(row)
        hist = scd2.merge(hist, snap, ts, parcels.KEY)
        if ts != RUNS[-1]:                      # the last one's rows are written with those that no merge would write
            hist = cut_lineage(hist, "audit-history")
    late = runs.where(F.col("started_at") == ts_ntz(RUNS[2])).withColumn("status", F.lit("refused")).withColumn("finished_at", ts_ntz(AS_OF))

    one, two, three, now = (ts_ntz(t) for t in (*RUNS, AS_OF))
    day = lambda n: F.expr(f"INTERVAL {n} DAYS")
    validity = {1: (one, two, False), 2: (three + day(1), F.lit(None), True), 3: (one - day(10), one - day(11), False),
                4: (one - day(5), one - day(4), True), 5: (now + day(2), now + day(3), False)}
    nth = lambda i: F.coalesce(*[F.when(k % 101 == n, v[i]) for n, v in validity.items()])
    ghosts = _hashed(base.where((k % 101).isin(*validity))).withColumns({
        "valid_from": nth(0), "valid_to": nth(1).cast("timestamp_ntz"), "is_current": (k % 101).isin(*[n for n, v in validity.items() if v[2]]),
        parcels.KEY: F.when(k % 101 == 1, "").otherwise(F.col(parcels.KEY))})
    hist = cut_lineage(hist.unionByName(ghosts), "audit-history")
    cur = scd2.current(hist)
    artifact = publish.build_current_artifact(cur, parcels.KEY).where(k % 103 != 1)
    artifact = artifact.withColumn("geom", F.when(k % 103 != 2, F.col("geom"))).withColumn("centroid_lon", F.when(k % 103 != 3, F.col("centroid_lon")))
    labelled = rules.categorize(cur).where(k % 107 != 1)
    none = F.lit(None).cast("string")
    slots = {c: F.when(k % 107 == 6, none).otherwise(F.col(c)) for c in (f"exemption_{i}_type" for i in (1, 2, 5, 6))}
    labelled = labelled.withColumns(slots | {
        "basis": F.when(k % 107 == 2, none).otherwise(F.col("basis")),
        "owner_type": F.when(k % 107 == 3, "alien").when(k % 107 == 4, none).when((k % 107 == 5) | (k % 107 == 6), "person").otherwise(F.col("owner_type")),
        "owner_name": F.when(k % 107 == 5, "A TRUST LLC").otherwise(F.col("owner_name"))})
    return {"history": hist, "current": parcels.with_geometry_metrics(cur), "runs": runs.unionByName(late),
            "artifact": cut_lineage(artifact.withColumn("attr_hash", F.lit("left in")), "audit-artifact"),
            "categorized": labelled}


# ----------------------------------------------------------------------------- oracle
def oracle_tables() -> str:
    """CTEs b (rows), hist, cur, art (artifact), cat (labels) and ledger."""
    from snapledger.plans.queries_geo import ring_area_sql
    from snapledger.plans.queries_parcels import categorized_sql

    t1, t2, t3, now = (f"TIMESTAMP '{t}'" for t in (*RUNS, AS_OF))
    start = f"CASE run WHEN 1 THEN {t1} WHEN 2 THEN {t2} ELSE {t3} END"
    end = f"CASE last WHEN 1 THEN {t2} WHEN 2 THEN {t3} END"
    slots = ", ".join(f"CASE WHEN k % 107 = 6 THEN NULL ELSE exemption_{i}_type END AS exemption_{i}_type" for i in (1, 2, 5, 6))
    day = "INTERVAL {} DAY"
    return f"""WITH p AS ({parcelish.duck_sql()}),
b AS ({_FAULTY.format(p="p")}),
seen AS (SELECT k, 1 AS run, 0 AS content FROM b WHERE k % 5 <> 0
  UNION ALL SELECT k, 2, CASE WHEN k % 11 = 0 THEN 2 ELSE 0 END FROM b WHERE k % 7 <> 0
  UNION ALL SELECT k, 3, CASE WHEN k % 13 = 0 THEN 3 ELSE 0 END FROM b),
begun AS (SELECT s.k, s.run, s.content FROM seen s WHERE NOT EXISTS
  (SELECT 1 FROM seen e WHERE e.k = s.k AND e.run = s.run - 1 AND e.content = s.content)),
ended AS (SELECT s.k, s.run AS last, s.content FROM seen s WHERE NOT EXISTS
  (SELECT 1 FROM seen e WHERE e.k = s.k AND e.run = s.run + 1 AND e.content = s.content)),
merged AS (SELECT g.k, g.run, g.content, min(e.last) AS last FROM begun g JOIN ended e ON e.k = g.k AND e.content = g.content AND e.last >= g.run
  GROUP BY g.k, g.run, g.content),
hist AS (SELECT CAST(k AS VARCHAR) AS parcel_id, k, content, {start} AS valid_from, {end} AS valid_to, last = 3 AS is_current FROM merged
  UNION ALL SELECT '', k, 0, {t1}, {t2}, false FROM b WHERE k % 101 = 1
  UNION ALL SELECT parcel_id, k, 0, {t3} + {day.format(1)}, NULL, true FROM b WHERE k % 101 = 2
  UNION ALL SELECT parcel_id, k, 0, {t1} - {day.format(10)}, {t1} - {day.format(11)}, false FROM b WHERE k % 101 = 3
  UNION ALL SELECT parcel_id, k, 0, {t1} - {day.format(5)}, {t1} - {day.format(4)}, true FROM b WHERE k % 101 = 4
  UNION ALL SELECT parcel_id, k, 0, {now} + {day.format(2)}, {now} + {day.format(3)}, false FROM b WHERE k % 101 = 5),
cur AS (SELECT b.* EXCLUDE (legal_description), b.legal_description || CASE h.content WHEN 2 THEN ' R2' WHEN 3 THEN ' R3' ELSE '' END AS legal_description,
    b.deed_date AS pubdate, CASE WHEN shape <> 'N' THEN {ring_area_sql(_corners("sw_lon", "sw_lat", "side"))} END AS area_m2,
    CASE shape WHEN 'S' THEN sw_lon + side / 2 WHEN 'X' THEN sw_lon + side END AS cx, CASE WHEN shape IN ('S', 'X') THEN sw_lat + side / 2 END AS cy,
    CASE WHEN shape <> 'N' THEN sw_lon END AS xmin, CASE WHEN shape <> 'N' THEN sw_lon + side END AS xmax,
    CASE WHEN shape <> 'N' THEN sw_lat END AS ymin, CASE shape WHEN 'N' THEN NULL WHEN 'L' THEN sw_lat ELSE sw_lat + side END AS ymax
  FROM hist h JOIN b ON b.k = h.k WHERE h.is_current),
art AS (SELECT parcel_id, shape = 'N' OR k % 103 = 2 AS no_geom, cx IS NULL OR k % 103 = 3 AS no_centroid FROM cur WHERE k % 103 <> 1),
{categorized_sql('cur').replace('cat AS (', 'ruled AS (', 1)},
cat AS (SELECT ruled.* EXCLUDE (basis, owner_type, owner_name, exemption_1_type, exemption_2_type, exemption_5_type, exemption_6_type), {slots},
    CASE WHEN k % 107 <> 2 THEN basis END AS basis,
    CASE k % 107 WHEN 3 THEN 'alien' WHEN 4 THEN NULL WHEN 5 THEN 'person' WHEN 6 THEN 'person' ELSE owner_type END AS owner_type,
    CASE WHEN k % 107 = 5 THEN 'A TRUST LLC' ELSE owner_name END AS owner_name FROM ruled WHERE k % 107 <> 1),
ledger AS (SELECT unnest([{t1}, {t2}, {t3}]) + INTERVAL 1 HOUR AS finished_at, 'success' AS status UNION ALL SELECT {now}, 'refused')"""


def _words(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def oracle_checks(bad, unless, several_open, overlapping, repeated, not_since) -> list[tuple[str, str, int, str]]:
    """(name, severity, allowance, SQL of the violations), each told from its rule."""
    from snapledger.plans.queries_parcels import base_sql

    now = f"TIMESTAMP '{AS_OF}'"
    nil = lambda c: f"coalesce({c}, 0)"
    far = lambda a, b: f"abs(({a}) - ({b})) > 0.005"
    nobody = "coalesce(trim(owner_name), '') = ''"
    slots = {i: f"exemption_{i}_type" for i in (1, 2, 5, 6)}
    amounts = " + ".join(nil(f"exemption_{i}_amount") for i in slots)
    free = " AND ".join(f"{c} IS NULL" for c in slots.values())
    year_off = lambda c: f"({c} IS NOT NULL AND coalesce(TRY_CAST({c} AS INTEGER), 0) NOT BETWEEN 1850 AND 2027)"
    strange = lambda sql, known: f"SELECT count(DISTINCT v) FROM ({sql}) WHERE v NOT IN {_words(known)}"
    main = base_sql("coalesce(exemption_1_type, exemption_2_type)")
    valley = "tax_district = '4' AND NOT (xmin >= -149.3 AND xmax <= -148.9 AND ymin >= 60.85 AND ymax <= 61.05)"
    both = lambda flag: f"SELECT count(*) FROM art JOIN cur ON cur.parcel_id = art.parcel_id WHERE art.{flag} AND cur.shape <> 'N'"
    rows = lambda a, b: f"(SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b})"
    e, w = "error", "warn"
    return [
        ("current_count_min", e, 0, unless("count(*) >= 90000", "cur")),
        ("parcel_id_nonempty", e, 0, bad("coalesce(parcel_id, '') = ''", "hist")),
        ("one_current_per_parcel", e, 0, several_open("hist", "parcel_id")),
        ("no_overlapping_versions", e, 0, overlapping("hist", "parcel_id")),
        ("valid_interval_ordered", e, 0, bad("valid_from >= valid_to", "hist")),
        ("closed_rows_not_current", e, 0, bad("(valid_to IS NULL AND NOT is_current) OR (valid_to IS NOT NULL AND is_current)", "hist")),
        ("no_consecutive_duplicate_versions", e, 0, repeated("hist", "parcel_id", "o.k = h.k AND o.content = h.content")),
        ("owner_present", w, 100, bad(nobody, "cur")),
        ("ownerless_parcels_have_no_value", e, 0, bad(f"appraised_total_value > 0 AND {nobody}", "cur")),
        ("geometry_present", e, 0, bad("shape = 'N'", "cur")),
        ("geometry_valid", w, 200, bad("shape IN ('X', 'L')", "cur")),
        ("min_area_1m2", w, 10, bad("area_m2 < 1", "cur")),
        ("area_positive", e, 0, bad("coalesce(area_m2, 0) <= 0", "cur")),
        ("area_not_absurd", e, 0, bad("area_m2 > 5000000000", "cur")),
        ("geometry_in_anchorage_bbox", e, 0, bad("cx < -151.0 OR cx > -148.3 OR cy < 60.6 OR cy > 61.6", "cur")),
        ("appraised_value_sane", e, 0, bad("appraised_total_value NOT BETWEEN 0 AND 5000000000", "cur")),
        ("value_components_add_up", w, 0, bad(far(f"{nil('appraised_land_value')} + {nil('appraised_building_value')}", "appraised_total_value"), "cur")),
        ("taxable_le_appraised", w, 100, bad("taxable_value - appraised_total_value > 1", "cur")),
        ("appraisal_year_sane", e, 0, bad("appraisal_year NOT BETWEEN 1990 AND 2100", "cur")),
        ("year_built_plausible", e, 0, bad(" OR ".join(year_off(c) for c in parcels.YEAR_COLS), "cur")),
        ("source_freshness", w, 0, not_since("cur", "pubdate", now, "7 DAY")),
        ("ingest_freshness", e, 0, not_since("ledger", "finished_at", now, "48 HOUR", "status = 'success'", 1)),
        ("no_future_valid_from", e, 0, bad(f"valid_from - INTERVAL 1 HOUR > {now}", "hist")),
        ("browser_row_count_matches_archive", e, 0, f"SELECT CASE WHEN {rows('art', 'cur')} = 0 THEN 0 ELSE 1 END"),
        ("browser_drops_heavy_columns", e, 0, "SELECT count(*) FROM (SELECT 'left in' AS attr_hash FROM art LIMIT 1)"),
        ("browser_carries_geometry", e, 0, both("no_geom")),
        ("browser_carries_centroids", e, 0, both("no_centroid")),
        ("exemption_institutional_types_known", w, 0, strange(
            "SELECT regexp_replace(unnest([exemption_1_type, exemption_2_type]), ' - LAND$', '') AS v FROM cur", rules.INSTITUTIONAL_EXEMPTION_BASES)),
        ("exemption_personal_types_known", w, 0, strange("SELECT exemption_5_type AS v FROM cur", rules.PERSONAL_EXEMPTION_TYPES)),
        ("exemption_residential_types_known", w, 0, strange("SELECT exemption_6_type AS v FROM cur", rules.RESIDENTIAL_EXEMPTION_TYPES)),
        ("exemption_group_flag_consistent", w, 0, f"""SELECT sum(CASE coalesce(exemption_type_group, '')
            WHEN 'No Exemptions' THEN CASE WHEN {free} THEN 0 ELSE 1 END WHEN 'Other' THEN CASE WHEN {free} THEN 1 ELSE 0 END
            ELSE CASE WHEN exemption_type_group IS NOT NULL AND {free} THEN 2 ELSE 1 END END) FROM cur"""),
        ("exemption_type_iff_amount", w, 0, "SELECT " + " + ".join(
            f"sum(CASE WHEN {c} IS NULL THEN CAST({nil(f'exemption_{i}_amount')} <> 0 AS INTEGER) ELSE CAST({nil(f'exemption_{i}_amount')} = 0 AS INTEGER) END)"
            for i, c in slots.items()) + " FROM cur"),
        ("exemption_total_is_sum", w, 0, bad(far(nil("total_exemptions"), amounts), "cur")),
        ("taxable_equals_appraised_minus_exemptions", w, 0, bad(far(f"{nil('taxable_value')} + {nil('total_exemptions')}", nil("appraised_total_value")), "cur")),
        ("taxable_null_zero_semantics", w, 0, bad(
            f"CASE WHEN taxable_value IS NULL THEN NOT ({nil('appraised_total_value')} = 0 AND {nil('total_exemptions')} = 0) "
            f"ELSE taxable_value = 0 AND {nil('total_exemptions')} = 0 END", "cur")),
        ("taxable_negative_rare", w, 100, bad("taxable_value < 0", "cur")),
        ("net_taxable_never_null_or_negative", w, 0, bad("coalesce(net_taxable_value, -1) < 0", "cur")),
        ("net_taxable_tracks_taxable", w, 0, unless(
            f"200 * sum(CASE WHEN {far(nil('net_taxable_value'), 'CASE WHEN taxable_value > 0 THEN taxable_value ELSE 0 END')} THEN 1 ELSE 0 END) <= count(*)", "cur")),
        ("owner_type_macro_row_preserving", e, 0, f"SELECT abs({rows('cat', 'cur')})"),
        ("owner_type_basis_known", e, 0, bad(f"coalesce(basis, 'none given') NOT IN {_words(rules.ALL_BASES)}", "cat")),
        ("owner_type_label_known", e, 0, bad(f"owner_type NOT IN {_words(rules.OWNER_TYPES)}", "cat")),
        ("owner_type_null_iff_abstained", e, 0, bad(
            f"CASE WHEN basis IN {_words(rules.OWNER_TYPE_LABELED_BASES)} THEN owner_type IS NULL ELSE basis IS NOT NULL AND owner_type IS NOT NULL END", "cat")),
        ("owner_type_person_name_guards", e, 0, bad(
            f"owner_type = 'person' AND (strpos(owner_name, 'TRUST') > 0 OR regexp_matches(owner_name, '{CORPORATE_NAME_PATTERN}'))", "cat")),
        ("owner_type_labeled_only_with_exemption", e, 0, bad(f"owner_type IS NOT NULL AND {free}", "cat")),
        ("owner_type_bases_all_classified", w, 0, bad(f"{main} NOT IN {_words([*rules.OWNER_IDENTIFYING_BASES, *rules.USE_IDENTIFYING_BASES])}", "cur")),
        ("owner_type_signals_never_conflict", w, 0, bad(
            f"(exemption_5_type IS NOT NULL OR exemption_6_type IS NOT NULL) AND {main} IN {_words(rules.OWNER_IDENTIFYING_BASES)}", "cur")),
        ("exemption_slots_1_2_same_base", w, 0, bad(f"{base_sql('exemption_1_type')} <> {base_sql('exemption_2_type')}", "cur")),
        ("girdwood_district_4_sized_right", w, 0, unless("sum(CASE WHEN tax_district = '4' THEN 1 ELSE 0 END) BETWEEN 1000 AND 3000", "cur")),
        ("girdwood_no_foreign_addresses", w, 0, bad("tax_district = '4' AND gis_site_city <> 'Girdwood'", "cur")),
        ("girdwood_addresses_mostly_in_district_4", w, 0, unless(
            "20 * sum(CASE WHEN tax_district = '4' THEN 1 ELSE 0 END) >= 19 * count(*)", "(SELECT * FROM cur WHERE gis_site_city = 'Girdwood')")),
        ("girdwood_stragglers_only_on_fringe", w, 0, bad("gis_site_city = 'Girdwood' AND tax_district NOT IN ('4', '15', '')", "cur")),
        ("girdwood_addressless_mostly_vacant", w, 0, unless(
            f"count(*) >= 100 AND 5 * sum(CASE WHEN {nil('appraised_building_value')} = 0 THEN 1 ELSE 0 END) >= 4 * count(*)",
            "(SELECT * FROM cur WHERE tax_district = '4' AND gis_site_city IS NULL)")),
        ("girdwood_geometry_in_valley", w, 0, bad(valley, "cur")),
        ("girdwood_legal_description_undercounts", w, 0, unless(
            "4 * sum(CASE WHEN strpos(upper(legal_description), 'GIRDWOOD') > 0 THEN 1 ELSE 0 END) < sum(CASE WHEN tax_district = '4' THEN 1 ELSE 0 END)", "cur")),
    ]
