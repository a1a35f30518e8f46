"""A parcel-shaped table derived from ``orders`` x ``customer`` x ``nation``.

One row per order, so it grows with the data.  The derivation is one SQL text
that Spark (``spark.sql`` with DataFrame arguments) and DuckDB both run
unchanged, which gives the oracle byte-identical inputs.  Category-like
attributes (name suffixes, exemption slots, street words) are picked by key
arithmetic from the catalogs; nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.text import OWNER_NAME_PLACEHOLDER, STREET_ABBREVIATIONS
from snapledger.operators import geo
from snapledger.operators.rules import INSTITUTIONAL_EXEMPTION_BASES, PERSONAL_EXEMPTION_TYPES
from snapledger.plans.tables import table
from snapledger.session import deal

# Name endings that exercise each cleaning / guard branch.
NAME_SUFFIXES = ("", " LLC", " FAMILY TRUST", " % ESKE LLC", " C/O PARAGON PROPERTIES INC",
                 "  ATTN: 05-5080", " 50% & VANG NEDA 50%", " 15 % MOA/CEMETERY", " INC.",
                 " CO\\TTES", " REV TR", None)
AS_OF_YEAR = 2026


def _q(v: str) -> str:
    """Portable literal: a backslash is an escape in Spark SQL literals but not in DuckDB's."""
    parts = ["'" + p.replace("'", "''") + "'" for p in v.split("\\")]
    return "(" + " || chr(92) || ".join(parts) + ")" if len(parts) > 1 else parts[0]


def _pick(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v) if v is not None else 'NULL'}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


_LONG = [a for a, _ in STREET_ABBREVIATIONS]
_SHORT = [b for _, b in STREET_ABBREVIATIONS]

_BASE = f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
       c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey,
       {_pick('o.o_orderkey % 12', NAME_SUFFIXES)} AS name_suffix,
       {_pick('c.c_custkey % 29', INSTITUTIONAL_EXEMPTION_BASES)} AS inst_type,
       {_pick('o.o_custkey % 8', PERSONAL_EXEMPTION_TYPES)} AS personal_type,
       CAST(c.c_custkey AS STRING) || ' ' || n.n_name || ' ' || {_pick('c.c_custkey % 12', _LONG)}
         || CASE WHEN c.c_custkey % 3 = 0 THEN ' APT ' || CAST(c.c_custkey % 7 AS STRING) ELSE '' END AS mail_addr,
       CAST(c.c_custkey AS STRING) || ' ' || n.n_name || ' ' || {_pick('c.c_custkey % 12', _SHORT)} AS home_addr,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN '99587'
            ELSE '995' || lpad(CAST(c.c_nationkey AS STRING), 2, '0') END AS mail_zip
FROM {{orders}} o JOIN {{customer}} c ON c.c_custkey = o.o_custkey
JOIN {{nation}} n ON n.n_nationkey = c.c_nationkey"""

_SLOTS = f"""
SELECT b.*,
  CASE WHEN name_suffix IS NULL THEN {_q(OWNER_NAME_PLACEHOLDER)} ELSE upper(c_name) || name_suffix END AS owner_name,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'F'
       THEN inst_type || CASE WHEN o_orderstatus = 'P' THEN ' - LAND' ELSE '' END END AS exemption_1_type,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' AND c_acctbal > 5000
       THEN inst_type || ' - LAND' END AS exemption_2_type,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN personal_type END AS exemption_5_type,
  CASE WHEN o_orderpriority = '1-URGENT' OR (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' AND c_acctbal < 0)
       THEN 'OWNERS PRIMARY RESIDENCE' END AS exemption_6_type,
  CASE WHEN o_orderpriority = '5-LOW' THEN CAST(0 AS DOUBLE) ELSE CAST(floor(o_totalprice * 3 / 5) AS DOUBLE) END AS building
FROM b"""

PARCELS_SQL = f"""
WITH b AS ({_BASE}), s AS ({_SLOTS}),
v AS (
SELECT s.*,
  CASE WHEN exemption_1_type IS NOT NULL THEN CAST(floor(o_totalprice / 10) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS exemption_1_amount,
  CASE WHEN exemption_2_type IS NOT NULL THEN CAST(floor(o_totalprice / 20) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS exemption_2_amount,
  CASE WHEN exemption_5_type IS NOT NULL THEN CAST(50000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS exemption_5_amount,
  CASE WHEN exemption_6_type IS NOT NULL THEN CAST(20000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS exemption_6_amount
FROM s)
SELECT
  CAST(o_orderkey AS STRING) AS parcel_id,
  CAST(c_nationkey AS STRING) AS tax_district,
  CASE WHEN o_orderstatus = 'F' THEN 'Commercial' ELSE 'Residential' END AS property_type,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS land_use,
  owner_name,
  substr(owner_name, 1, 30) AS owner_line_1,
  nullif(substr(owner_name, 31, 30), '') AS owner_line_2,
  CAST(NULL AS STRING) AS owner_line_3,
  mail_addr AS owner_line_4,
  mail_addr AS owner_address,
  n_name AS owner_city,
  CASE WHEN n_regionkey IN (1, 2) THEN 'AK' WHEN n_regionkey = 3 THEN '' ELSE 'WA' END AS owner_state,
  mail_zip AS owner_zip,
  CASE WHEN o_orderpriority = '1-URGENT' THEN home_addr
       WHEN o_orderpriority = '2-HIGH' THEN ''
       ELSE CAST(o_orderkey AS STRING) || ' ' || n_name || ' ST' END AS parcel_address,
  CASE WHEN o_orderpriority = '1-URGENT' THEN mail_zip
       ELSE '995' || lpad(CAST(c_nationkey AS STRING), 2, '0') END AS gis_site_zipcode,
  CASE WHEN c_nationkey = 4 THEN 'Girdwood' WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE n_name END AS gis_site_city,
  'LOT ' || CAST(o_orderkey AS STRING) || CASE WHEN c_nationkey = 4 AND o_orderstatus = 'O' THEN ' GIRDWOOD' ELSE '' END
    AS legal_description,
  o_totalprice AS appraised_total_value,
  building AS appraised_building_value,
  o_totalprice - building AS appraised_land_value,
  exemption_1_type, exemption_1_amount, exemption_2_type, exemption_2_amount,
  exemption_5_type, exemption_5_amount, exemption_6_type, exemption_6_amount,
  exemption_1_amount + exemption_2_amount + exemption_5_amount + exemption_6_amount AS total_exemptions,
  CASE WHEN exemption_1_type IS NULL AND exemption_2_type IS NULL AND exemption_5_type IS NULL
        AND exemption_6_type IS NULL THEN 'No Exemptions' ELSE 'Other' END AS exemption_type_group,
  o_totalprice - (exemption_1_amount + exemption_2_amount + exemption_5_amount + exemption_6_amount)
    AS taxable_value,
  greatest(o_totalprice - (exemption_1_amount + exemption_2_amount + exemption_5_amount
    + exemption_6_amount), CAST(0 AS DOUBLE)) AS net_taxable_value,
  CAST(1840 + (o_custkey % 200) AS STRING) AS year_built,
  CAST(1890 + (o_orderkey % 140) AS SMALLINT) AS year_built_min,
  CAST(1895 + (o_orderkey % 140) AS SMALLINT) AS year_built_max,
  CAST(2000 + (o_orderkey % 30) AS INTEGER) AS appraisal_year,
  o_orderdate AS deed_date,
  CAST(-150 AS DOUBLE) + CAST(o_orderkey % 500 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS sw_lon,
  CAST(61 AS DOUBLE) + CAST(CAST(floor(o_orderkey / 500) AS BIGINT) % 250 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS sw_lat
FROM v"""


def duck_sql() -> str:
    """The derivation for DuckDB (tables by name)."""
    return PARCELS_SQL.format(orders="orders", customer="customer", nation="nation")


def parcels(spark: SparkSession, sf_dir: str, with_geometry: bool = True) -> DataFrame:
    # the per-row string building and geometry below are CPU-heavy: deal the rows out evenly
    df = spark.sql(PARCELS_SQL, orders=deal(table(spark, sf_dir, "orders")),
                   customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))
    if with_geometry:
        df = df.withColumn("geom", geo.square(F.col("sw_lon"), F.col("sw_lat")))
    return df
