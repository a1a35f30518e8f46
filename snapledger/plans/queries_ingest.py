"""Registered queries: whole ingest runs, from raw records to the stored table and its ledger."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapledger.operators import stage
from snapledger.plans import orderbook as ob
from snapledger.plans.registry import register
from snapledger.plans.tables import table
from snapledger.session import scratch_path
from snapledger.sources import ingest, publish, store
from snapledger.sources.fields import FieldSpec

ORDER_SOURCE = ingest.Source(
    fields=[FieldSpec("custKey", "cust_key", "bigint"), FieldSpec("priority", "priority"), FieldSpec("totalCents", "total_cents", "bigint"),
            FieldSpec("nLines", "n_lines", "bigint"), FieldSpec("shippedLines", "shipped_lines", "bigint"),
            FieldSpec("shippedQty", "shipped_qty", "bigint")],
    key_src="orderKey", key="order_key", as_of_year=2000)
_COLUMNS = ", ".join((ob.KEY, *ob.ATTRS))


def _ingested(spark, d) -> tuple[str, str]:
    """(table root, ledger path) after ingesting every order-book snapshot from JSON lines."""
    base = scratch_path(spark, "ingest")
    root, ledger = f"{base}/table", f"{base}/ledger"
    for i, (snap, ts) in enumerate(zip(ob.snapshots(spark, d), ob.RUN_TIMES), start=1):
        src = {"orderKey": ob.KEY} | {f.src: f.dst for f in ORDER_SOURCE.fields}
        raw = f"{base}/raw/{i}"
        lines = snap.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(n) for n, c in src.items()])).alias("value"))
        unkeyed = spark.createDataFrame([('{"custKey": "1", "priority": "a record without a key"}',)], "value string")
        lines.unionByName(unkeyed).write.text(raw)
        n = spark.read.text(raw).count()
        ingest.ingest(spark, root, ledger, raw, ORDER_SOURCE, ts, server_count=n, finished_at=ts[:11] + "01:00:00",
                      limits=ingest.Limits(allow_shrink=True))
    return root, ledger


@register("ingest_history", f"{ob.history_ctes()} SELECT {_COLUMNS}, valid_from, valid_to, is_current FROM hist")
def q_ingest_history(spark, d):
    """The stored history after three whole runs."""
    hist, _ = publish.checkout(spark, _ingested(spark, d)[0])
    return hist.select(F.col(ob.KEY).cast("bigint").alias(ob.KEY), *ob.ATTRS, "valid_from", "valid_to", "is_current")


def _ledger_sql() -> str:
    rows = []
    for i, t in enumerate(ob.RUN_TIMES, start=1):
        opened = f"(SELECT * FROM hist WHERE valid_from < TIMESTAMP '{t}' AND (valid_to IS NULL OR valid_to >= TIMESTAMP '{t}'))"
        rows.append(f"""SELECT '{store.run_id(t)}' AS run_id, TIMESTAMP '{t}' AS started_at, TIMESTAMP '{t[:11]}01:00:00' AS finished_at,
          'success' AS status, (SELECT count(*) + 1 FROM b{i}) AS server_count, (SELECT count(*) + 1 FROM b{i}) AS source_features,
          (SELECT count(*) FROM b{i}) AS distinct_parcels,
          (SELECT count(*) FROM b{i} WHERE order_key NOT IN (SELECT order_key FROM {opened})) AS new_parcels,
          (SELECT count(*) FROM b{i} s JOIN {opened} o USING (order_key) WHERE s.attr_hash <> o.attr_hash) AS changed_parcels,
          (SELECT count(*) FROM {opened} WHERE order_key NOT IN (SELECT order_key FROM b{i})) AS retired_parcels,
          (SELECT count(*) FROM b{i} s JOIN {opened} o USING (order_key) WHERE s.attr_hash = o.attr_hash) AS unchanged_parcels""")
    return f"{ob.history_ctes()} " + " UNION ALL ".join(rows)


@register("ingest_ledger", _ledger_sql())
def q_ingest_ledger(spark, d):
    """The ledger of those runs, counted against the stored table (without the size of its files)."""
    return store.read_ledger(spark, _ingested(spark, d)[1]).drop("archive_bytes")


# ----------------------------------------------------------------------------- staging with geometry
# Each customer is a key, each order a part: a square, an L or a square with a hole, side by side along a line,
# 40 micro-degrees wide; some parts come twice, some lack their shape, some their key, some their values.
SIDE = 40
PARTS_SQL = """
SELECT CASE WHEN o_custkey % 50 = 7 THEN NULL WHEN o_custkey % 50 = 8 THEN '' ELSE CAST(o_custkey AS STRING) END AS customer,
  o_orderkey AS part, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(1840 + o_orderkey % 200 AS STRING) END AS year_built,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS price,
  CASE WHEN o_orderkey % 13 = 0 THEN 'none' WHEN o_orderkey % 12 % 4 = 2 THEN 'L' WHEN o_orderkey % 12 % 4 = 3 THEN 'hole' ELSE 'square' END AS kind,
  -150000000 + (o_custkey % 400) * 1000 + (o_orderkey % 12) * 40 AS x6, 61000000 + (o_custkey % 301) * 1000 AS y6
FROM {orders}"""
PARTS = [FieldSpec("Priority", "priority"), FieldSpec("YearBuilt", "year_built"), FieldSpec("Price", "price", "double")]
_SHAPES = {"square": [[(0, 0), (40, 0), (40, 40), (0, 40)]], "L": [[(0, 0), (40, 0), (40, 20), (20, 20), (20, 40), (0, 40)]],
           "hole": [[(0, 0), (40, 0), (40, 40), (0, 40)], [(10, 10), (10, 30), (30, 30), (30, 10)]]}


def _geojson():
    def point(dx: int, dy: int):
        return F.array((F.col("x6") + dx) / 1e6, (F.col("y6") + dy) / 1e6)
    shape = F.lit(None)
    for kind, rings in _SHAPES.items():
        polygon = F.array(*[F.array(*[point(*p) for p in [*r, r[0]]]) for r in rings])
        shape = F.when(F.col("kind") == kind, F.to_json(F.struct(F.lit("Polygon").alias("type"), polygon.alias("coordinates")))).otherwise(shape)
    return shape


def _quarters(which: list[tuple[int, int, int]]) -> str:
    from snapledger.plans.queries_geo import _square_area_sql
    return " + ".join(f"{sign} * " + _square_area_sql(f"((x6 + {dx}) / 1000000)", f"((y6 + {dy}) / 1000000)", side / 1e6)
                      for dx, dy, side, sign in which)


_YEAR = "CASE WHEN coalesce(TRY_CAST(year_built AS INTEGER), 0) BETWEEN 1850 AND 2027 THEN year_built END"


def _first(column: str) -> str:
    return f"""(SELECT p.{column} FROM parts p WHERE p.customer = k.customer AND p.{column} IS NOT NULL
                ORDER BY p.part LIMIT 1)"""


@register("stage_snapshot", f"""
WITH parts AS (SELECT * FROM ({PARTS_SQL.format(orders="orders")}) WHERE customer <> ''),
shapes AS (SELECT DISTINCT customer, kind, x6, y6 FROM parts WHERE kind <> 'none'),
areas AS (SELECT customer, count(*) AS n_parts, sum(CASE kind WHEN 'square' THEN {_quarters([(0, 0, 40, 1)])}
    WHEN 'L' THEN {_quarters([(0, 0, 40, 1), (20, 20, 20, -1)])} ELSE {_quarters([(0, 0, 40, 1), (10, 10, 20, -1)])} END) AS area FROM shapes GROUP BY customer),
k AS (SELECT customer, count(*) AS n FROM parts GROUP BY customer)
SELECT k.customer, {_first("priority")} AS priority,
       (SELECT {_YEAR} FROM (SELECT {_first("year_built")} AS year_built)) AS year_built, CAST({_first("price")} AS DOUBLE) AS price,
       CAST(k.n AS INTEGER) AS feature_count, round(areas.area, 3) AS area_m2, coalesce(areas.n_parts, 0) AS n_parts,
       CASE WHEN areas.n_parts IS NOT NULL THEN false END AS parts_overlap
FROM k LEFT JOIN areas ON areas.customer = k.customer""")
def q_stage_snapshot(spark, d):
    """Raw JSON lines of parts -> one row per key: first values, cleaned years, the union's area."""
    parts = spark.sql(PARTS_SQL, orders=table(spark, d, "orders"))
    raw = scratch_path(spark, "raw-parts")
    line = F.struct(F.col("customer").alias("Customer"), F.col("part").alias("Part"), F.col("priority").alias("Priority"),
                    F.col("year_built").alias("YearBuilt"), F.col("price").alias("Price"), _geojson().alias("__geometry"))
    parts.select(F.to_json(line)).write.text(raw)
    read = stage.read_features(spark, raw, PARTS, "Customer", "Part")
    counts = Observation()
    snap = stage.stage_snapshot(read, "Customer", PARTS, "Part", "__geometry", "customer", 2026, ("year_built",), counts)
    return snap.select("customer", "priority", "year_built", "price", "feature_count", F.round("area_m2", 3).alias("area_m2"), "n_parts", "parts_overlap")


# ----------------------------------------------------------------------------- one collection in one file
@register("feature_collection", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CASE WHEN o_orderkey % 5 <> 0 THEN '{"' || o_orderpriority || '}\\' END AS note,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 90 END AS lat FROM orders""")
def q_feature_collection(spark, d):
    """Every order as a feature of one GeoJSON collection in one file, read back by byte ranges."""
    from snapledger.sources import collections

    path = scratch_path(spark, "collection")
    note = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit('{"'), "o_orderpriority", F.lit("}\\")))
    place = F.when(F.col("o_orderkey") % 7 != 0, F.struct(F.lit("Point").alias("type"), F.array(F.lit(0), F.col("o_orderkey") % 90).alias("coordinates")))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("o_orderkey").alias("key"), note.alias("note")).alias("properties"),
                                 place.alias("geometry")))
    head = spark.createDataFrame([('{"type": "FeatureCollection", "name": "{ orders", "features": [',)], "value string")
    tail = spark.createDataFrame([('{"type": "End"}]}',)], "value string")
    lines = head.unionAll(table(spark, d, "orders").select(F.concat(feature, F.lit(",")).alias("value"))).unionAll(tail)
    lines.coalesce(1).write.text(path)                     # a file as a source would send it
    got = collections.flatten(spark, path, ["key", "note"])
    return got.select(F.col("key").alias("order_key"), "note", F.get_json_object("__geometry", "$.coordinates[1]").cast("bigint").alias("lat"))
