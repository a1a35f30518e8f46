"""Open-order-book snapshots derived from ``orders`` and ``lineitem``.

Snapshot at run time t = every order placed by t that still has an unshipped
line (or no lines at all), with its shipping progress.  Between two runs orders
appear (new), ship more lines (changed), finish shipping (retired) or stay put
(unchanged) -- every SCD2 case arises from the data itself, and each snapshot
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.values import cents, ts_ntz
from snapledger.operators import scd2
from snapledger.plans.tables import table
from snapledger.session import cut_lineage

# Run times of the three snapshots merged in the examples.
RUN_TIMES = ("1997-01-01 00:00:00", "1998-07-01 00:00:00", "2000-01-01 00:00:00")
KEY = "order_key"
ATTRS = ("cust_key", "priority", "total_cents", "n_lines", "shipped_lines", "shipped_qty")
COLUMNS = (KEY,) + ATTRS + ("attr_hash",)


def shipping_progress(lineitem: DataFrame, run_times=RUN_TIMES) -> DataFrame:
    """Per order: line count and, for every run time, lines and quantity shipped by then.

    One aggregation for all run times, so a single scan + shuffle of lineitem
    serves every snapshot (partial aggregation runs map-side).
    """
    aggs = [F.count(F.lit(1)).alias("n_lines")]
    for i, t in enumerate(run_times, start=1):
        shipped = F.col("l_shipdate") <= ts_ntz(t)
        aggs.append(F.count_if(shipped).alias(f"shipped_lines_{i}"))
        aggs.append(F.sum(F.when(shipped, F.col("l_quantity")).otherwise(F.lit(0.0))).alias(f"shipped_qty_{i}"))
    return lineitem.groupBy("l_orderkey").agg(*aggs)


def snapshot(orders: DataFrame, progress: DataFrame, i: int, run_times=RUN_TIMES) -> DataFrame:
    """The open order book at run ``i`` (1-based), hashed."""
    t = ts_ntz(run_times[i - 1])
    j = orders.filter(F.col("o_orderdate") <= t).join(
        progress, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    n_lines = F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint")
    shipped = F.coalesce(F.col(f"shipped_lines_{i}"), F.lit(0)).cast("bigint")
    snap = j.select(
        F.col("o_orderkey").alias(KEY), F.col("o_custkey").alias("cust_key"),
        F.col("o_orderpriority").alias("priority"), cents(F.col("o_totalprice")).alias("total_cents"),
        n_lines.alias("n_lines"), shipped.alias("shipped_lines"),
        F.coalesce(F.col(f"shipped_qty_{i}"), F.lit(0.0)).cast("bigint").alias("shipped_qty"),
    ).filter(~((F.col("n_lines") > 0) & (F.col("shipped_lines") == F.col("n_lines"))))
    return scd2.with_hash(snap, key=KEY)


def snapshots(spark: SparkSession, sf_dir: str, run_times=RUN_TIMES) -> list[DataFrame]:
    orders = table(spark, sf_dir, "orders")
    # one scan and shuffle of lineitem for all runs: each merge is a job of its own and would repeat it
    progress = cut_lineage(shipping_progress(table(spark, sf_dir, "lineitem"), run_times), "shipping-progress")
    return [snapshot(orders, progress, i, run_times) for i in range(1, len(run_times) + 1)]


def history(spark: SparkSession, sf_dir: str, run_times=RUN_TIMES) -> DataFrame:
    """History after merging every snapshot in order, starting from an empty table."""
    snaps = snapshots(spark, sf_dir, run_times)
    h = scd2.empty_history(snaps[0])
    for i, (snap, t) in enumerate(zip(snaps, run_times)):
        h = scd2.merge(h, snap, t, KEY)
        if i < len(snaps) - 1:
            # each version is materialised, as the store does: a merge reads its input
            # history twice (closed rows pass through, open rows are joined), so an
            # unmaterialised chain would double the plan with every run
            h = cut_lineage(h, "orderbook-history")
    return h


def stacked(spark: SparkSession, sf_dir: str, run_times=RUN_TIMES) -> DataFrame:
    snaps = snapshots(spark, sf_dir, run_times)
    out = None
    for i, (s, t) in enumerate(zip(snaps, run_times), start=1):
        s = s.withColumn("seq", F.lit(i)).withColumn("run_ts", ts_ntz(t))
        out = s if out is None else out.unionByName(s)
    return out


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB) for the same derivation.  History is computed in closed
# form (gaps and islands), independent of the incremental merge it checks.

def book_sql(i: int, run_times=RUN_TIMES) -> str:
    t = f"TIMESTAMP '{run_times[i - 1]}'"
    return f"""
  SELECT o.o_orderkey AS order_key, o.o_custkey AS cust_key, o.o_orderpriority AS priority,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS total_cents,
         CAST(coalesce(l.n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(l.shipped_lines, 0) AS BIGINT) AS shipped_lines,
         CAST(coalesce(l.shipped_qty, 0) AS BIGINT) AS shipped_qty
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_lines,
           count(*) FILTER (WHERE l_shipdate <= {t}) AS shipped_lines,
           sum(CASE WHEN l_shipdate <= {t} THEN l_quantity ELSE 0 END) AS shipped_qty
    FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderdate <= {t}
    AND NOT (coalesce(l.n_lines, 0) > 0 AND l.shipped_lines = l.n_lines)"""


HASH_SQL = ("md5(concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '')" for c in ATTRS) + "))")


def history_ctes(run_times=RUN_TIMES) -> str:
    """CTEs b1..bn (hashed snapshots) and ``hist`` (the SCD2 history)."""
    n = len(run_times)
    parts = [f"b{i} AS (SELECT *, {HASH_SQL} AS attr_hash FROM ({book_sql(i, run_times)}) x)"
             for i in range(1, n + 1)]
    union = " UNION ALL ".join(f"SELECT {i} AS seq, TIMESTAMP '{t}' AS run_ts, * FROM b{i}"
                               for i, t in enumerate(run_times, start=1))
    next_ts = " ".join(f"WHEN {i} THEN TIMESTAMP '{run_times[i]}'" for i in range(1, n))
    parts.append(f"snaps AS ({union})")
    parts.append("""flagged AS (
    SELECT *, CASE WHEN lag(seq) OVER w = seq - 1 AND lag(attr_hash) OVER w = attr_hash
                   THEN 0 ELSE 1 END AS is_start
    FROM snaps WINDOW w AS (PARTITION BY order_key ORDER BY seq))""")
    parts.append("""runs AS (
    SELECT *, sum(is_start) OVER (PARTITION BY order_key ORDER BY seq
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
    FROM flagged)""")
    parts.append("""run_ends AS (SELECT order_key, run, max(seq) AS end_seq FROM runs GROUP BY ALL)""")
    cols = ", ".join(f"r.{c}" for c in COLUMNS)
    parts.append(f"""hist AS (
    SELECT {cols}, r.run_ts AS valid_from,
           CASE e.end_seq {next_ts} END AS valid_to,
           e.end_seq = {n} AS is_current
    FROM runs r JOIN run_ends e ON r.order_key = e.order_key AND r.run = e.run
    WHERE r.is_start = 1)""")
    return "WITH " + ",\n".join(parts)
