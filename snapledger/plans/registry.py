"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the *whole*
given tables (or data Spark derives from them).  Oracle SQL re-states the same
result independently for DuckDB; computed columns carry the same aliases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import scd2
from snapledger.plans import orderbook as ob
from snapledger.plans.tables import table

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ----------------------------------------------------------------------------- SCD2
HIST = ob.history_ctes()
AS_OF = "1998-01-01 00:00:00"
CHANGES_SINCE = "1998-01-01 00:00:00"


@register("scd2_merge", f"{HIST} SELECT * FROM hist")
def q_scd2_merge(spark, d):
    return ob.history(spark, d)


@register("scd2_backfill", f"{HIST} SELECT * FROM hist")
def q_scd2_backfill(spark, d):
    return scd2.history_from_snapshots(ob.stacked(spark, d), ob.KEY, "seq", ob.RUN_TIMES, ts_col="run_ts")


_CLASSIFY_SQL = f"""{HIST}
SELECT coalesce(b2.order_key, b3.order_key) AS order_key,
       CASE WHEN b2.order_key IS NULL THEN 'new' WHEN b3.order_key IS NULL THEN 'retired'
            WHEN b2.attr_hash <> b3.attr_hash THEN 'changed' ELSE 'unchanged' END AS status
FROM b2 FULL OUTER JOIN b3 ON b2.order_key = b3.order_key"""


@register("scd2_classify", _CLASSIFY_SQL)
def q_scd2_classify(spark, d):
    s = ob.snapshots(spark, d)
    h = ob.history(spark, d, ob.RUN_TIMES[:2])
    return scd2.classify(scd2.current(h), s[2], ob.KEY)


@register("scd2_counts", f"""WITH c AS ({_CLASSIFY_SQL})
SELECT count(*) FILTER (WHERE status <> 'retired') AS distinct_keys,
       count(*) FILTER (WHERE status = 'new') AS new,
       count(*) FILTER (WHERE status = 'changed') AS changed,
       count(*) FILTER (WHERE status = 'retired') AS retired,
       count(*) FILTER (WHERE status = 'unchanged') AS unchanged FROM c""")
def q_scd2_counts(spark, d):
    return scd2.merge_counts(q_scd2_classify(spark, d))


@register("scd2_noop", f"""{HIST}
SELECT count(*) AS distinct_keys, CAST(0 AS BIGINT) AS new, CAST(0 AS BIGINT) AS changed,
       CAST(0 AS BIGINT) AS retired, count(*) AS unchanged FROM b3""")
def q_scd2_noop(spark, d):
    h = ob.history(spark, d)
    return scd2.merge_counts(scd2.classify(scd2.current(h), ob.snapshots(spark, d)[2], ob.KEY))


@register("scd2_current", f"{HIST} SELECT * EXCLUDE (valid_to, is_current) FROM hist WHERE is_current")
def q_scd2_current(spark, d):
    return scd2.current(ob.history(spark, d))


@register("scd2_as_of", f"""{HIST}
SELECT * FROM hist WHERE valid_from <= TIMESTAMP '{AS_OF}'
  AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF}')""")
def q_scd2_as_of(spark, d):
    return scd2.as_of(ob.history(spark, d), AS_OF)


@register("scd2_as_of_join", f"""{HIST}
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, h.valid_from AS v_valid_from,
       h.shipped_lines AS v_shipped_lines, h.is_current AS v_is_current
FROM lineitem l LEFT JOIN hist h
  ON h.order_key = l.l_orderkey AND h.valid_from <= l.l_shipdate
 AND (h.valid_to IS NULL OR h.valid_to > l.l_shipdate)""")
def q_scd2_as_of_join(spark, d):
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    h = ob.history(spark, d).select("order_key", "shipped_lines", "valid_from", "valid_to", "is_current")
    # ranges of (order, time): a hot order on the fact side fills as many as it needs
    j = scd2.as_of_join(facts, h, "l_orderkey", "l_shipdate", "order_key", prefix="v_", sliced=True)
    return j.select("l_orderkey", "l_linenumber", "l_shipdate", "v_valid_from", "v_shipped_lines",
                    "v_is_current")


@register("scd2_timeline", f"""{HIST}
SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY valid_from) AS version_no,
       count(*) OVER (PARTITION BY order_key) AS n_versions FROM hist""")
def q_scd2_timeline(spark, d):
    return scd2.timeline(ob.history(spark, d), ob.KEY)


_CHANGE_COLS = ("shipped_lines", "shipped_qty", "priority")
_unions = " UNION ALL ".join(
    f"""SELECT n.order_key, n.valid_from AS changed_at, '{c}' AS attribute,
        CAST(o.{c} AS VARCHAR) AS old_value, CAST(n.{c} AS VARCHAR) AS new_value
      FROM hist n JOIN hist o ON o.order_key = n.order_key AND o.valid_to = n.valid_from
      WHERE n.valid_from > TIMESTAMP '{CHANGES_SINCE}' AND o.{c} IS DISTINCT FROM n.{c}"""
    for c in _CHANGE_COLS)


@register("scd2_changes", f"{HIST} {_unions}")
def q_scd2_changes(spark, d):
    return scd2.changes_between(ob.history(spark, d), ob.KEY, _CHANGE_COLS, since=CHANGES_SINCE)


def _load_all() -> None:
    """Import the query modules so they register themselves (idempotent)."""
    from snapledger.plans import (queries_analytics, queries_checks, queries_geo, queries_ingest,  # noqa: F401
                                  queries_parcels, queries_stream)


def all_queries() -> dict[str, Builder]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)
