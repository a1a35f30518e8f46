"""Registered queries: run ledger and audit suites over the order-book history."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapledger.functions.values import ts_ntz
from snapledger.operators import checks as ck
from snapledger.operators import scd2
from snapledger.plans import orderbook as ob
from snapledger.plans import registry
from snapledger.plans.registry import register
from snapledger.plans.tables import table
from snapledger.session import cut_lineage
from snapledger.sources import store

AS_OF = "2000-01-02 00:00:00"
HIST = ob.history_ctes()


def _runs(spark, d):
    """One ledger row per merge: counts of snapshot i against the current rows before it."""
    snaps = ob.snapshots(spark, d)
    prev = scd2.empty_history(snaps[0])
    out = None
    for i, (s, t) in enumerate(zip(snaps, ob.RUN_TIMES)):
        counts = scd2.merge_counts(scd2.classify(scd2.current(prev) if i else prev.drop("valid_from", "valid_to", "is_current"), s, ob.KEY))
        finished = t[:11] + "01:00:00"
        row = store.ledger_row(counts, store.run_id(t), t, finished, server_count=F.col("distinct_keys"))
        out = row if out is None else out.unionByName(row)
        prev = s.withColumn("valid_from", ts_ntz(t)).withColumn("valid_to", F.lit(None).cast("timestamp_ntz")) \
            .withColumn("is_current", F.lit(True))
    return out


def _ledger_sql():
    parts = []
    n = len(ob.RUN_TIMES)
    for i, t in enumerate(ob.RUN_TIMES, start=1):
        prev = f"b{i - 1}" if i > 1 else "(SELECT * FROM b1 WHERE false)"
        parts.append(f"""SELECT '{store.run_id(t)}' AS run_id, TIMESTAMP '{t}' AS started_at,
          TIMESTAMP '{t[:11]}01:00:00' AS finished_at, 'success' AS status,
          count(*) FILTER (WHERE s.order_key IS NOT NULL) AS server_count,
          count(*) FILTER (WHERE s.order_key IS NOT NULL) AS source_features,
          count(*) FILTER (WHERE s.order_key IS NOT NULL) AS distinct_parcels,
          count(*) FILTER (WHERE c.order_key IS NULL) AS new_parcels,
          count(*) FILTER (WHERE c.order_key IS NOT NULL AND s.order_key IS NOT NULL AND c.attr_hash <> s.attr_hash) AS changed_parcels,
          count(*) FILTER (WHERE s.order_key IS NULL) AS retired_parcels,
          count(*) FILTER (WHERE c.order_key IS NOT NULL AND s.order_key IS NOT NULL AND c.attr_hash = s.attr_hash) AS unchanged_parcels
        FROM {prev} c FULL OUTER JOIN b{i} s ON c.order_key = s.order_key""")
    assert n == 3
    return f"{HIST} " + " UNION ALL ".join(parts)


@register("ledger", _ledger_sql())
def q_ledger(spark, d):
    return _runs(spark, d).drop("archive_bytes")        # the size of files is not in the tables


def history_checks(as_of: str = AS_OF) -> list[ck.Check]:
    """The SCD2 invariants and freshness checks, as generic-form instances."""
    t = ts_ntz(as_of)
    return [
        ck.count_at_least("current_count_min", "current", 1000),
        ck.not_null("key_nonempty", "history", ["order_key"], blank=True),
        ck.unique("one_current_per_key", "history", ["order_key"], where=F.col("is_current")),
        ck.intervals_disjoint("no_overlapping_versions", "history", ["order_key"]),
        ck.row("valid_interval_ordered", "history",
               F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from"))),
        ck.row("closed_rows_not_current", "history", F.col("is_current") != F.col("valid_to").isNull()),
        ck.no_consecutive_duplicates("no_consecutive_duplicate_versions", "history", ["order_key"]),
        ck.row("no_future_valid_from", "history", F.col("valid_from") > t + F.expr("INTERVAL 1 HOUR")),
        ck.fresh_within("ingest_freshness", "runs", "finished_at", t, "48 HOURS",
                        where=F.col("status") == "success", missing_fails=True),
    ]


def _hist_tables(spark, d):
    # audit a materialised history (reliable checkpoint), not one re-derivation per check
    h = cut_lineage(ob.history(spark, d), "audited-history")
    return {"history": h, "current": scd2.current(h), "runs": _runs(spark, d)}


def _checks_sql(rows):
    parts = []
    for i, (n, sev, a, sql) in enumerate(rows):
        v = f"CAST(coalesce(({sql}), 0) AS BIGINT)"
        parts.append(f"""SELECT {i} AS ord, '{n}' AS name, '{sev}' AS severity, {v} AS violations,
          CAST({a} AS BIGINT) AS allowance,
          CASE WHEN {v} <= {a} THEN 'pass' WHEN '{sev}' = 'warn' THEN 'warn' ELSE 'fail' END AS status""")
    return " UNION ALL ".join(parts)


_T = f"TIMESTAMP '{AS_OF}'"


def _bad(condition: str, source: str) -> str:
    """How many rows of ``source`` break a rule."""
    return f"SELECT sum(CASE WHEN {condition} THEN 1 ELSE 0 END) FROM {source}"


def _unless(condition: str, source: str) -> str:
    """1 unless an aggregate condition over ``source`` holds."""
    return f"SELECT CASE WHEN {condition} THEN 0 ELSE 1 END FROM {source}"


def _placed(source: str, key: str) -> str:
    """The rows of ``source`` numbered within their key: ``o`` follows ``h`` if its number is larger."""
    return f"(SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY valid_from) AS nth FROM {source})"


def _several_open(source: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING sum(CAST(is_current AS INTEGER)) >= 2)"


def _overlapping(source: str, key: str) -> str:
    """Versions that are not over when a later one of their key begins."""
    return (f"SELECT count(DISTINCT (h.{key}, h.nth)) FROM {_placed(source, key)} h JOIN {_placed(source, key)} o "
            f"ON o.{key} = h.{key} AND o.nth > h.nth AND o.valid_from < coalesce(h.valid_to, 'infinity'::TIMESTAMP)")


def _repeated(source: str, key: str, content: str) -> str:
    """Versions with the content of the one before."""
    return f"SELECT count(*) FROM {_placed(source, key)} h JOIN {_placed(source, key)} o ON o.{key} = h.{key} AND o.nth = h.nth + 1 AND {content}"


def _not_since(source: str, column: str, now: str, age: str, where: str = "true", empty: int = 0) -> str:
    """1 if nothing in ``source`` is younger than ``age``; ``empty`` if there is nothing at all."""
    return (f"SELECT CASE WHEN count(*) = 0 THEN {empty} WHEN bool_or({column} >= {now} - INTERVAL {age}) THEN 0 ELSE 1 END "
            f"FROM {source} WHERE {column} IS NOT NULL AND {where}")


@register("checks_history", f"""{HIST}, ledger_runs AS ({_ledger_sql()[len(HIST):]}) {_checks_sql([
    ("current_count_min", "error", 0, _unless("sum(CAST(is_current AS INTEGER)) >= 1000", "hist")),
    ("key_nonempty", "error", 0, _bad("coalesce(trim(CAST(order_key AS VARCHAR)), '') = ''", "hist")),
    ("one_current_per_key", "error", 0, _several_open("hist", "order_key")),
    ("no_overlapping_versions", "error", 0, _overlapping("hist", "order_key")),
    ("valid_interval_ordered", "error", 0, _bad("valid_from >= valid_to", "hist")),
    ("closed_rows_not_current", "error", 0, _bad("(valid_to IS NULL AND NOT is_current) OR (valid_to IS NOT NULL AND is_current)", "hist")),
    ("no_consecutive_duplicate_versions", "error", 0, _repeated("hist", "order_key", "o.attr_hash = h.attr_hash")),
    ("no_future_valid_from", "error", 0, _bad(f"valid_from - INTERVAL 1 HOUR > {_T}", "hist")),
    ("ingest_freshness", "error", 0, _not_since("ledger_runs", "finished_at", _T, "48 HOUR", "status = 'success'", 1)),
])}""")
def q_checks_history(spark, d):
    return ck.run_all(_hist_tables(spark, d), history_checks())


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")


def orderbook_checks() -> list[ck.Check]:
    """Generic forms on the current order book and its published artifact (non-trivial counts)."""
    return [
        ck.row("shipped_within_lines", "current", F.col("shipped_lines") > F.col("n_lines")),
        ck.between("total_cents_sane", "current", F.col("total_cents"), 500000, 40000000, severity="warn",
                   allowance=10),
        ck.in_set("priority_known", "current", PRIORITIES, F.col("priority"), severity="warn"),
        ck.iff("qty_iff_lines", "current", F.col("shipped_qty") > 0, F.col("shipped_lines") > 0),
        ck.share_at_least("mostly_with_lines", "current", F.col("n_lines") > 0, 0.99, severity="warn"),
        ck.share_at_most("few_half_shipped", "current", F.col("shipped_lines") * 2 >= F.col("n_lines"), 0.5,
                         severity="warn"),
        ck.count_between("book_sized_right", "current", 100, 100000000),
        ck.lookup_complete("customer_known", "current", F.col("cust_key"),
                           lambda t: t["customer"].select("c_custkey")),
        ck.lookup_hits("urgent_with_big_customers", "current", F.col("cust_key"),
                       lambda t: t["customer"].filter(F.col("c_acctbal") > 9000).select("c_custkey"),
                       where=F.col("priority") == "1-URGENT", severity="warn", allowance=5),
        ck.same_count("artifact_row_count_matches", "artifact", "current"),
        ck.no_column("artifact_drops_hash", "artifact", "attr_hash"),
        ck.joined("artifact_keeps_progress", "artifact", "current", ["order_key"], F.col("published") != F.col("shipped"),
                  {"published": F.col("shipped_lines")}, {"shipped": F.col("shipped_lines")}),
    ]


def _book_tables(spark, d):
    h = cut_lineage(ob.history(spark, d), "audited-history")
    cur = scd2.current(h)
    return {"current": cur, "artifact": cur.drop("attr_hash"), "customer": table(spark, d, "customer")}


@register("checks_orderbook", f"""{HIST}, cur AS (SELECT * FROM hist WHERE is_current) {_checks_sql([
    ("shipped_within_lines", "error", 0, "SELECT count(*) FROM cur WHERE shipped_lines > n_lines"),
    ("total_cents_sane", "warn", 10,
     "SELECT count(*) FROM cur WHERE total_cents IS NOT NULL AND (total_cents < 500000 OR total_cents > 40000000)"),
    ("priority_known", "warn", 0, f"""SELECT count(*) FROM (SELECT DISTINCT priority FROM cur
        WHERE priority IS NOT NULL AND priority NOT IN {tuple(PRIORITIES)!r})"""),
    ("qty_iff_lines", "error", 0, "SELECT count(*) FROM cur WHERE (shipped_qty > 0) <> (shipped_lines > 0)"),
    ("mostly_with_lines", "warn", 0,
     "SELECT CASE WHEN count(*) FILTER (WHERE n_lines > 0) >= 0.99 * count(*) THEN 0 ELSE 1 END FROM cur"),
    ("few_half_shipped", "warn", 0,
     "SELECT CASE WHEN count(*) FILTER (WHERE shipped_lines * 2 >= n_lines) > 0.5 * count(*) THEN 1 ELSE 0 END FROM cur"),
    ("book_sized_right", "error", 0, "SELECT CASE WHEN count(*) BETWEEN 100 AND 100000000 THEN 0 ELSE 1 END FROM cur"),
    ("customer_known", "error", 0,
     "SELECT count(*) FROM cur WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = cur.cust_key)"),
    ("urgent_with_big_customers", "warn", 5, """SELECT count(*) FROM cur WHERE priority = '1-URGENT'
        AND cust_key IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)"""),
    ("artifact_row_count_matches", "error", 0,
     "SELECT abs((SELECT count(*) FROM hist WHERE valid_to IS NULL) - (SELECT count(*) FROM cur))"),
    ("artifact_drops_hash", "error", 0, "SELECT count(*) FROM (SELECT json_keys(to_json(c)) AS k FROM "
     "(SELECT * EXCLUDE (attr_hash) FROM cur LIMIT 1) c) WHERE list_contains(k, 'attr_hash')"),
    ("artifact_keeps_progress", "error", 0, """SELECT count(*) FROM cur JOIN hist USING (order_key)
        WHERE hist.valid_to IS NULL AND cur.shipped_lines IS DISTINCT FROM hist.shipped_lines"""),
])}""")
def q_checks_orderbook(spark, d):
    return ck.run_all(_book_tables(spark, d), orderbook_checks())


@register("audit_totals", f"""SELECT t.status, count(r.status) AS checks FROM (VALUES ('pass'), ('warn'), ('fail')) t(status)
LEFT JOIN ({registry.ORACLES["checks_orderbook"]}) r ON r.status = t.status GROUP BY t.status""")
def q_audit_totals(spark, d):
    """How many checks of the order book's suite pass, warn and fail."""
    return ck.totals(ck.run_all(_book_tables(spark, d), orderbook_checks()))


# ----------------------------------------------------------------------------- the 54-check parcel suite
from snapledger.plans import audit_fixture, parcels  # noqa: E402


@register("checks_parcels", f"{audit_fixture.oracle_tables()} {_checks_sql(audit_fixture.oracle_checks(_bad, _unless, _several_open, _overlapping, _repeated, _not_since))}")
def q_checks_parcels(spark, d):
    """The suite over three merged runs with at least one row against every rule."""
    return ck.run_all(audit_fixture.tables(spark, d), parcels.parcel_checks(audit_fixture.AS_OF, 2026))
