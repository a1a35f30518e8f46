"""Declarative data checks, evaluated as a few fused aggregations.

A ``Check`` yields a violation count over a named table; it passes when the
count is <= allowance, otherwise it is 'warn' or 'fail' by severity.  Kinds:

* ``row``    -- a row predicate; all row checks on one table become ``count_if``
                columns of ONE aggregation (one scan per table, partial aggs).
* ``agg``    -- an aggregate expression returning the count (also fused), ``count`` one over
                the row counts of several tables.
* ``window`` -- a predicate over a key's rows in order; all of a table and key share one window pass.
* ``set``    -- values outside a catalog; all of a table share one distinct pass.
* ``pair``   -- a predicate over the rows of two tables with one key; all of a pair share one join,
                to which each side brings only the values that the predicates name.
* ``frame``  -- a function of the tables returning a one-row, one-column DataFrame.

Every pass gives one row; their cross join is one row too, and unpivots to the result.

``run_all`` returns one DataFrame (name, severity, violations, allowance,
status) in check order; nothing is collected until the caller acts on it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]
RESULT_SCHEMA = "name string, severity string, violations bigint, allowance bigint, status string"


@dataclass
class Check:
    name: str
    severity: str                      # 'error' | 'warn'
    table: str | None                  # table the row/agg expression reads
    kind: str                          # 'row' | 'agg' | 'count' | 'window' | 'set' | 'pair' | 'frame'
    expr: Column | Callable
    allowance: int = 0
    description: str = ""
    sample: Callable[[Tables], DataFrame] | None = field(default=None, repr=False)
    key: tuple[str, ...] = ()          # of 'window' and 'pair'
    order: str | None = None           # of 'window'
    other: str | None = None           # the second table of 'pair' and 'count'
    values: tuple[dict, dict] = field(default_factory=lambda: ({}, {}), repr=False)   # of 'pair': name -> Column, per side


# ----------------------------------------------------------------- generic forms
def row(name, table, violation: Column, severity="error", allowance=0, description="",
        sample_cols: Sequence[str] | None = None) -> Check:
    """Rows where ``violation`` is TRUE (NULL counts as not violating)."""
    sample = None
    if sample_cols:
        sample = lambda t: t[table].filter(violation).select(*sample_cols)
    return Check(name, severity, table, "row", violation, allowance, description, sample)


def not_null(name, table, cols: Sequence[str], blank: bool = False, **kw) -> Check:
    pred = None
    for c in cols:
        p = F.col(c).isNull()
        if blank:
            p = p | (F.trim(F.col(c).cast("string")) == "")
        pred = p if pred is None else (pred | p)
    return row(name, table, pred, **kw)


def between(name, table, col: Column, lo, hi, **kw) -> Check:
    """Non-NULL values outside [lo, hi]."""
    return row(name, table, col.isNotNull() & ((col < lo) | (col > hi)), **kw)


def sums_to(name, table, total: Column, parts: Sequence[Column], tol=0.005, **kw) -> Check:
    s = None
    for p in parts:
        s = F.coalesce(p, F.lit(0)) if s is None else s + F.coalesce(p, F.lit(0))
    return row(name, table, F.abs(F.coalesce(total, F.lit(0)) - s) > tol, **kw)


def iff(name, table, a: Column, b: Column, **kw) -> Check:
    """a and b disagree (NULL on either side is not counted)."""
    return row(name, table, a != b, **kw)


def agg(name, table, expr: Column, **kw) -> Check:
    severity = kw.pop("severity", "error")
    allowance = kw.pop("allowance", 0)
    return Check(name, severity, table, "agg", expr, allowance, kw.pop("description", ""))


def count_between(name, table, lo, hi, where: Column | None = None, **kw) -> Check:
    n = F.count_if(where) if where is not None else F.count(F.lit(1))
    return agg(name, table, F.when(n.between(lo, hi), 0).otherwise(1), **kw)


def count_at_least(name, table, lo, where: Column | None = None, **kw) -> Check:
    n = F.count_if(where) if where is not None else F.count(F.lit(1))
    return agg(name, table, F.when(n < lo, 1).otherwise(0), **kw)


def share_at_least(name, table, pred: Column, share: float, where: Column | None = None, **kw) -> Check:
    """1 when fewer than ``share`` of the (``where``) rows satisfy ``pred``."""
    if where is None:
        hit, n = F.count_if(pred), F.count(F.lit(1))
    else:
        hit, n = F.count_if(where & pred), F.count_if(where)
    return agg(name, table, F.when(hit >= F.lit(share) * n, 0).otherwise(1), **kw)


def share_at_most(name, table, pred: Column, share: float, **kw) -> Check:
    return agg(name, table, F.when(F.count_if(pred) > F.lit(share) * F.count(F.lit(1)), 1).otherwise(0), **kw)


def fresh_within(name, table, col: str, as_of: Column, max_age: str, where: Column | None = None,
                 missing_fails: bool = False, **kw) -> Check:
    """1 when max(col) is older than as_of - max_age (an empty table passes unless missing_fails)."""
    c = F.col(col) if where is None else F.when(where, F.col(col))
    m = F.max(c)
    stale = m < as_of - F.expr(f"INTERVAL {max_age}")
    bad = (m.isNull() | stale) if missing_fails else stale
    return agg(name, table, F.when(bad, 1).otherwise(0), **kw)


def _frame(name, fn, severity="error", allowance=0, description="", sample=None) -> Check:
    return Check(name, severity, None, "frame", fn, allowance, description, sample)


def _over(name, table, key, order, violation, severity="error", allowance=0, description="", sample=None) -> Check:
    return Check(name, severity, table, "window", violation, allowance, description, sample, tuple(key), order)


def unique(name, table, key: Sequence[str], where: Column | None = None, **kw) -> Check:
    """Keys occurring more than once (among ``where`` rows)."""
    there = F.lit(True) if where is None else F.coalesce(where, F.lit(False))

    def sample(t):
        return t[table].filter(there).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(*key)
    # such a key is counted where its second row stands
    return _over(name, table, key, None, lambda w: there & (F.count_if(there).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 2),
                 sample=sample, **kw)


def intervals_disjoint(name, table, key: Sequence[str], start="valid_from", end="valid_to", **kw) -> Check:
    """Next interval of the key starts before this one ends (or this one is open)."""
    def violation(w):
        following = F.lead(start).over(w)
        return following.isNotNull() & (F.col(end).isNull() | (following < F.col(end)))
    return _over(name, table, key, start, violation, **kw)


def no_consecutive_duplicates(name, table, key: Sequence[str], order="valid_from",
                              value="attr_hash", **kw) -> Check:
    return _over(name, table, key, order, lambda w: F.col(value) == F.lag(value).over(w), **kw)


def in_set(name, table, values: Iterable[str], col: Column | Sequence[Column], severity="error", allowance=0, description="") -> Check:
    """Distinct non-NULL values (of one or several columns, unpivoted) outside the catalog."""
    cols = [col] if isinstance(col, Column) else list(col)
    allowed = list(values)
    outside = [F.when(~c.cast("string").isin(allowed), c.cast("string")) for c in cols]

    def sample(t):
        v = t[table].select(F.explode(F.array(*outside)).alias("v"))
        return v.filter(F.col("v").isNotNull()).distinct().orderBy("v")
    return Check(name, severity, table, "set", lambda: outside, allowance, description, sample)


def lookup_complete(name, table, expr: Column, lookup: Callable[[Tables], DataFrame],
                    where: Column | None = None, **kw) -> Check:
    """Rows whose ``expr`` has no match in the lookup's single column (anti join)."""
    def rows(t):
        d = t[table] if where is None else t[table].filter(where)
        lk = lookup(t)
        lk = lk.select(F.col(lk.columns[0]).alias("_lk"))
        return d.withColumn("_x", expr).join(lk, F.col("_x") == F.col("_lk"), "left_anti")
    return _frame(name, lambda t: rows(t).agg(F.count(F.lit(1)).alias("v")),
                  sample=lambda t: rows(t).select(F.col("_x").alias("value")).distinct().orderBy("value"), **kw)


def lookup_hits(name, table, expr: Column, lookup: Callable[[Tables], DataFrame],
                where: Column | None = None, **kw) -> Check:
    """Rows whose ``expr`` *is* found in the lookup (semi join) -- e.g. conflicting signals."""
    def rows(t):
        d = t[table] if where is None else t[table].filter(where)
        lk = lookup(t)
        lk = lk.select(F.col(lk.columns[0]).alias("_lk"))
        return d.withColumn("_x", expr).join(lk, F.col("_x") == F.col("_lk"), "left_semi")
    return _frame(name, lambda t: rows(t).agg(F.count(F.lit(1)).alias("v")), **kw)


def same_count(name, a: str, b: str, severity="error", allowance=0, description="") -> Check:
    """1 when the two tables differ in row count."""
    return Check(name, severity, a, "count", lambda x, y: F.when(x != y, 1).otherwise(0), allowance, description, other=b)


def row_preserving(name, before: str, after: str, severity="error", allowance=0, description="") -> Check:
    """By how many rows the two tables differ."""
    return Check(name, severity, before, "count", lambda x, y: F.abs(x - y), allowance, description, other=after)


def no_column(name, table, column: str, **kw) -> Check:
    """Schema check: the table must not carry ``column`` (answered from the plan, no scan)."""
    def fn(t):
        n = int(column in t[table].columns)
        return t[table].sparkSession.range(1).select(F.lit(n).cast("bigint").alias("v"))
    return _frame(name, fn, **kw)


def joined(name, left: str, right: str, key: Sequence[str], violation: Column, left_values: dict[str, Column], right_values: dict[str, Column],
           severity="error", allowance=0, description="") -> Check:
    """Rows of left JOIN right USING (key) where ``violation`` holds.

    ``violation`` is over the names of ``left_values`` and ``right_values``; only those values and the key are shuffled,
    so a predicate on a wide column (a geometry) is best evaluated on its own side.
    """
    return Check(name, severity, left, "pair", violation, allowance, description, None, tuple(key), None, right, (left_values, right_values))


def frame(name, fn: Callable[[Tables], DataFrame], **kw) -> Check:
    """Escape hatch: any one-row DataFrame whose first column is the violation count."""
    return _frame(name, fn, **kw)


# ----------------------------------------------------------------- evaluation
def status_col(violations: Column, allowance: Column, severity: Column) -> Column:
    v = F.coalesce(violations, F.lit(0))
    return F.when(v <= allowance, "pass").when(severity == "warn", "warn").otherwise("fail")


def _fused(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """One row with a column ``v<i>`` per check: the cross join of a row for each table, window, set or pair pass."""
    passes: dict[tuple, list[int]] = {}
    for i, c in enumerate(checks):
        passes.setdefault({"row": ("table", c.table), "agg": ("table", c.table), "window": ("window", c.table, c.key), "set": ("set", c.table),
                           "pair": ("pair", c.table, c.other, c.key)}.get(c.kind, ("own", i)), []).append(i)
    counted = {t for c in checks if c.kind == "count" for t in (c.table, c.other)}
    for t in counted:
        passes.setdefault(("table", t), [])
    number = {t: n for n, t in enumerate(sorted(counted))}
    out = []
    for (kind, *of), members in passes.items():
        if kind == "table":
            cols = [(F.count_if(checks[i].expr) if checks[i].kind == "row" else checks[i].expr).cast("bigint").alias(f"v{i}") for i in members]
            cols += [F.count(F.lit(1)).alias(f"n{number[of[0]]}")] if of[0] in number else []
            out.append(tables[of[0]].agg(*cols))
        elif kind == "window":
            orders = {checks[i].order for i in members} - {None}
            for order in orders or {None}:
                w = Window.partitionBy(*of[1]).orderBy(order or of[1][0])
                own = [i for i in members if checks[i].order == order or (checks[i].order is None and order == min(orders, default=None))]
                flagged = tables[of[0]].select(*[checks[i].expr(w).alias(f"v{i}") for i in own])
                out.append(flagged.agg(*[F.count_if(f"v{i}").alias(f"v{i}") for i in own]))
        elif kind == "set":
            each = [F.struct(F.lit(i).alias("i"), v.alias("v")) for i in members for v in checks[i].expr()]
            seen = tables[of[0]].select(F.explode(F.array(*each)).alias("x")).select("x.*").where("v IS NOT NULL").distinct()
            out.append(seen.agg(*[F.count_if(F.col("i") == i).alias(f"v{i}") for i in members]))
        elif kind == "pair":
            sides = []
            for side, table in enumerate(of[:2]):
                named: dict[str, Column] = {}
                for i in members:
                    for n, v in checks[i].values[side].items():
                        if n in named and str(named[n]) != str(v):
                            raise ValueError(f"two checks of {of[0]} and {of[1]} mean different values by {n!r}")
                        named[n] = v
                sides.append(tables[table].select(*of[2], *[v.alias(n) for n, v in named.items()]))
            both = sides[0].join(sides[1], list(of[2]))
            out.append(both.agg(*[F.count_if(checks[i].expr).alias(f"v{i}") for i in members]))
        elif checks[members[0]].kind == "frame":
            df = checks[members[0]].expr(tables)
            out.append(df.select(F.col(df.columns[0]).cast("bigint").alias(f"v{members[0]}")))
    one = out[0] if out else None
    for more in out[1:]:
        one = one.crossJoin(more)                        # one row each
    counts = [checks[i].expr(F.col(f"n{number[checks[i].table]}"), F.col(f"n{number[checks[i].other]}")).cast("bigint").alias(f"v{i}")
              for i in range(len(checks)) if checks[i].kind == "count"]
    return one.select("*", *counts)


def violation_counts(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """(name, violations) for every check; see the kinds above for what shares a pass."""
    wide = _fused(tables, checks)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c.name).alias("name"), F.col(f"v{i}").alias("violations"))
                                           for i, c in enumerate(checks)])).alias("x")).select("x.*")


def run_all(tables: Tables, checks: Sequence[Check], error_only: bool = False) -> DataFrame:
    """Evaluate the suite (or only error-severity checks): name, severity, violations, allowance, status."""
    sel = [c for c in checks if c.severity == "error"] if error_only else list(checks)
    spark: SparkSession = next(iter(tables.values())).sparkSession
    if not sel:
        return spark.createDataFrame([], "ord int, " + RESULT_SCHEMA)
    meta = spark.createDataFrame(
        [(i, c.name, c.severity, int(c.allowance)) for i, c in enumerate(sel)],
        "ord int, name string, severity string, allowance bigint")
    counts = violation_counts(tables, sel)
    # meta has one row per check: a bounded, broadcastable side
    j = F.broadcast(meta).join(counts, "name", "left")
    v = F.coalesce(F.col("violations"), F.lit(0)).cast("bigint")
    return j.select("ord", "name", "severity", v.alias("violations"), "allowance",
                    status_col(v, F.col("allowance"), F.col("severity")).alias("status"))


def evaluate(tables: Tables, check: Check) -> dict:
    """Run one check; samples (at most 5 rows) only when it does not pass."""
    r = run_all(tables, [check]).first()
    out = {"name": r.name, "severity": r.severity, "violations": r.violations,
           "allowance": r.allowance, "status": r.status, "samples": None}
    if r.status != "pass" and check.sample is not None:
        out["samples"] = [x.asDict() for x in check.sample(tables).limit(5).collect()]
    return out


def report(tables: Tables, checks: Sequence[Check], error_only: bool = False) -> list[dict]:
    """Outcomes in order, with JSON-able samples for failing checks (the suite is small and fixed)."""
    by_name = {c.name: c for c in checks}
    rows = run_all(tables, checks, error_only).orderBy("ord").collect()
    out = []
    for r in rows:
        d = {"name": r.name, "severity": r.severity, "violations": r.violations,
             "allowance": r.allowance, "status": r.status, "samples": None}
        c = by_name[r.name]
        if r.status != "pass" and c.sample is not None:
            d["samples"] = json.loads(json.dumps([x.asDict() for x in c.sample(tables).limit(5).collect()],
                                                 default=str))
        out.append(d)
    return out


def totals(results: DataFrame) -> DataFrame:
    """(status, checks): how many checks of a suite's results ended so, each status with a row."""
    every = results.sparkSession.createDataFrame([("pass",), ("warn",), ("fail",)], "status string")
    n = results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))
    return F.broadcast(every).join(n, "status", "left").select("status", F.coalesce("checks", F.lit(0).cast("long")).alias("checks"))


def audit(tables: Tables, checks: Sequence[Check]) -> tuple[list[dict], dict[str, int], int]:
    """Outcomes that did not pass (with samples), totals by status, and an exit code: 1 if any check failed."""
    outcomes = report(tables, checks)
    total = {"pass": 0, "warn": 0, "fail": 0}
    for o in outcomes:
        total[o["status"]] += 1
    return [o for o in outcomes if o["status"] != "pass"], total, int(total["fail"] > 0)


class ChecksFailed(AssertionError):
    pass


def assert_zero(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """Notebook-style: every listed check must have zero violations; raise otherwise."""
    res = run_all(tables, [replace(c, severity="error", allowance=0) for c in checks])
    bad = res.filter("violations <> 0").collect()
    if bad:
        raise ChecksFailed(f"{len(bad)} check(s) failed: " + ", ".join(f"{r.name}={r.violations}" for r in bad))
    return res


def gate(tables: Tables, checks: Sequence[Check]) -> None:
    """Publish gate: raise when any error-severity check fails."""
    fails = run_all(tables, checks, error_only=True).filter("status = 'fail'").collect()
    if fails:
        raise ChecksFailed("refusing to publish: " + ", ".join(f"{r.name} ({r.violations})" for r in fails))


__all__ = [n for n in dir() if not n.startswith("_")] + ["T"]
