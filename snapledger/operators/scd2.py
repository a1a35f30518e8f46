"""Slowly-changing (type 2) history: hash, classify, merge, as-of, timeline, change feed.

History layout: the snapshot's columns (key(s), attributes, ``attr_hash``) plus
``valid_from`` / ``valid_to`` (half-open, NULL = open) and ``is_current``.

Scale notes
-----------
* ``merge`` touches only *open* rows: one full-outer join of open rows with the
  snapshot, shuffled on the key.  Closed rows (which grow with every run) pass
  through untouched and are never shuffled.
* Every version of a key is produced by the same join row (``explode`` of at
  most two structs), so no second pass over the join and no self-join.
* ``as_of_join`` is an equi-join on the key with a range residual, or a last-value
  scan over ranges of (key, time), in which a hot key fills as many ranges as it needs.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.functions.values import ts_ntz

VALIDITY = ("valid_from", "valid_to", "is_current")
STATUSES = ("new", "changed", "retired", "unchanged")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _ts(ts) -> Column:
    return ts if isinstance(ts, Column) else ts_ntz(ts)


def row_hash(cols: Iterable[str | Column], extra: Column | None = None,
             strict: bool = False, sep: str = "|") -> Column:
    """md5 over the ordered columns, NULL as '' (or a NULL marker and escaped separator if strict)."""
    parts = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        text = c.cast("string")
        if strict:
            text = F.coalesce(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(sep),
                                        F.lit("\\" + sep)), F.lit("\\N"))
        else:
            text = F.coalesce(text, F.lit(""))
        parts.append(text)
    if extra is not None:
        parts.append(extra)
    return F.md5(F.concat_ws(sep, *parts))


def with_hash(df: DataFrame, exclude: Sequence[str] = (), key: str | Sequence[str] = (),
              hash_col: str = "attr_hash", extra: Column | None = None) -> DataFrame:
    """Append ``attr_hash`` over every column except the key(s) and ``exclude`` (volatile) columns."""
    skip = set(_keys(key)) | set(exclude) | {hash_col}
    return df.withColumn(hash_col, row_hash([c for c in df.columns if c not in skip], extra))


def empty_history(snapshot: DataFrame) -> DataFrame:
    """A history with the snapshot's schema and no rows (schema bootstrap)."""
    return (snapshot.limit(0)
            .withColumn("valid_from", ts_ntz("1970-01-01"))
            .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
            .withColumn("is_current", F.lit(True)))


def current(history: DataFrame) -> DataFrame:
    """The current view: open rows without the validity columns."""
    return history.filter(F.col("is_current")).drop("valid_to", "is_current")


def _joined(open_rows: DataFrame, snapshot: DataFrame, keys: list[str], hash_col: str,
            cols: list[str]) -> tuple[DataFrame, Column]:
    h = open_rows.select([F.col(c).alias("h_" + c) for c in cols])
    s = snapshot.select([F.col(c).alias("s_" + c) for c in cols if c not in ("valid_from",)])
    cond = reduce(lambda a, b: a & b, [F.col("h_" + k) == F.col("s_" + k) for k in keys])
    j = h.join(s, cond, "full_outer")
    has_h = F.col("h_" + keys[0]).isNotNull()
    has_s = F.col("s_" + keys[0]).isNotNull()
    status = (F.when(~has_h, "new").when(~has_s, "retired")
              .when(F.col("h_" + hash_col) != F.col("s_" + hash_col), "changed")
              .otherwise("unchanged"))
    return j, status


def classify(current_rows: DataFrame, snapshot: DataFrame, key: str | Sequence[str],
             hash_col: str = "attr_hash") -> DataFrame:
    """One row per key of either side: (key..., status) with status new/changed/retired/unchanged."""
    keys = _keys(key)
    j, status = _joined(current_rows.select(*keys, hash_col), snapshot.select(*keys, hash_col),
                        keys, hash_col, keys + [hash_col])
    return j.select(*[F.coalesce(F.col("h_" + k), F.col("s_" + k)).alias(k) for k in keys],
                    status.alias("status"))


def merge_counts(classified: DataFrame) -> DataFrame:
    """One row: distinct_keys (snapshot side), new, changed, retired, unchanged (bigint)."""
    st = F.col("status")
    return classified.agg(
        F.count_if(st != "retired").alias("distinct_keys"),
        *[F.count_if(st == s).alias(s) for s in STATUSES])


def merge_versions(history: DataFrame, snapshot: DataFrame, ts, key: str | Sequence[str],
                   hash_col: str = "attr_hash") -> DataFrame:
    """The rows one merge produces: every open row after the merge plus the rows it closed.

    Reads only the open rows of ``history`` (one full-outer join with the
    snapshot, shuffled on the key).  Each join row emits at most two versions
    (``inline``), so the join runs once for both outputs.
    """
    keys = _keys(key)
    data_cols = [c for c in history.columns if c not in VALIDITY]
    if sorted(data_cols) != sorted(snapshot.columns):
        raise ValueError(f"snapshot columns {snapshot.columns} do not match history {data_cols}")
    t = _ts(ts)
    open_rows = history.filter(F.col("is_current"))
    j, status = _joined(open_rows, snapshot, keys, hash_col, data_cols + ["valid_from"])
    closing = status.isin("changed", "retired")
    old = F.when(F.col("h_" + keys[0]).isNotNull(), F.struct(
        *[F.col("h_" + c).alias(c) for c in data_cols],
        F.col("h_valid_from").alias("valid_from"),
        F.when(closing, t).otherwise(F.lit(None).cast("timestamp_ntz")).alias("valid_to"),
        (~closing).alias("is_current")))
    new = F.when(status.isin("new", "changed"), F.struct(
        *[F.col("s_" + c).alias(c) for c in data_cols],
        t.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current")))
    versions = j.select(F.inline(F.array_compact(F.array(old, new))))
    return versions.select(*data_cols, *VALIDITY)


def merge_parts(history: DataFrame, snapshot: DataFrame, ts, key: str | Sequence[str],
                hash_col: str = "attr_hash") -> tuple[DataFrame, DataFrame]:
    """(open rows after the merge, rows closed by this merge) as two filters of ``merge_versions``.

    Acting on both re-runs the join; a store writes ``merge_versions`` once instead
    (see ``publish.merge_and_commit``).
    """
    v = merge_versions(history, snapshot, ts, key, hash_col)
    return v.filter(F.col("is_current")), v.filter(~F.col("is_current"))


def merge(history: DataFrame, snapshot: DataFrame, ts, key: str | Sequence[str],
          hash_col: str = "attr_hash") -> DataFrame:
    """SCD2 merge of one snapshot at ``ts``: close changed and missing keys, insert new versions.

    A key that vanished and returns is *new* (it has no open row), leaving a gap.
    Merging the same snapshot again changes nothing (idempotent).  Closed rows
    already in ``history`` pass through without a shuffle.
    """
    versions = merge_versions(history, snapshot, ts, key, hash_col)
    old_closed = history.filter(~F.col("is_current")).select(*versions.columns)
    return old_closed.unionByName(versions)


def history_from_snapshots(snapshots: DataFrame, key: str | Sequence[str], seq_col: str,
                           run_times: Sequence[str], hash_col: str = "attr_hash",
                           ts_col: str | None = None) -> DataFrame:
    """Backfill: the history that sequential merges of numbered snapshots produce, in one pass.

    ``snapshots`` stacks every snapshot with its sequence number ``seq_col``
    (1..len(run_times)); ``run_times[i-1]`` is the run time of snapshot i.  The
    run times are passed explicitly because a snapshot may be empty.  A version
    starts where a key appears after a gap or its hash differs from the previous
    snapshot; it ends at the run time of the snapshot after its last one.  Rows
    per key are bounded by the number of snapshots, so the per-key window stays
    small whatever the data size.
    """
    from pyspark.sql import Window

    keys = _keys(key)
    spark = snapshots.sparkSession
    n = len(run_times)
    w = Window.partitionBy(*keys).orderBy(seq_col)
    prev_seq = F.lag(seq_col).over(w)
    prev_hash = F.lag(hash_col).over(w)
    start = F.when((prev_seq == F.col(seq_col) - 1) & (prev_hash == F.col(hash_col)), 0).otherwise(1)
    runs = snapshots.withColumn("_start", start).withColumn(
        "_run", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wr = Window.partitionBy(*keys, "_run")
    runs = (runs.withColumn("_end_seq", F.max(seq_col).over(wr))
            .filter(F.col("_start") == 1))
    # one row per run: (seq, time); broadcast is bounded by the number of runs
    times = spark.createDataFrame([(i, t) for i, t in enumerate(run_times, start=1)], "_seq int, _t string") \
        .select("_seq", F.col("_t").cast("timestamp_ntz").alias("_t"))
    starts = F.broadcast(times.select(F.col("_seq").alias("_s_seq"), F.col("_t").alias("_from")))
    ends = F.broadcast(times.select((F.col("_seq") - 1).alias("_e_seq"), F.col("_t").alias("_to")))
    out = (runs.join(starts, F.col(seq_col) == F.col("_s_seq"), "left")
           .join(ends, F.col("_end_seq") == F.col("_e_seq"), "left"))
    drop = {seq_col} | ({ts_col} if ts_col else set())
    data_cols = [c for c in snapshots.columns if c not in drop]
    return out.select(*data_cols, F.col("_from").alias("valid_from"), F.col("_to").alias("valid_to"),
                      (F.col("_end_seq") == F.lit(n)).alias("is_current"))


def as_of(history: DataFrame, t) -> DataFrame:
    """Rows valid at ``t``: valid_from <= t < valid_to (NULL valid_to = open)."""
    t = _ts(t)
    return history.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


def as_of_join(facts: DataFrame, history: DataFrame, fact_key: str, fact_ts: str,
               key: str, how: str = "left", prefix: str = "", sliced: bool = False) -> DataFrame:
    """Attach to every fact the version of its key that was valid at the fact's time.

    An equi-join on the key with a range residual (sort-merge, AQE skew splits apply).  With ``sliced`` facts and
    versions are put in order of key and time instead and cut into ranges of that order, so a key with most of the
    facts, or versions, fills as many ranges as it needs: in each range a fact takes the last version before it, and
    the key that a range goes on with takes the last version of the ranges before (a row per range).  Facts without key or time
    match nothing; a history whose versions of a key don't overlap gives the same rows both ways.
    """
    h = history.select([F.col(c).alias(prefix + c) for c in history.columns])
    k, vf, vt = prefix + key, prefix + "valid_from", prefix + "valid_to"
    if not sliced:
        cond = ((facts[fact_key] == h[k]) & (h[vf] <= facts[fact_ts])
                & (h[vt].isNull() | (h[vt] > facts[fact_ts])))
        return facts.join(h, cond, how)

    from pyspark.sql import Window

    from snapledger.session import cut_lineage

    version, fact = F.struct(*[F.col(f"`{c}`") for c in h.columns]), F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    versions = h.where(F.col(k).isNotNull()).select(F.col(k).alias("_k"), F.col(vf).alias("_t"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"),
                                                    version.alias("_v"))
    events = facts.select(F.col(fact_key).alias("_k"), F.col(fact_ts).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(fact).alias("_tie"), fact.alias("_f"))
    both = versions.unionByName(events, allowMissingColumns=True)
    dealt = cut_lineage(both.repartitionByRange("_k", "_t", "_kind", "_tie").withColumn("_range", F.spark_partition_id()), "as-of-ranges")
    sofar = Window.partitionBy("_range", "_k").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # at most one key of a range began before it: the range's first
    firsts = dealt.groupBy("_range").agg(F.min("_k").alias("_k"))
    last = dealt.where("_kind = 0").join(F.broadcast(firsts.select("_k").distinct()), "_k").groupBy("_range", "_k").agg(F.max_by("_v", "_t").alias("_v"))
    carried = (firsts.alias("a").join(last.alias("b"), (F.col("a._k") == F.col("b._k")) & (F.col("b._range") < F.col("a._range")))
               .groupBy(F.col("a._range").alias("_range"), F.col("a._k").alias("_k")).agg(F.max_by("b._v", "b._range").alias("_carried")))
    met = (dealt.withColumn("_last", F.last("_v", ignorenulls=True).over(sofar)).where("_kind = 1")
           .join(F.broadcast(carried), ["_range", "_k"], "left").withColumn("_last", F.coalesce("_last", "_carried")))
    valid = F.col("_last")[vf].isNotNull() & F.col("_t").isNotNull() & (F.col("_last")[vt].isNull() | (F.col("_last")[vt] > F.col("_t")))
    met = met.withColumn("_last", F.when(valid, F.col("_last")))
    if how == "inner":
        met = met.where(F.col("_last").isNotNull())
    return met.select(*[F.col("_f")[c].alias(c) for c in facts.columns], *[F.col("_last")[c].alias(c) for c in h.columns])


def timeline(history: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every version with its ordinal per key (1 = first) and the number of versions."""
    from pyspark.sql import Window

    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy("valid_from")
    return (history.withColumn("version_no", F.row_number().over(w))
            .withColumn("n_versions", F.count(F.lit(1)).over(Window.partitionBy(*keys))))


def changes_between(history: DataFrame, key: str | Sequence[str], cols: Sequence[str],
                    since=None, until=None) -> DataFrame:
    """Change feed: for adjacent versions, one row per attribute that changed.

    Columns: key..., changed_at, attribute, old_value, new_value (values as text).
    The adjacent-version pair is an equi-join on (key, old.valid_to = new.valid_from).
    """
    keys = _keys(key)
    o = history.filter(F.col("valid_to").isNotNull()).select(
        *[F.col(k).alias("o_" + k) for k in keys], F.col("valid_to").alias("o_valid_to"),
        *[F.col(c).alias("o_" + c) for c in cols])
    n = history
    if since is not None:
        n = n.filter(F.col("valid_from") > _ts(since))
        o = o.filter(F.col("o_valid_to") > _ts(since))
    if until is not None:
        n = n.filter(F.col("valid_from") <= _ts(until))
        o = o.filter(F.col("o_valid_to") <= _ts(until))
    n = n.select(*keys, "valid_from", *[F.col(c).alias("n_" + c) for c in cols])
    cond = reduce(lambda a, b: a & b, [F.col("o_" + k) == F.col(k) for k in keys]) & (
        F.col("o_valid_to") == F.col("valid_from"))
    j = n.join(o, cond, "inner")
    changed = F.array_compact(F.array(*[
        F.when(~F.col("o_" + c).eqNullSafe(F.col("n_" + c)), F.struct(
            F.lit(c).alias("attribute"), F.col("o_" + c).cast("string").alias("old_value"),
            F.col("n_" + c).cast("string").alias("new_value"))) for c in cols]))
    return j.select(*keys, F.col("valid_from").alias("changed_at"), F.inline(changed))
