"""One run of a source: read, stage, gates, merge, ledger.

The gates stand between staging and merging, so a transfer that broke off, a file
with broken lines or a snapshot that lost many keys never retires rows of the
table.  Every run leaves a ledger row, a refused one too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapledger.operators import gates, scd2, stage
from snapledger.session import cut_lineage
from snapledger.sources import publish, store
from snapledger.sources.fields import FieldSpec


@dataclass(frozen=True)
class Source:
    """How records of a source become rows of a history."""

    fields: list[FieldSpec]
    key_src: str
    key: str
    as_of_year: int
    part_src: str | None = None
    geom_src: str | None = None
    year_cols: tuple[str, ...] = ()


@dataclass(frozen=True)
class Limits:
    """What the gates let through."""

    complete: float = 0.99         # fetched records against the server's count
    shrink: float = 0.95           # snapshot keys against current keys
    allow_shrink: bool = False
    bad_casts: int = 0             # values that can't be read as their type


def ingest(spark: SparkSession, root: str, ledger_path: str, raw_path: str, source: Source, ts: str, *, server_count: int,
           finished_at: str | None = None, limits: Limits = Limits(), keep_raw: bool = True) -> tuple[int, bool]:
    """Ingest the raw records at ``raw_path`` as the run of time ``ts``: (version, changed).

    ``server_count`` is what the source said it holds.  Raises ``GateError`` where a gate
    refuses; the table is then as before.  A run that is in the table already is a no-op.
    """
    ts = publish.canonical_ts(ts)
    counts, casts = Observation(), Observation()
    raw = stage.read_features(spark, raw_path, source.fields, source.key_src, source.part_src, source.geom_src)
    staged = stage.stage_snapshot(raw, source.key_src, source.fields, source.part_src, source.geom_src, source.key,
                                  source.as_of_year, source.year_cols, observation=counts, casts=casts)
    snap = cut_lineage(staged, "staged")          # staged once; the counts are known from here on
    seen, unread = counts.get, casts.get["bad_casts"] or 0
    replay = ts in publish.applied_runs(spark, root)
    before = _open_rows(spark, root, snap)
    status = cut_lineage(scd2.classify(before, snap, source.key), "status")        # one join: counts, gates and merge read it
    counted = cut_lineage(scd2.merge_counts(status), "counts")
    sizes = counted.first()

    def record(outcome: str) -> None:
        # a refused run merged nothing; the archive is what the table's pointer names
        row = store.ledger_row(counted if outcome == "success" else counted.select(*[
            (F.col(c) if c == "distinct_keys" else F.lit(0).cast("long")).alias(c) for c in counted.columns]), store.run_id(ts), ts,
            publish.canonical_ts(finished_at or ts), outcome, server_count=server_count, source_features=seen["source_features"],
            archive_bytes=publish.archive_bytes(spark, root))
        store.record_run(row, ledger_path)

    try:
        if not replay:
            gates.assert_parsed(seen["broken_lines"], unread, limits.bad_casts)
            gates.assert_complete(seen["source_features"], server_count, limits.complete)
            gates.assert_not_shrunk(sizes["changed"] + sizes["retired"] + sizes["unchanged"], sizes["distinct_keys"], limits.shrink, limits.allow_shrink)
        version, changed = publish.merge_and_commit(spark, root, snap, ts, source.key, raw_path=raw_path, keep_raw=keep_raw, status=status)
    except gates.GateError:
        record("refused")
        raise
    if not replay:
        record("success")
    return version, changed


def _open_rows(spark: SparkSession, root: str, snapshot: DataFrame) -> DataFrame:
    v = publish.latest_version(spark, root)
    return scd2.empty_history(snapshot) if v is None else publish.read_version(spark, root, v, "open").where(F.col("is_current"))
