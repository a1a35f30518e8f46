"""Abort-before-merge gates: completeness, shrink, monotonic run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.functions.values import ts_ntz


class GateError(RuntimeError):
    pass


def assert_complete(fetched: int, expected: int, ratio: float = 0.99) -> None:
    """Refuse a snapshot when fewer than ``ratio`` of the expected records arrived."""
    if expected > 0 and fetched < ratio * expected:
        raise GateError(f"fetched {fetched} of {expected} records (< {ratio:.0%}); refusing to merge")


def assert_parsed(broken_lines: int, bad_casts: int = 0, most_bad_casts: int = 0) -> None:
    """Refuse a snapshot with lines that are no records, or with more unreadable values than allowed."""
    if broken_lines:
        raise GateError(f"{broken_lines} lines are no records; refusing to merge")
    if bad_casts > most_bad_casts:
        raise GateError(f"{bad_casts} values can't be read as their type (allowed: {most_bad_casts}); refusing to merge")


def assert_not_shrunk(current_count: int, snapshot_count: int, min_ratio: float = 0.95,
                      allow_shrink: bool = False) -> None:
    """Refuse a snapshot drastically smaller than the current table (strict <), unless allowed."""
    if current_count > 0 and snapshot_count < current_count * min_ratio and not allow_shrink:
        raise GateError(f"snapshot has {snapshot_count} keys but {current_count} are current "
                        f"(< {min_ratio} ratio); refusing to merge")


def shrink_counts(history: DataFrame, snapshot: DataFrame) -> tuple[int, int]:
    """(current rows, snapshot rows) in one job: two partial counts joined as one-row frames."""
    c = history.filter(F.col("is_current")).agg(F.count(F.lit(1)).alias("c"))
    s = snapshot.agg(F.count(F.lit(1)).alias("s"))
    r = c.crossJoin(s).first()
    return int(r.c), int(r.s)


def assert_ts_after(history: DataFrame, ts: str) -> None:
    """Runs must move forward: a repeated or older run time would create empty intervals."""
    last = history.agg(F.max("valid_from").alias("m"), F.max(ts_ntz(ts)).alias("t")).first()
    if last.m is not None and last.t <= last.m:
        raise GateError(f"run time {ts} is not after the latest version start {last.m}")
