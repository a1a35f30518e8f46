"""Numeric / temporal value helpers as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
YEAR_BUILT_FLOOR = 1850
# -----------------------------------------------------------------------------


def ts_ntz(value: str | dt.datetime | dt.date) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def duck_int(col: Column) -> Column:
    """Text/number -> INT the way a lenient cast does: '1975.5' -> 1976, '1e3' -> 1000.

    Rounds half away from zero; values that are not finite numbers become NULL.
    """
    d = col.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) > 2147483647), None).otherwise(F.round(d).try_cast("int"))


def plausible_year(col: Column, as_of_year: int) -> Column:
    """TRUE when ``col`` is a year in [1850, as_of_year + 1]; FALSE otherwise, NULL included."""
    return F.coalesce(duck_int(col).between(YEAR_BUILT_FLOOR, as_of_year + 1), F.lit(False))


def capped(col: Column, cap: float) -> Column:
    """least(x, cap) keeping NULL as NULL."""
    return F.when(col.isNotNull(), F.least(col, F.lit(cap)))


def guarded(col: Column, lo, hi) -> Column:
    """x when lo <= x <= hi else NULL."""
    return F.when(col.between(lo, hi), col)


def normalise(col: Column, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi] and scale to [0, 1]; NULL stays NULL."""
    return F.when(col.isNotNull(),
                  (F.least(F.greatest(col.cast("double"), F.lit(float(lo))), F.lit(float(hi))) - lo)
                  / float(hi - lo))


def fmt_dollars(col: Column) -> Column:
    """'$1,234,568' (rounded half away from zero), 'n/a' for NULL."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(F.round(col).cast("bigint"), 0)), F.lit("n/a"))


def cents(col: Column) -> Column:
    """Money as integer cents: the same text in every engine, so hashes agree."""
    return F.round(col * 100).cast("bigint")
