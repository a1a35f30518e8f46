"""Field specs: one list generates the reader schema, the casts, the collapse and the hash."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.values import duck_int

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "smallint": T.ShortType(),
    "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class FieldSpec:
    src: str                    # attribute name in the raw records
    dst: str                    # column name in the history
    type: str = "string"        # one of _TYPES
    epoch_millis: bool = False  # raw value is epoch milliseconds
    volatile: bool = False      # stored, not hashed, collapsed with max()

    @property
    def spark_type(self) -> T.DataType:
        return _TYPES[self.type]


def read_schema(fields: list[FieldSpec], key_src: str, part_src: str | None,
                geom_src: str | None) -> T.StructType:
    """All-STRING staging schema of exactly the spec columns (so the JSON parse is pruned)."""
    names = [key_src] + ([part_src] if part_src else []) + [f.src for f in fields]
    if geom_src:
        names.append(geom_src)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def cast_expr(f: FieldSpec, col: Column | None = None) -> Column:
    """Text -> typed value.  Integers accept '12.0' / '1e3' (rounded), epoch ms -> TIMESTAMP_NTZ."""
    c = F.col(f.src) if col is None else col
    if f.epoch_millis:
        ms = c.try_cast("double")
        return F.timestamp_add("MILLISECOND", F.round(ms).try_cast("bigint"),
                               F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if f.type in ("int", "smallint", "bigint"):
        d = c.try_cast("double")
        return F.when(F.isnan(d), None).otherwise(F.round(d).try_cast(f.type))
    if f.type == "string":
        return c.cast("string")
    return c.try_cast(f.spark_type)


def hashed_columns(fields: list[FieldSpec]) -> list[str]:
    return [f.dst for f in fields if not f.volatile]


__all__ = ["FieldSpec", "read_schema", "cast_expr", "hashed_columns", "duck_int"]
