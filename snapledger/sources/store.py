"""History store: ledger rows, schema bootstrap, views, catalog description.

Runs are recorded as one-row DataFrames built *from* the counts DataFrame, so a
run record is part of the same lazy plan as the merge it describes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.values import ts_ntz

LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in (
        "server_count", "source_features", "distinct_parcels", "new_parcels", "changed_parcels",
        "retired_parcels", "unchanged_parcels", "archive_bytes")],
])


def run_id(started_at: str, salt: str = "") -> str:
    """'YYYY-MM-DD-xxxxxxxx': run date plus 8 hex characters (deterministic for a given start + salt)."""
    return f"{started_at[:10]}-{hashlib.md5((started_at + salt).encode()).hexdigest()[:8]}"


def ledger_row(counts: DataFrame, run: str, started_at: str, finished_at: str, status: str = "success", *,
               server_count: Column | int, source_features: Column | int | None = None,
               archive_bytes: int | None = None) -> DataFrame:
    """One ledger row from a ``merge_counts`` frame (distinct_keys, new, changed, retired, unchanged).

    ``server_count`` is what the source said it holds; it must come from there, so that a shortfall shows.
    """
    def val(v, default):
        if v is None:
            return default
        return v if isinstance(v, Column) else F.lit(v)
    return counts.select(
        F.lit(run).alias("run_id"), ts_ntz(started_at).alias("started_at"), ts_ntz(finished_at).alias("finished_at"),
        F.lit(status).alias("status"),
        val(server_count, None).cast("bigint").alias("server_count"),
        val(source_features, F.col("distinct_keys")).cast("bigint").alias("source_features"),
        F.col("distinct_keys").cast("bigint").alias("distinct_parcels"),
        F.col("new").cast("bigint").alias("new_parcels"), F.col("changed").cast("bigint").alias("changed_parcels"),
        F.col("retired").cast("bigint").alias("retired_parcels"),
        F.col("unchanged").cast("bigint").alias("unchanged_parcels"), F.lit(archive_bytes).cast("bigint").alias("archive_bytes"))


def record_run(row: DataFrame, ledger_path: str) -> None:
    """Append the run row to the ledger table (one small file per run)."""
    row.coalesce(1).write.mode("append").parquet(ledger_path)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def open_history(spark: SparkSession, path: str, snapshot_schema: T.StructType, create: bool = False) -> DataFrame:
    """Existing history, or an empty one with the right schema when ``create``; else fail loudly."""
    from snapledger.sources import publish

    version = publish.latest_version(spark, path)
    if version is None:
        if not create:
            raise FileNotFoundError(f"no history at {path} (pass create=True to bootstrap one)")
        fields = list(snapshot_schema.fields) + [
            T.StructField("valid_from", T.TimestampNTZType(), False),
            T.StructField("valid_to", T.TimestampNTZType(), True),
            T.StructField("is_current", T.BooleanType(), False)]
        return spark.createDataFrame([], T.StructType(fields))
    return publish.read_version(spark, path, version)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose named, read-only DataFrames to ad-hoc SQL (``spark.sql``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql_json(spark: SparkSession, query: str) -> DataFrame:
    """Run ad-hoc SQL over registered views; rows as JSON text (``value`` column)."""
    return spark.sql(query).select(F.to_json(F.struct("*")).alias("value"))


def describe(spark: SparkSession) -> DataFrame:
    """Tables / views visible to SQL and their columns: (table, column, data_type)."""
    rows = []
    for t in spark.catalog.listTables():
        for c in spark.catalog.listColumns(t.name):
            rows.append((t.name, c.name, c.dataType))
    return spark.createDataFrame(rows, "table string, column string, data_type string")


def size_bytes(df: DataFrame) -> int:
    """Total size of the files behind a file-based DataFrame (archive-size metric)."""
    spark = df.sparkSession
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total
