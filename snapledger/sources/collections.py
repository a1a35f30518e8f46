"""GeoJSON FeatureCollections of any size, read by as many tasks as their bytes need.

A collection is one JSON value, so a JSON reader gives a file to one task.  Here the text reader cuts files at every ``{``
(its line separator), which it does in byte ranges like for any text; what a piece says by itself (its quotes and
braces) is summed up along the file in two levels, within a run of a few thousand pieces and over runs, and tells whether
an opening brace stands inside a string and how deep.  Objects one level below the collection are its features: their
pieces, a few each, are put together again.  No file, no byte range and no list of features has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapledger.session import cut_lineage

FEATURE = "type string, properties map<string,string>, geometry string"
RUN_BITS = 12              # 4096 pieces at most are added up one by one; a window keeps that many in memory, whatever a byte range holds
RUN = ["file", "block", "run"]


def _so_far(rows: DataFrame, value: Column, name: str, add=F.sum) -> DataFrame:
    """``name``: ``value`` added up over the file's rows before this one and this one, in two levels."""
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("_x", value)
    inside = Window.partitionBy(*RUN).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)         # over runs, not rows
    sums = rows.groupBy(*RUN).agg(F.sum("_x").alias("_in")).withColumn("_before", F.coalesce(F.sum("_in").over(before), zero)).drop("_in")
    return (rows.withColumn("_own", F.sum("_x").over(inside)).join(sums, RUN)
            .withColumn(name, F.col("_before") + F.col("_own")).drop("_x", "_own", "_before"))


def _closing(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("}"), F.lit("")))


def features(spark: SparkSession, path: str) -> DataFrame:
    """(file, nth, value): the JSON text of every feature of the collections at ``path``, numbered by its place."""
    raw = spark.read.option("lineSep", "{").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("row"), "value")
    pieces = pieces.withColumn("run", F.shiftright("row", RUN_BITS)).withColumn("bare", F.regexp_replace("value", r"\\.", ""))   # escaped characters say nothing
    quotes = F.length("bare") - F.length(F.replace("bare", F.lit('"'), F.lit("")))
    # braces that close, if the piece begins outside a string and if it begins inside one
    strings = r'"[^"]*"|"[^"]*$'
    counted = pieces.withColumn("quotes", quotes.cast("long")).withColumn("out", _closing(F.regexp_replace("bare", strings, "")).cast("long")).withColumn(
        "in", _closing(F.regexp_replace(F.regexp_replace("bare", r'^[^"]*("|$)', ""), strings, "")).cast("long"))
    counted = cut_lineage(counted.drop("bare"), "pieces")
    starts = counted.where("block = 0").groupBy(*RUN).agg(F.min("row").alias("first"))
    starts = starts.withColumn("of_file", F.min("first").over(Window.partitionBy("file"))).where("first = of_file").drop("of_file")      # over runs
    counted = _so_far(counted, F.col("quotes"), "quoted").join(starts, RUN, "left")
    starts_in = (F.col("quoted") - F.col("quotes")) % 2 == 1
    # the brace before a piece opens an object unless it stands in a string; a file's first piece has none before it
    opened = F.when(starts_in | (F.col("row") == F.coalesce("first", F.lit(-1))), 0).otherwise(1)
    counted = counted.withColumn("opens", opened.cast("long")).withColumn("closes", F.when(starts_in, F.col("in")).otherwise(F.col("out")))
    deep = _so_far(cut_lineage(counted, "opened"), F.col("opens") - F.col("closes"), "after")
    begins = (F.col("opens") == 1) & (F.col("after") + F.col("closes") == 2)
    # what follows the brace that ends the object is not its own: cut behind the closing brace that brings the depth to one
    left = F.col("after") + F.col("closes") - 1
    string = r'"(?:\\.|[^"\\]++)*+"'
    head = F.when(starts_in, F.lit(r'^(?:(?:\\.|[^"\\]++)*+"')).otherwise(F.lit("^(?:"))
    pattern = F.concat(head, F.lit(r'(?:(?:[^"}]++|' + string + r')*+\}){'), left.cast("string"), F.lit("})"))
    ends = (F.col("after") < 2) & (left > 0)
    deep = deep.withColumn("value", F.when(ends, F.regexp_substr(F.col("value"), pattern)).otherwise(F.col("value")))
    deep = cut_lineage(deep.select(*RUN, "row", "value", begins.alias("begins")), "deep")
    named = _so_far(deep, F.when(F.col("begins"), 1).otherwise(0).cast("long"), "nth").where("nth > 0")
    part = F.struct("block", "row", "value")
    whole = named.groupBy("file", "nth").agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["value"]), "{")).alias("value"))
    return whole.where(F.get_json_object("value", "$.type") == "Feature")


def flatten(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row per feature: its properties as text columns, and ``__geometry``, the geometry's JSON text.

    ``columns`` names the properties; without it all that occur are taken, by name.  Absent and null ones are NULL.
    """
    f = cut_lineage(features(spark, path).select(F.from_json("value", FEATURE).alias("f")).select("f.*"), "features")
    if columns is None:
        columns = sorted(r["c"] for r in f.select(F.explode(F.map_keys("properties")).alias("c")).distinct().collect())       # a schema's columns
    return f.select(*[F.col("properties")[c].alias(c) for c in columns], F.col("geometry").alias("__geometry"))
