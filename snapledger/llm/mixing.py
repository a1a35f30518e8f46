"""Mixing sources to target weights: capped water-filling over sources, then seeded sampling.

All steps are DataFrame operations.  Sources are one small aggregated row each; documents are only
ever counted, bucketed by a seeded hash and joined to the rows of their source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import join_groups, materialise

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """``target`` per source of (nth, size, weight): shares of the whole size by weight, at most cap * size.

    Sources whose share exceeds their cap are clamped to it and the excess is shared by weight among
    the others, until none is above.  The fixed point follows in one pass: with sources in order of
    cap / weight, the clamped ones come first, and source i is clamped if what remains after those
    before it, shared by the weights from i on, reaches its cap.  Sources without size get 0.
    """
    order = Window.orderBy("fill", "nth")                               # one row per source
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = sources.agg(F.sum("size").cast("double").alias("total"))
    level = (sources.where("size > 0").withColumn("top", F.lit(cap) * F.col("size"))
             .withColumn("fill", F.col("top") / F.col("weight"))
             .crossJoin(total)                                         # one row
             .withColumn("level", (F.col("total") - F.coalesce(F.sum("top").over(before), F.lit(0.0)))
                         / F.sum("weight").over(after)))
    # the level of the first source that is not clamped, the highest of these, holds for it and all after it
    free = level.where("fill > level").agg(F.max("level").alias("water"))
    told = level.crossJoin(free).select("nth", F.least(
        F.col("top"), F.coalesce(F.col("water"), F.lit(float("inf"))) * F.col("weight")).alias("target"))
    return sources.join(told, "nth", "left").withColumn("target", F.coalesce("target", F.lit(0.0)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0, seed: int = 42, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", carry: bool = False) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``, with ``carry`` also its ``row`` as a struct.

    Sources in order of code points, null last, get ``weights`` in turn.  A source is repeated
    floor(target / source_size) times whole; for the rest its documents are taken in a seeded order
    (by MD5 of the id) until the target is reached, the last one in part.  So a source's taken words
    are its target to within one word, and no document is taken more than ``cap`` times.

    Null or blank texts have size 0 and are taken 0 times; rows with equal ids and texts take
    neighbouring places in the order; a source without words has target 0.  Reruns agree.
    """
    def sized(*more: Column) -> DataFrame:
        source = F.col(source_col).cast("string")
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), n_words(F.col(text_col)).alias("size"),
                           F.xxhash64(text_col).alias("tie"), F.coalesce(source, F.lit("")).alias("key"), source.isNull().alias("no"), *more)

    narrow = materialise(sized(), "sizes")
    by_source = narrow.groupBy("key", "no").agg(F.sum("size").alias("size"), F.count("*").alias("n_rows"))
    nth = F.row_number().over(Window.orderBy("no", "key")) - 1          # one row per source
    listed = by_source.withColumn("nth", nth).withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int")))
    listed = materialise(listed, "sources")
    filled = water_fill(listed.select("nth", "size", "weight"), cap).select("nth", "target")
    plan = materialise(listed.withColumnRenamed("size", "source_size").join(filled, "nth").drop("weight"), "plan")

    # Prefix sums of sizes in seeded order, in two levels: a source of n rows is sqrt(n) buckets.
    total = narrow.count()

    def placed(rows: DataFrame) -> DataFrame:
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 8)
        known = join_groups(rows.withColumn("place", F.conv(digits, 16, 10).cast("long")), plan, ["key", "no"], "n_rows", total, "inner")
        return known.withColumn("bucket", F.floor(F.col("place") / F.lit(2.0 ** 32) * F.ceil(F.sqrt("n_rows"))))

    sums = placed(narrow).groupBy("nth", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("n_in"))
    up_to = Window.partitionBy("nth").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialise(sums.withColumn("before", F.coalesce(F.sum("words").over(up_to), F.lit(0))).drop("words"), "buckets")
    inside = (Window.partitionBy("nth", "bucket").orderBy("place", "doc_id", "size", "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = placed(sized(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")) if carry else narrow)
    start = F.col("before") + F.coalesce("inner_start", F.lit(0))
    found = (rows.withColumn("inner_start", F.sum("size").over(inside))
             .join(sums.select("nth", "bucket", "before"), ["nth", "bucket"]).withColumn("start", start))
    goal = F.floor(F.col("target") + 1e-6)
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0))
    part = goal - whole * F.col("source_size")
    taken = F.col("size") * whole + F.greatest(F.lit(0), F.least(F.col("size"), part - F.col("start")))
    return found.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(["row"] if carry else []))


def repeat(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each row, whole, as often as it is taken.

    A document that ``mix`` takes in part (one of a source at most) is in with that copy if at least half of it is
    taken, else without, so a source's words miss its target by half a document at most.  A row without
    words adds none and stays once.  Repeated rows, rows without an id and columns of any name are kept as they are.
    """
    mixed = mix(docs, text_col=text_col, carry=True, **options)
    whole = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))                 # taken / size, halves up
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(whole).cast("int")
    each = mixed.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*[F.col("row")[c].alias(c) for c in docs.columns])
