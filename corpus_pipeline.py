"""A corpus pipeline over documents: each stage is one operator of ``snapledger.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents.  All stages but the last return the columns of ``documents``.  Every
stage works on all rows that its predecessor kept; null texts count as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import minhash, mixing, packing, suffix_dedup, toxicity
from snapledger.llm.common import materialise
from snapledger.plans.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field, learnt from this table's labels, does not reject.

    Null and empty texts stay; rows are judged one by one, so repeated rows and rows without an id stay or go by their text.
    """
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies (5-word shingles, 0.8 or more).

    Of several rows of an id one stays, the first by a hash of its text and then of all its columns; rows without an id
    can't be named as copies and stay.  Null and empty texts are copies of nothing.
    """
    found = minhash.near_duplicates(docs, words=5, percent=80)
    keep = found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    there = docs.where("doc_id is not null").join(keep, F.col("doc_id") == F.col("_kept"), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = there.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(row, F.struct(F.xxhash64("text"), F.xxhash64(row))).alias("_row"))
    one = first.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
    return one.unionByName(docs.where("doc_id is null").select(*docs.columns))


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 50-byte strings that a document with a smaller id has."""
    rest = [f for f in docs.schema if f.name not in ("doc_id", "text")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    cut = suffix_dedup.cut_repeats(docs, as_text=True).withColumn("row", F.from_json("rest", kinds) if rest else F.lit(None))
    columns = {f.name: F.col("row")[f.name] for f in rest} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources weighing 1, 2, 3 in turn: whole documents, as often as they are taken (see ``mixing.repeat``)."""
    out = mixing.repeat(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids: one row per piece of a document; a null or empty text is its end alone."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", drop_toxic), ("near_dedup", near_dedup), ("suffix_array_dedup", cut_passages),
          ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]

# No stage but the mixing can be told in SQL; tests hold the pipeline against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
