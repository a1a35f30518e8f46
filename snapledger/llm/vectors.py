"""What the two vector searches share: clean rows, chunks of vectors, and the query x chunk grid.

A search compares a stated query set with all rows in blocks: queries form rows of up to
``query_block`` vectors, candidates rows of up to ``chunk`` vectors, and one task handles one pair of
blocks.  Nothing is broadcast and no pair of rows is ever a row of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, QUERY_BLOCK = 4096, 1024
CELLS = 4
PACKED = "dim int, block long, n int, ids binary, vectors binary"


def usable(rows: DataFrame, id_col: str, vec_col: str, zero: bool = False) -> DataFrame:
    """(id, v): rows whose vector is there, not empty, and holds finite numbers only (with ``zero``: not only zeros)."""
    v = F.col(vec_col).cast("array<double>")
    ok = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    if zero:
        ok = ok & F.exists(v, lambda x: x != 0)
    return rows.where(ok).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def pack(rows: DataFrame, most: int) -> DataFrame:
    """Vectors of one length packed into rows of at most ``most``; a row is never split."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def row(dim):
            nonlocal serial
            ids, vs = zip(*held.pop(dim))
            serial += 1
            return pd.DataFrame({"dim": [dim], "block": [serial], "n": [len(ids)], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                                 "vectors": [np.concatenate(vs).tobytes()]})

        for b in batches:
            for i, v in zip(b["id"].tolist(), b["v"]):
                held.setdefault(len(v), []).append((i, np.asarray(v, dtype=np.float64)))
                if len(held[len(v)]) >= most:
                    yield row(len(v))
        for dim in list(held):
            yield row(dim)

    return rows.mapInPandas(run, PACKED)


def grid(chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Every chunk beside every query block of the same vector length (columns q_*).

    Cells are dealt by query block and a salt of the chunk, so a task gets about ``CELLS`` chunks
    however many vectors there are.  What is broadcast is one number per query block, that is per
    ``QUERY_BLOCK`` queries.
    """
    salts = max(1, -(-chunks.count() // CELLS))
    q = queries.select("dim", *[F.col(c).alias(f"q_{c}") for c in queries.columns if c != "dim"])
    there = F.broadcast(q.groupBy("dim").agg(F.collect_list("q_block").alias("q_blocks")))
    cells = (chunks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts))).join(there, "dim")
             .withColumn("q_block", F.explode("q_blocks")).drop("q_blocks"))
    q = q.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return cells.join(q, ["dim", "q_block", "salt"]).drop("salt")


def unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, dtype=np.int64), np.frombuffer(vectors, dtype=np.float64).reshape(-1, dim)


def ids_of(blocks: DataFrame) -> DataFrame:
    """(query_id, dim, q_block): which ids each packed row holds, once each."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                yield pd.DataFrame({"query_id": np.unique(np.frombuffer(r.ids, dtype=np.int64)), "dim": r.dim, "q_block": r.block})

    return blocks.select("dim", "block", "ids").mapInPandas(run, "query_id long, dim int, q_block long")


def ranked(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score down, id up (all ties at the border are looked at); equal (score, id) count once."""
    most = k
    while True:
        at = np.arange(len(score))
        if len(score) > most:
            at = np.flatnonzero(score >= np.partition(score, len(score) - most)[len(score) - most])
        at = at[np.lexsort((ids[at], -score[at]))]
        at = at[np.append(True, (np.diff(score[at]) != 0) | (np.diff(ids[at]) != 0))[: len(at)]]
        if len(at) >= k or most >= len(score):
            return at[:k]
        most *= 8


def best(rows: DataFrame, query: str, k: int, *order: Column) -> DataFrame:
    """The first k rows of each query, with their rank from 1."""
    from pyspark.sql import Window

    w = Window.partitionBy(query).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
