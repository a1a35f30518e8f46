"""Exact top-k search by inner product: the three-phase uniform threshold method.

Components are dealt into ``m`` groups, the lists of the method: a vector's local score in a group is
its part of the inner product, its score the sum of its local scores.

1. Every list sends, per query, its k best local scores, with the whole score of those vectors.  The
   k-th best whole score seen is a safe cutoff t: the true k-th best is at least that.
2. The cutoffs go to all tasks.  A vector that reaches t has a local score of at least t / m in some
   list (if all were smaller, so would be the sum), so each list collects all entries from t / m on.
3. The missing local scores of those entries are resolved and their sums ranked, exactly.

Scores are integers; negative ones need no special care.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import materialise
from snapledger.llm.vectors import CHUNK, QUERY_BLOCK, best, grid, ids_of, pack, ranked, unpack, usable

LISTS = 2


def _local(c: np.ndarray, q: np.ndarray, lists: int) -> list[np.ndarray]:
    """Local scores per list (queries x candidates), exact: in doubles while sums fit 2^53, else in integers."""
    top = max(np.abs(c).max(), 1.0) * max(np.abs(q).max(), 1.0) * c.shape[1]
    parts = np.array_split(np.arange(c.shape[1]), min(lists, c.shape[1]))
    if top < 2.0 ** 53:
        return [(q[:, p] @ c[:, p].T).astype(np.int64) for p in parts]
    whole_c, whole_q = c.astype(np.int64), q.astype(np.int64)
    return [whole_q[:, p] @ whole_c[:, p].T for p in parts]


def top_k(rows: DataFrame, query: str, k: int = 5, scale: float = 256.0, lists: int = LISTS, id_col: str = "vec_id",
          vec_col: str = "embedding", chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): per query the k other rows of largest inner product.

    Components become floor(scale * x).  ``query`` is an SQL condition on ``id``.  Ties go to the
    smaller id.  Fewer candidates than k: all of them.  Null vectors, empty ones and ones with null
    or non-finite components take no part; vectors of different length aren't compared.  A query's
    own row is every row with its id (repeated rows too).  Rows of one id that score the same are one
    neighbour, however often they come; an id whose rows score differently is one per score.
    """
    ints = usable(rows, id_col, vec_col).select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    chunks = materialise(pack(ints, chunk), "vectors")
    blocks = materialise(pack(ints.where(query), query_block), "queries")
    cells = grid(chunks, blocks)

    def lists_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids, c = unpack(r.ids, r.vectors, r.dim)
                q_ids, q = unpack(r.q_ids, r.q_vectors, r.dim)
                local = _local(c, q, lists)
                out = []
                for i, own in enumerate(q_ids):
                    other = np.flatnonzero(ids != own)
                    if len(other):
                        seen = np.unique(np.concatenate([other[ranked(x[i, other], ids[other], k)] for x in local]))
                        out += [(own, ids[j], sum(x[i, j] for x in local)) for j in seen]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    sent = cells.mapInPandas(lists_of, "query_id long, vec_id long, score long").distinct()
    kth = best(sent, "query_id", k, F.desc("score"), F.asc("vec_id")).where(F.col("rank") == k).select("query_id", "score")
    cut = materialise(ids_of(blocks).join(kth, "query_id").groupBy("dim", "q_block").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("cut")), "cutoffs")

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                ids, c = unpack(r.ids, r.vectors, r.dim)
                q_ids, q = unpack(r.q_ids, r.q_vectors, r.dim)
                cut = dict(r.cut) if r.cut is not None else {}
                local = _local(c, q, lists)
                out = []
                for i, own in enumerate(q_ids):
                    t = cut.get(own)
                    enough = np.ones(len(ids), dtype=bool)
                    if t is not None:
                        enough = np.zeros(len(ids), dtype=bool)
                        for x in local:
                            enough |= x[i] * len(local) >= t
                    at = np.flatnonzero(enough & (ids != own))
                    score = sum(x[i, at] for x in local)              # resolves what the other lists hold
                    if t is not None:
                        at, score = at[score >= t], score[score >= t]
                    pick = ranked(score, ids[at], k) if len(at) else at
                    out += zip([own] * len(pick), ids[at[pick]], score[pick])
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    cut = cut.select("dim", "q_block", "cut")
    found = cells.join(cut, ["dim", "q_block"], "left").mapInPandas(collect, "query_id long, vec_id long, score long").distinct()
    return best(found, "query_id", k, F.desc("score"), F.asc("vec_id")).select("query_id", "rank", "vec_id", "score")
