"""Approximate nearest neighbours with randomly rotated one-bit codes.

Vectors are taken relative to their mean, normalised and rotated by one random orthogonal matrix; the
code keeps the sign of every coordinate.  Stored per vector: the packed bits, its distance to the
mean, and the correction <code, vector> that makes <code, query> / <code, vector> an unbiased
estimate of the inner product.  The error of that estimate is at most
eps * sqrt((1 - c^2) / (c^2 (D - 1))) but with a probability falling exponentially in eps^2, which
turns estimates into lower and upper bounds of distances.

Search: (1) per query the k smallest upper bounds of different ids give a cutoff; (2) every vector whose lower bound
is within the cutoff is reranked by its exact distance.  All rows are indexed and scanned as codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import materialise
from snapledger.llm.vectors import CHUNK, QUERY_BLOCK, best, grid, ids_of, pack, ranked, unpack, usable

EPS = 2.5
SEED = 11


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance to the mean, and <code, vector> of each row."""
    d = v - mean
    norm = np.linalg.norm(d, axis=1)
    o = (d / np.where(norm > 0, norm, 1)[:, None]) @ turn
    bits = o > 0
    fit = np.abs(o).sum(axis=1) / np.sqrt(v.shape[1])
    return np.packbits(bits, axis=1), norm, np.where(norm > 0, fit, 1.0)


def bounds(codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, q: np.ndarray, mean: np.ndarray, turn: np.ndarray,
           eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances (queries x codes)."""
    dim = q.shape[1]
    d = q - mean
    q_norm = np.linalg.norm(d, axis=1)
    u = (d / np.where(q_norm > 0, q_norm, 1)[:, None]) @ turn
    # <code, u> = (2 * sum of u over the set bits - sum of u) / sqrt(D)
    bits = np.unpackbits(codes, axis=1, count=dim).astype(np.float32)
    inner = (2 * (u.astype(np.float32) @ bits.T) - u.sum(axis=1, dtype=np.float32)[:, None]) / np.sqrt(dim)
    estimate = inner / fit
    slack = eps * np.sqrt(np.maximum(0, 1 - fit ** 2) / (fit ** 2 * max(1, dim - 1))) + 1e-5
    base = norm[None, :] ** 2 + q_norm[:, None] ** 2
    reach = 2 * q_norm[:, None] * norm[None, :]
    return base - reach * (estimate + slack), base - reach * (estimate - slack)


def nearest(rows: DataFrame, query: str, k: int = 10, eps: float = EPS, id_col: str = "vec_id", vec_col: str = "embedding",
            chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): per query the k nearest other rows found, by Euclidean distance.

    ``query`` is an SQL condition on ``id``; ``score`` is the exact distance on the original vectors;
    ties go to the smaller id.  Null vectors, empty ones, zero ones and ones with null or non-finite
    components take no part; vectors of different length aren't compared.  A query's own row is every
    row with its id.  Rows of one id at the same distance are one neighbour, however often they come; an
    id with rows at several distances is one per distance.
    """
    good = usable(rows, id_col, vec_col, zero=True)
    chunks = materialise(pack(good, chunk), "vectors")
    blocks = materialise(pack(good.where(query), query_block), "queries")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                yield pd.DataFrame({"dim": [r.dim], "n": [r.n], "s": [unpack(r.ids, r.vectors, r.dim)[1].sum(axis=0)]})

    total = chunks.mapInPandas(sums, "dim int, n long, s array<double>").select("dim", "n", F.posexplode("s").alias("at", "x"))
    mean = (total.groupBy("dim", "at").agg((F.sum("x") / F.sum("n")).alias("x"))
            .groupBy("dim").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("mean")))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                codes, norm, fit = encode(unpack(r.ids, r.vectors, r.dim)[1], np.asarray(r.mean), rotation(r.dim))
                yield pd.DataFrame({"dim": [r.dim], "block": [r.block], "codes": [codes.tobytes()], "norm": [norm.tobytes()],
                                    "fit": [fit.tobytes()]})

    mean = materialise(mean, "mean")
    coded = materialise(chunks.join(mean, "dim").mapInPandas(index, "dim int, block long, codes binary, norm binary, fit binary"), "codes")
    asked = blocks.join(mean, "dim")

    def within(r):
        codes = np.frombuffer(r.codes, dtype=np.uint8).reshape(-1, (r.dim + 7) // 8)
        q_ids, q = unpack(r.q_ids, r.q_vectors, r.dim)
        low, high = bounds(codes, np.frombuffer(r.norm), np.frombuffer(r.fit), q, np.asarray(r.q_mean), rotation(r.dim), eps)
        return q_ids, q, low, high

    def cutoffs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                q_ids, _, _, high = within(r)
                ids = np.frombuffer(r.ids, dtype=np.int64)
                order = np.argsort(ids, kind="stable")
                ids, first = np.unique(ids[order], return_index=True)
                high = np.minimum.reduceat(high[:, order], first, axis=1)     # an id's smallest bound
                high[q_ids[:, None] == ids[None, :]] = np.inf
                near = np.argpartition(high, min(k, len(ids)) - 1, axis=1)[:, :k]
                upper = np.take_along_axis(high, near, axis=1).ravel()
                there = upper < np.inf
                yield pd.DataFrame({"query_id": np.repeat(q_ids, near.shape[1])[there], "vec_id": ids[near.ravel()][there],
                                    "upper": upper[there]})

    codes_only = grid(chunks.select("dim", "block", "ids").join(coded, ["dim", "block"]), asked)
    upper = codes_only.mapInPandas(cutoffs, "query_id long, vec_id long, upper double").groupBy("query_id", "vec_id").agg(
        F.min("upper").alias("upper"))
    kth = best(upper, "query_id", k, F.asc("upper")).where(F.col("rank") == k).select("query_id", "upper")
    cut = materialise(ids_of(blocks).join(kth, "query_id").groupBy("dim", "q_block").agg(
        F.map_from_entries(F.collect_list(F.struct("query_id", "upper"))).alias("cut")), "cutoffs")

    def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                q_ids, q, low, _ = within(r)
                ids, v = unpack(r.ids, r.vectors, r.dim)
                cut = dict(r.cut) if r.cut is not None else {}
                out = []
                for i, own in enumerate(q_ids):
                    at = np.flatnonzero((low[i] <= cut.get(own, np.inf)) & (ids != own))
                    if len(at):
                        dist = np.sqrt(((v[at] - q[i]) ** 2).sum(axis=1))
                        pick = ranked(-dist, ids[at], k)
                        out += zip([own] * len(pick), ids[at[pick]], dist[pick])
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    cells = grid(chunks.join(coded, ["dim", "block"]), asked).join(cut, ["dim", "q_block"], "left")
    found = cells.mapInPandas(rerank, "query_id long, vec_id long, score double").distinct()
    return best(found, "query_id", k, F.asc("score"), F.asc("vec_id")).select("query_id", "rank", "vec_id", "score")
