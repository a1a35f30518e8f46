"""Both vector searches against comparing everything."""

import numpy as np
import pytest

from snapledger.llm import rabitq, topk
from snapledger.plans.tables import table

SCHEMA = "vec_id long, embedding array<float>, rank string"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in vectors], SCHEMA)


def odd():
    rnd = np.random.default_rng(4)
    v = [(i, rnd.standard_normal(16)) for i in range(300)]
    v += [(300 + i, v[7][1]) for i in range(60)]                          # ties
    v += [(1000, None), (1001, [None] * 16), (1002, [np.nan] + [1.0] * 15), (1003, [np.inf] + [1.0] * 15), (1004, []),
          (1005, [1.0, 2.0]), (1050, [3.0, -2.0]), (1100, [0.0] * 16)]
    return v + [(50, v[50][1])]                                           # a repeated row


def clean(vectors, zero):
    return [(i, np.asarray(v, dtype=np.float32).astype(float)) for i, v in vectors
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and (zero or np.any(np.asarray(v) != 0))]


def brute_top(vectors, k, every):
    good = {}
    for i, v in clean(vectors, True):
        good[i] = np.floor(256 * v).astype(int)
    out = []
    for q in sorted(i for i in good if i % every == 0):
        s = sorted((-int(good[q] @ c), i) for i, c in good.items() if i != q and len(c) == len(good[q]))[:k]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return out


@pytest.mark.parametrize("chunk,query_block", [(4096, 1024), (37, 3)])
def test_exact_top_k(spark, chunk, query_block):
    got = topk.top_k(rows_of(spark, odd()).repartition(3), "id % 50 = 0", 5, chunk=chunk, query_block=query_block)
    assert sorted(map(tuple, got.collect())) == brute_top(odd(), 5, 50)


def test_few_candidates_and_large_numbers(spark):
    v = [(0, [1e15, 1.0]), (1, [1e3, 3.0]), (2, [-2.0, 5.0])]
    want = brute_top(v, 5, 50)
    assert [tuple(r) for r in topk.top_k(rows_of(spark, v), "id % 50 = 0", 5).orderBy("rank").collect()] == want
    assert topk.top_k(rows_of(spark, v).where("false"), "id % 50 = 0").count() == 0


def test_nearest(spark):
    got = sorted(map(tuple, rabitq.nearest(rows_of(spark, odd()).repartition(3), "id % 50 = 0", 10, chunk=64, query_block=3).collect()))
    good = dict(clean(odd(), False))
    hits = total = 0
    for q in sorted(i for i in good if i % 50 == 0):
        want = sorted((float(np.sqrt(((good[q] - c) ** 2).sum())), i) for i, c in good.items() if i != q and len(c) == len(good[q]))[:10]
        mine = [r for r in got if r[0] == q]
        assert [r[1] for r in mine] == list(range(1, len(want) + 1))
        assert [(r[3], r[2]) for r in mine] == sorted((r[3], r[2]) for r in mine)
        for _, _, i, s in mine:
            assert abs(s - np.sqrt(((good[q] - good[i]) ** 2).sum())) < 1e-12
        hits += len({i for _, i in want} & {r[2] for r in mine})
        total += len(want)
    assert hits >= 0.95 * total
    assert rabitq.nearest(rows_of(spark, odd()).where("false"), "id % 50 = 0").count() == 0


def repeated():
    """Ids held by more than k rows, near the queries; queries held by many rows; ids and queries with two vectors."""
    v = odd()
    near = [(2001, 2 * v[50][1]), (2002, 1.001 * v[50][1]), (0, v[0][1]), (2003, v[100][1] + 0.001)]
    return v + near * 40 + [(100, v[3][1]), (4, v[5][1]), (4, v[50][1]), (2002, v[100][1])]


def brute_rows(vectors, k, every, zero, score):
    """The k best different (score, id) over all rows of a query's id."""
    good, out = clean(vectors, zero), []
    for q in sorted({i for i, _ in good if i % every == 0}):
        seen = {(score(a, c), i) for j, a in good if j == q for i, c in good if i != q and len(c) == len(a)}
        out += [(q, r + 1, i, x) for r, (x, i) in enumerate(sorted(seen)[:k])]
    return out


@pytest.mark.parametrize("chunk,query_block", [(4096, 1024), (64, 3), (2, 1)])
def test_repeated_rows(spark, chunk, query_block):
    v = repeated() if chunk > 2 else repeated()[:120] + repeated()[-164:]
    rows = rows_of(spark, v).repartition(3)
    got = topk.top_k(rows, "id % 50 = 0", 5, chunk=chunk, query_block=query_block)
    want = brute_rows(v, 5, 50, True, lambda a, c: -int(np.floor(256 * a).astype(int) @ np.floor(256 * c).astype(int)))
    assert sorted(map(tuple, got.collect())) == [(q, r, i, -x) for q, r, i, x in want]
    got = rabitq.nearest(rows, "id % 50 = 0", 5, eps=50.0, chunk=chunk, query_block=query_block)
    want = brute_rows(v, 5, 50, False, lambda a, c: float(np.sqrt(((c - a) ** 2).sum())))
    got = sorted(map(tuple, got.collect()))
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)


def test_recall_on_given_vectors(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = {}
    for r in rabitq.nearest(rows, "id % 100 = 0").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    v = {r["vec_id"]: np.array(r["embedding"]) for r in rows.collect()}
    ids = np.array(sorted(v))
    mat = np.stack([v[i] for i in ids])
    hits = 0
    for q in got:
        d = ((mat - v[q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits += len(set(ids[np.argsort(d, kind="stable")[:10]]) & got[q])
    assert hits >= 0.9 * 10 * len(got)


def test_bounds_hold():
    rnd = np.random.default_rng(0)
    v, q = rnd.standard_normal((2000, 64)), rnd.standard_normal((20, 64))
    mean, turn = v.mean(axis=0), rabitq.rotation(64)
    low, high = rabitq.bounds(*rabitq.encode(v, mean, turn), q, mean, turn, rabitq.EPS)
    real = ((q[:, None] - v[None]) ** 2).sum(axis=2)
    assert ((low <= real) & (real <= high)).mean() > 0.97
    assert (low <= real).mean() > 0.98 and np.mean(high - low) < 2 * real.mean()
