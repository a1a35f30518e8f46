"""Repeated 50-byte strings against a dictionary of all of them."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapledger.llm import suffix_dedup

LAST = 2**63 - 1


def brute(rows, w=50):
    first = {}
    for i, t in rows:
        b, k = (t or "").encode(), LAST if i is None else i
        for j in range(len(b) - w + 1):
            first[b[j:j + w]] = min(k, first.get(b[j:j + w], LAST))
    out = []
    for i, t in rows:
        b, k = (t or "").encode(), LAST if i is None else i
        gone = bytearray(len(b))
        for j in range(len(b) - w + 1):
            if first[b[j:j + w]] < k:
                gone[j:j + w] = b"\1" * w
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(1)
    base = ["".join(rnd.choice("ab cdé") for _ in range(300)) for _ in range(6)]
    rows = []
    for i in range(60):
        t = "".join(rnd.choice("abcdef ") for _ in range(rnd.randrange(200)))
        for _ in range(rnd.randrange(3)):
            a = rnd.randrange(200)
            t += rnd.choice(base)[a:a + rnd.randrange(30, 120)] + "".join(rnd.choice("abcdef ") for _ in range(rnd.randrange(40)))
        rows.append((i, t))
    rows += [(None, base[0]), (None, base[1]), (3, base[0]), (100, None), (101, ""), (102, "a" * 400), (103, "a" * 70), (104, "ab" * 60)]
    return rows + [(200 + i, base[2] + str(i) * 60) for i in range(10)] + [(300, "long " * 60_000), (301, "long " * 100)]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 500, "part_bytes": 900}, {"block_bytes": 500, "part_bytes": 900, "hot_blocks": 3}])
def test_against_dictionary(spark, options):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string").repartition(5)
    got = suffix_dedup.cut_repeats(df, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_other_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "é" * 40, 1.5, None), (2, "é" * 40 + "tail", None, "s")], "doc_id long, text string, n double, rest string")
    out = {r["doc_id"]: r for r in suffix_dedup.cut_repeats(df, as_text=True).collect()}
    assert out[2]["kept"] == "tail" and '"rest":"s"' in out[2]["rest"] and out[1]["n_removed"] == 0
    assert suffix_dedup.cut_repeats(df.where("false")).count() == 0


def test_column_wise_classes():
    rnd = np.random.default_rng(2)
    mat = rnd.integers(97, 99, (200, 12)).astype(np.uint8)
    first, last = rnd.integers(0, 4, 200), rnd.integers(8, 12, 200)
    ids = rnd.integers(0, 50, 200)
    got = suffix_dedup.column_wise(mat, first, last, ids, 6)
    for i in range(200):
        for c in range(7):
            there = first[i] <= c and c + 5 <= last[i]
            want = there and any(first[j] <= c and c + 5 <= last[j] and ids[j] < ids[i] and (mat[j, c:c + 6] == mat[i, c:c + 6]).all()
                                 for j in range(200))
            assert bool(got[i] >> c & 1) == bool(want)
