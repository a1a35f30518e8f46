"""Packing invariants and bounds, mixing against a plain water-filling."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from snapledger.llm import mixing, packing
from snapledger.plans.tables import table
from tools.oracle_check import compare

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_tokens_equal_whole_texts():
    texts = ["Hello, World!  it's 12345\n\tdon't  stop", "", None, " ", "naïve café é ΟΔΟΣ", "a<|endoftext|>b <|startoftext|> c",
             "x y z\x0bq\x85r", "word" * 400, "你好 мир 😀😀", "'s 's's \r\n end", "e ́ x"]
    rnd = random.Random(2)
    texts += ["".join(rnd.choice("abcXYZéÉßñÀÿ.,!?-_#&*|\"()/'1٣ſİıﬁ\u0301\u00ad<> \n") for _ in range(40)) for _ in range(400)]
    texts += [" ".join(rnd.choice(["the", "The", "THE,", "nation.", "Ärger!!", "être", "don't", "it's.", "a-b", "--", "x|y", "|", "é?!"]) for _ in range(60))]
    words = packing.WordTokens(PATH)
    whole = [[] if t is None else words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):                                                  # the second time from the tables
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in words.ids(texts)] == whole


def test_plan_is_complete_and_tight():
    rnd = random.Random(5)
    for case in range(6):
        lengths = [rnd.choice([rnd.randrange(1, 101), 51, 60, 34]) for _ in range(rnd.randrange(1, 400))]
        first = packing.best_fit(Counter(lengths), 100)
        bins = packing.local_search(first, 100)
        assert Counter(x for p, n in bins.items() for x in p for _ in range(n)) == Counter(lengths)
        assert all(0 < sum(p) <= 100 for p in bins)
        assert sum(bins.values()) <= sum(first.values())
    # local search empties a bin that best-fit decreasing can't
    bins = packing.local_search(Counter({(6, 3): 1, (5, 2, 2): 1, (2,): 1}), 10)
    assert sum(bins.values()) == 2


def test_pack(spark):
    rows = [(i, "word " * (i % 7 * 300)) for i in range(60)] + [(1, "word"), (1, "word"), (None, None), (None, "a b"), (99, "tok " * 9000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, piece int").repartition(4)
    got = packing.pack(packing.pieces(df, PATH)).collect()
    tok = packing.WordTokens(PATH).tokenizer
    want = Counter()
    for i, t in rows:
        ids = (tok.encode(t, add_special_tokens=False).ids if t else []) + [0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            x = np.array(ids[a:a + 2048], dtype="<u4")
            want[(i, k, a, len(x), zlib.crc32(x.tobytes()))] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    seq = defaultdict(list)
    for r in got:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    bins = []                                                           # first-fit decreasing
    for n in sorted((r["length"] for r in got), reverse=True):
        at = next((k for k, room in enumerate(bins) if room >= n), None)
        if at is None:
            bins.append(2048 - n)
        else:
            bins[at] -= n
    assert len(seq) <= len(bins)
    assert packing.pack(packing.pieces(df.where("false"), PATH)).count() == 0


def fill(sizes, cap):
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, fixed = sum(sizes.values()), {s: 0.0 for s, n in sizes.items() if n == 0}
    while True:
        free = [s for s in sizes if s not in fixed]
        share = (total - sum(fixed.values())) / max(1e-9, sum(weights[s] for s in free))
        over = [s for s in free if share * weights[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: share * weights[s] for s in free}}
        fixed.update({s: cap * sizes[s] for s in over})


def test_mix(spark):
    rnd = random.Random(9)
    rows = [(i, " ".join("w" * rnd.randrange(1, 40)), rnd.choice(["a", "B", "ü", "zz", None] + ["big"] * 15)) for i in range(900)]
    rows += [(5000, None, "a"), (5001, "  ", "none"), (None, "x y", "a"), (7, "q", "a"), (7, "q", "a"), (6000, "long " * 5000, "zz")]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, target int").repartition(6)
    got = mixing.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    sizes = Counter({s: 0 for _, _, s in rows})
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = fill(sizes, 3)
    taken = Counter()
    for r in mixing.mix(df, carry=True).collect():
        s = r["row"]["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert len(got) >= len(rows) - 1
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = mixing.mix(df.repartition(3)).select("doc_id", "size", "taken")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, mixing.mix(df).select("doc_id", "size", "taken").collect()))
    out = mixing.repeat(df)
    assert out.columns == df.columns
    words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("n")).collect()}
    largest = {s: max(len((t or "").split()) for _, t, x in rows if x == s) for s in sizes}
    assert all(abs(words.get(s, 0) - taken[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert {(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()} <= {r[:2] for r in rows}     # whole texts
    assert out.where("doc_id in (5000, 5001)").count() == 2                 # texts without words stay, once
    assert mixing.mix(df.where("false")).count() == 0 and mixing.repeat(df.where("false")).count() == 0


def test_sql_oracles(spark):
    for key, result in compare(spark, "/root/testdata/sf0.001", ["op3_mixing", "op4_warc", "op5_topk"]).items():
        assert result[0] == "match", (key, result)


def test_pieces_of_given_documents(spark):
    n = table(spark, "/root/testdata/sf0.001", "documents")
    got = packing.pack(packing.pieces(n, PATH))
    assert got.select("doc_id").distinct().count() == n.count()
    total = got.agg(F.sum("length")).first()[0]
    assert got.select("sequence_id").distinct().count() <= -(-total // 2048) + 1
