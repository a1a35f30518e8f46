"""MinHash near-duplicates against comparing all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from snapledger.llm import minhash
from snapledger.llm.common import lower_words, shingle_set, word_hashes


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = lower_words(t)
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randrange(20, 90))]
        for _ in range(rnd.randrange(1, 9)):                  # chains of edits: far ends are unlike
            rows.append((rnd.randrange(10**6), " ".join(base)))
            for _ in range(rnd.randrange(1, 4)):
                base[rnd.randrange(len(base))] = rnd.choice(words)
    passage = " ".join(rnd.choice(words) for _ in range(30))
    rows += [(2_000_000 + i, passage + " " + " ".join(rnd.choice(words) for _ in range(25))) for i in range(40)]
    rows += [(3_000_000, None), (3_000_001, ""), (3_000_002, " \t\n"), (3_000_003, "One"), (3_000_004, "oNE"), (3_000_005, "é É"),
             (3_000_006, "a b"), (3_000_007, "A B"), (3_000_008, "x " * 30_000), (3_000_009, "x " * 29_999 + "y")]
    return rows


@pytest.mark.parametrize("n,percent", [(2, 80), (5, 80), (2, 50)])
def test_against_all_pairs(spark, n, percent):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    bands = {"bands": 90, "rows": 3} if percent < 80 else {}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df, n, percent, **bands).collect()}
    assert got == brute(rows, n, percent)


def test_odd_rows(spark):
    long = " ".join(str(i) for i in range(50))
    rows = [(5, long, 1), (5, long, 2), (2, long, 3), (None, long, 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")        # a clashing column
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, False), (5, 2, False), (2, 2, True), (None, None, True), (None, None, True)], key=str)
    empty = minhash.near_duplicates(df.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_words_and_signature():
    assert len(word_hashes("a\x0bb c d")) == 3                     # only the six blanks of ASCII split
    assert (word_hashes("Ab") == word_hashes("aB")).all()
    assert (word_hashes("É") != word_hashes("é")).all()
    probes = minhash._probe_order(64)
    one = minhash.signature(shingle_set("only", 2), 64, probes)
    assert len(set(one.tolist())) == 1                                  # densified from a single bin
    a = shingle_set(" ".join(map(str, range(1000))), 2)
    b = shingle_set(" ".join(map(str, range(100, 1000))), 2)
    same = np.mean(minhash.signature(a, 512, minhash._probe_order(512)) == minhash.signature(b, 512, minhash._probe_order(512)))
    assert abs(same - 0.9) < 0.06


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(500, 400), (450, 500)]
    got = {r["doc"]: r["label"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(300)}, 400: 400, 450: 400, 500: 400}


def test_loose_members_ask_whole_components(spark):
    """Links that no star makes are found by asking components, in chunks of any size; unlike documents stay apart."""
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    texts = {}
    for i in range(120):                                                # edits of different strength: most pairs are below the bound
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        texts[i] = " ".join(w)
    rows = list(texts.items())
    want = {i: c for i, (_, c, _) in brute(rows, 2, 80).items()}
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, doc string, n int").repartition(5)
    old = minhash.CHUNK
    for chunk in (100, old):
        minhash.CHUNK = chunk
        try:
            got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, 2, 80).collect()}
        finally:
            minhash.CHUNK = old
        assert got == want
    sets = minhash._sets(df.select(df["doc_id"].alias("doc"), df["text"].alias("t")), 2)
    n = {i: len(shingle_set(t, 2)) for i, t in rows}
    asks = spark.createDataFrame([(i, n[i], 7) for i in range(100, 120)], "doc long, n long, component long")
    members = spark.createDataFrame([(i, n[i], 7) for i in range(100)], "doc long, n long, component long")
    linked = {r["a"] for r in minhash.settle(asks, members, sets, 80).collect()}
    alike = lambda a, b: len(set(a) & set(b)) * 100 >= 80 * len(set(a) | set(b))
    plain = {i: shingle_set(t, 2).tolist() for i, t in rows}
    assert linked == {i for i in range(100, 120) if any(alike(plain[i], plain[j]) for j in range(100))}
