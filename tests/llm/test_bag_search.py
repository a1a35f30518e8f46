"""Ranked search against the plain formula over all documents."""

import math
import random
import re
from collections import Counter

from snapledger.llm import bag_search
from tools.oracle_check import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t, *_ in docs]
    bags = [(i, b) for i, b in bags if b]
    total, df = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    out = []
    for item, text, *_ in items:
        asked = Counter(terms(text))
        found = []
        for i, b in bags:
            m = 100 - 25 + (25 * sum(b.values()) * len(bags)) // total
            s = sum(n * math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m))
                    for t, n in asked.items() if t in b)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def given():
    rnd = random.Random(6)
    pool = [f"w{int(rnd.paretovariate(0.8)) % 400}" for _ in range(300)] + ["Übung", "ÜBUNG", "naïve", "x_1", "İ"]
    docs = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 60)))) for i in range(500)]
    docs += [(1000 + i, docs[i % 3][1].upper() + " elsewhere") for i in range(150)]        # classes larger than the report
    docs += [(2000 + i, " ".join(sorted(docs[5][1].split()))) for i in range(30)]
    docs += [(None, docs[0][1]), (None, None), (9000, None), (9001, " \n.,"), (7, "w1"), (7, "w1"), (7, "w2 w2"), (9002, "w1 " * 40000)]
    items = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 30)))) for i in range(40)]
    items += [(50, None), (51, "..."), (52, "nowhere"), (None, "w1 W1 w2"), (53, "w1 " * 3000), (54, "w2"), (54, "w2")]
    return [(*d, 1, "c") for d in docs], [(*i, 2) for i in items]


def test_against_the_formula(spark):
    docs, items = given()
    a = spark.createDataFrame(docs, "doc_id long, text string, score int, vec string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    want = brute(docs, items, 20)
    for block in (bag_search.BLOCK_BYTES, 2000):                       # all items at once, and in blocks
        got = bag_search.search(a, b, block_bytes=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert bag_search.search(a.where("false"), b).count() == 0
    assert bag_search.search(a, b.where("false")).count() == 0


def test_classes_share_vectors_and_norms(spark):
    docs = [(1, "a b a z"), (2, "a a b q"), (3, "b a a other thing here"), (4, "a b"), (5, "b a"), (6, "none")]
    shared = spark.sparkContext.broadcast({b"a": 0, b"b": 1})
    held = bag_search.vectors(spark.createDataFrame(docs, "doc_id long, text string"), shared, "doc_id", "text")
    got = bag_search.classes(held.where("length(vec) > 0").withColumn("m", held["n"]), 20).collect()
    by = {}
    for r in got:
        by.setdefault(r["rep"], []).append((r["nth"], r["doc_id"], r["vec"] is not None))
    assert sorted(sorted(x) for x in by.values()) == [[(1, 1, True), (2, 2, False)], [(1, 3, True)], [(1, 4, True), (2, 5, False)]]


def test_sums_beyond_doubles_stay_exact(spark):
    docs = [(i, "a " * (i + 1)) for i in range(3)] + [(9, "other")]
    items = [(1, "a " * 400_000)]
    a = spark.createDataFrame(docs, "doc_id long, text string")
    got = bag_search.search(a, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, 20)


def test_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", ["op12_bag_search"])["op12_bag_search"][0] == "match"
