"""The random field against enumeration, and held-out accuracy."""

import math
from itertools import product

from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapledger.llm import toxicity as tox
from snapledger.plans.tables import table


def by_hand(crf, words):
    move = crf.matrix()
    total, toxic = 0.0, [0.0] * len(words)
    for tags in product((0, 1), repeat=len(words)):
        w, before = 1.0, 0
        for word, tag in zip(words, tags):
            w *= move[before][tag]
            if tag:
                w *= math.exp(crf.bias + (crf.emission(word) or 0.0))
            before = tag
        total += w
        for k, tag in enumerate(tags):
            toxic[k] += w * tag
    return [x / total for x in toxic]


def test_marginals():
    crf = tox.Field({"=bad": 3.0, "awfu*": 2.0, "=awful": 1.0}, -2.0, (-0.7, 0.3, 0.9))
    words = "a bad day with awful awfulness and no bad x".split()
    at = [k for k, w in enumerate(words) if crf.emission(w) is not None]
    got = tox.Chain(crf).marginals(at, [crf.emission(words[k]) for k in at], len(words))
    assert got == pytest.approx([by_hand(crf, words)[k] for k in at], abs=1e-9)
    far = tox.Chain(crf).marginals([5, 90_000], [3.0, 3.0], 200_000)                  # very long texts
    assert far[1] == pytest.approx(tox.Chain(crf).marginals([90_000], [3.0], 200_000)[0], abs=1e-9)


def test_training_separates():
    rows = [(20, [(3, ["=bad"], 1), (9, ["=meh"], 1)])] * 30 + [(20, [(4, ["=meh"], 0)])] * 30
    crf = tox.train(rows, ["=bad", "=meh"])
    assert crf.weight["=bad"] > crf.weight["=meh"] and crf.bias < 0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    crf = tox.fit(docs, labels)
    got = tox.score(docs, crf).join(labels, "doc_id").where(tox.held_out(F.col("doc_id"))).groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.8 and n[1, 1] / (n[1, 1] + n[0, 1]) > 0.8
    assert n[0, 1] / n[0, 0] < 0.03


def test_long_texts_teach_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tox, "train", lambda texts, names: seen.extend(texts))
    df = spark.createDataFrame([(i, "vile " * 150 + "x y z" if i % 2 else "good day") for i in range(80)], "doc_id long, text string")
    tox.fit(df, df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")))
    assert seen and all([k for k, _, _ in tokens if k < 150] == list(range(150)) for _, tokens in seen)


def test_odd_rows(spark):
    crf = tox.Field({"=bad": 6.0}, -2.0, (0.0, 0.0, 0.0))
    rows = [(1, None, "x"), (2, "", "x"), (None, "very Bad.", "x"), (3, "fine " * 100_000 + "bad", "x"), (4, "fine", "x")]
    texts = {r[0]: r[1] for r in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(2)
    kept = tox.clean(df, crf)
    assert kept.columns == df.columns and kept.schema == df.schema
    good = Counter(r["doc_id"] for r in tox.score(df, crf).where("predicted = 0").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == good and tox.clean(df.where("false"), crf).count() == 0
    got = tox.score(df.unionByName(df), crf).collect()
    assert len(got) == 10 and {r["doc_id"] for r in got} == set(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        bad = [text[a:b].lower() for a, b in r["spans"]]
        assert (r["predicted"] == 1) == ("bad" in text.lower()) and set(bad) <= {"bad"} and 0 <= r["score"] <= 1
        assert r["predicted"] == 0 or bad == ["bad"]
    assert tox.score(df.where("false"), crf).count() == 0
    none = tox.fit(df.where("false"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in tox.score(df, none).collect()} == {0.0}
