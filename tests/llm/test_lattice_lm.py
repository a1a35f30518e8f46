"""The lattice model against enumerating segmentations, and the scores against plain counting."""

import math
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from snapledger.llm import lattice_lm as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def by_hand(word, pieces):
    """Sum over all segmentations, one by one."""
    known = dict(zip(pieces.names, pieces.logp))
    text, total = b" " + word, 0.0
    for cuts in product([0, 1], repeat=len(text) - 1):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(text[start:i])
                start = i
        parts.append(text[start:])
        if all(p in known for p in parts):
            total += math.exp(sum(known[p] for p in parts) + pieces.end)
    return math.log10(total)


def test_all_segmentations():
    pieces = lm.Pieces.load(PATH)
    words = [b"the", b"nation", "é".encode(), b"x", b"\xff\xfe", b"ing.", b"a" * 11]
    got = lm.log10_words(words, pieces.index())
    assert got == pytest.approx([by_hand(w, pieces) for w in words], abs=1e-9)
    long = lm.log10_words([b"ab" * 3000, b"the"], pieces.index())
    assert np.isfinite(long).all() and long[0] < -3000 and long[1] == pytest.approx(got[0])


def test_whole_vocabulary():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    told = {model.id_to_piece(i).replace("▁", " ").encode().lower() for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.get_score(i) < -1e6)}
    pieces = lm.Pieces.load(PATH)
    assert {n for n in told if n and b" " not in n[1:]} <= set(pieces.names)
    assert {b" government", b" information", b" university", b"translation"} <= set(pieces.names)
    index = pieces.index()
    long = sorted(pieces.names, key=len)[-300:]
    words = [n.removeprefix(b" ") for n in long]
    mat, lens = next(lm._batches(words, len(words)))[1:]
    found = {pieces.names[p] for row in index.lattice(mat, lens) for _, got in row for p in got}
    assert set(long) <= found
    words = [b"government", b"information", b"retranslation", b"universityx"]
    assert lm.log10_words(words, index) == pytest.approx([by_hand(w, pieces) for w in words], abs=1e-9)


def test_weights_are_probabilities_and_training_helps():
    pieces = lm.Pieces.load(PATH)
    start = np.array([n.startswith(b" ") for n in pieces.names])
    assert np.exp(pieces.logp[start]).sum() == pytest.approx(1)
    assert np.exp(pieces.logp[~start]).sum() + math.exp(pieces.end) == pytest.approx(1)
    words, index = [b"tionandthe", b"thetionand", b"andandtion"], pieces.index()
    uses, ends = index.expected(*[x for x in next(lm._batches(words))[1:]], np.ones(3))
    assert ends == 3 and uses[start].sum() == pytest.approx(3)
    better = lm.Pieces(pieces.names, *lm._normalised(pieces.names, uses + 0.01, ends))
    assert lm.log10_words(words, better.index()).sum() > lm.log10_words(words, index).sum()


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 0, 7])
def test_counts_and_base(spark, frequent):
    rows = [(i, "the Cat sat on THE mat " * (i % 3) + f"w{i % 11} é\x0bx") for i in range(60)] + [(100, None), (101, ""), (None, "the odd"), (5, "again again again")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = lm.score(df, PATH, frequent=frequent).collect()
    train = Counter()
    for i, t in rows:
        if not lm.is_held_out(None if i is None else str(i)):
            train.update(lm.lower_words(t) + [None])
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, t in rows:
        tokens = lm.lower_words(t) + [None]
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens)
        want[(i, lm.is_held_out(None if i is None else str(i)), len(tokens), sum(train[w] > 0 for w in tokens), n, round(base, 8))] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 8)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    test_counts_and_base.scores = getattr(test_counts_and_base, "scores", None) or sorted(r["score"] for r in got)
    assert sorted(r["score"] for r in got) == pytest.approx(test_counts_and_base.scores, abs=1e-6)


def by_the_rules(rows):
    """Scores of whole texts, token by token, from the rules of the model."""
    held = {i: lm.is_held_out(None if i is None else str(i)) for i, _ in rows}
    train = Counter(w for i, t in rows if not held[i] for w in [*lm.lower_words(t), None])
    n, words = sum(train.values()), [w for w in train if w is not None]
    once, twice = (sum(train[w] == k for w in words) for k in (1, 2))
    d = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    spare = d * len(words) / n
    given = lm.Pieces.load(PATH)
    pieces, mass = given, None
    for _ in range(lm.ROUNDS):
        uses, ends, index = np.zeros(len(given.names)), 0.0, pieces.index()
        for _, mat, lens in lm._batches(sorted(words)):
            u, e = index.expected(mat, lens, np.ones(len(lens)))
            uses, ends = uses + u, ends + e
        mass = np.full(len(given.names), 0.01) + uses
        pieces = lm.Pieces(given.names, *lm._normalised(given.names, mass, ends))
    every = sorted({w for _, t in rows for w in lm.lower_words(t)})
    sub, raw = (dict(zip(every, lm.log10_words(every, p.index()))) for p in (pieces, given))
    out = []
    for i, t in rows:
        seen, total, marginal = Counter(), 0.0, 0.0
        tokens = lm.lower_words(t)
        for j, w in enumerate([*tokens, None]):
            if w is None:
                own = math.log10(train[None] / n)
            else:
                own = sub[w] + math.log10(spare)
                if train[w]:
                    own = math.log10((train[w] - d) / n + spare * 10 ** sub[w])
                marginal += raw[w]
            if not tokens:
                total += own
            elif j == 0 or not seen[w]:
                total += own + (math.log10(1 - lm.CACHE) if j else 0.0)
            else:
                total += math.log10((1 - lm.CACHE) * 10 ** own + lm.CACHE * seen[w] / j)
            seen[w] += 1
        out.append((-1 if i is None else i, round(total, 6), round(marginal + math.log10(train[None] / n), 6)))
    return sorted(out)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 0, 7])
def test_scores_by_the_rules(spark, frequent):
    """Words that training never saw, longer than any double's exponent reaches, once and repeated: every score is finite."""
    url, chinese = "https://example.org/" + "a7" * 110, "".join(chr(0x4E00 + 37 * k) for k in range(64))
    held = [i for i in range(300, 400) if lm.is_held_out(str(i))]
    rows = [(i, f"the cat sat on the mat w{i % 11} {'new' if i % 5 else 'old'}") for i in range(40)] + [(200, None), (201, " "), (None, "odd the odd")]
    rows += [(held[0], f"see {url} the"), (held[1], f"{url} {url} {chinese} {url}"), (held[2], chinese), (held[3], "x" * 5000 + " end")]
    df = spark.createDataFrame([(i, t, 0.0, "c") for i, t in rows], "doc_id long, text string, lm double, word string").repartition(3)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], round(r["score"], 6), round(r["lattice_score"], 6)) for r in lm.score(df, PATH, frequent=frequent).collect())
    assert all(math.isfinite(x) for r in got for x in r)
    want = by_the_rules(rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    for a, b in zip(got, want):
        assert a[1:] == pytest.approx(b[1:], abs=2e-5), (a, b)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(df, PATH).count() == 0
