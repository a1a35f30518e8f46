"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are given per document.  Tokens get theirs from them: features (a word, or its first 3 to 8
letters) that occur in documents labelled 1 far more than chance allows are *telling*; in a document
labelled 1, tokens with a telling feature are toxic, all other tokens are not.

The field has two tags per token, one weight per telling feature, a bias and weights for the pairs of
neighbouring tags.  It is trained by gradient ascent on the conditional likelihood of those tags;
tokens without telling features all look alike, so runs of them are one power of a 2 x 2 matrix and
texts of any length are handled whole.  The document score is 1 - prod(1 - m) over the forward-backward
marginals m of the toxic tag, offending offsets are the tokens with m >= 0.5.

Training reads a bounded sample of labelled rows (``sample``); scoring reads every text.  Language,
source and id are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import materialise, released

SLICE = 1024                   # rows that ``clean`` sends back at a time
SAMPLE = 12_000                # labelled rows for the choice of features, at most
CRF_SAMPLE = 4_000             # of them for the weights of the field
MAX_FEATURES = 5_000
THRESHOLD = 0.3
SPAN = 0.5
BEGINNINGS = (3, 4, 5, 6, 7, 8)
CANDIDATES = 100_000           # features of toxic documents looked for in clean ones, at most
CACHE_WORDS = 100_000
_TOKEN = re.compile(r"[^\W\d_]+")
O, T = 0, 1


def features(word: str) -> list[str]:
    """A lower-case word, and its beginnings."""
    return ["=" + word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]


@dataclass
class Field:
    """Weights of the chain; state 1 is toxic."""

    weight: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    move: tuple[float, float, float] = (0.0, 0.0, 0.0)          # O->T, T->O, T->T against O->O

    def emission(self, word: str) -> float | None:
        """What a word adds for the toxic tag; None if it has no telling feature."""
        got = [self.weight[f] for f in features(word) if f in self.weight]
        return sum(got) if got else None

    def matrix(self):
        return ((1.0, math.exp(self.move[0])), (math.exp(self.move[1]), math.exp(self.move[2])))


def _times(a, b):
    return ((a[0][0] * b[0][0] + a[0][1] * b[1][0], a[0][0] * b[0][1] + a[0][1] * b[1][1]),
            (a[1][0] * b[0][0] + a[1][1] * b[1][0], a[1][0] * b[0][1] + a[1][1] * b[1][1]))


def _scaled(m):
    s = max(m[0][0], m[0][1], m[1][0], m[1][1])
    return ((m[0][0] / s, m[0][1] / s), (m[1][0] / s, m[1][1] / s))


class Chain:
    """Forward-backward over a text given as its telling tokens (place, emission) and its length."""

    def __init__(self, crf: Field):
        self.move = crf.matrix()
        self.plain = math.exp(crf.bias)                    # weight of the toxic tag on a plain token
        self.bias = crf.bias
        self.step = ((self.move[0][0], self.move[0][1] * self.plain), (self.move[1][0], self.move[1][1] * self.plain))
        self.powers = [((1.0, 0.0), (0.0, 1.0))]       # scaled: only ratios matter

    def power(self, n: int):
        """step^n up to a factor; by halves beyond the table."""
        while len(self.powers) <= min(n, 4096):
            self.powers.append(_scaled(_times(self.powers[-1], self.step)))
        if n < len(self.powers):
            return self.powers[n]
        return _scaled(_times(self.power(n // 2), self.power(n - n // 2)))

    def marginals(self, places: list[int], emissions: list[float], length: int) -> list[float]:
        """Marginals of the toxic tag at the telling tokens; plain tokens are summed over exactly."""
        if not places:
            return []
        # alpha before the first token: the chain starts as if after a plain O token
        a = (1.0, 0.0)
        ahead, last = [], -1
        for p, e in zip(places, emissions):
            m = self.power(p - last - 1)
            a = (a[0] * m[0][0] + a[1] * m[1][0], a[0] * m[0][1] + a[1] * m[1][1])
            w = math.exp(min(50.0, e + self.bias))
            a = (a[0] * self.move[0][0] + a[1] * self.move[1][0], (a[0] * self.move[0][1] + a[1] * self.move[1][1]) * w)
            s = a[0] + a[1]
            a = (a[0] / s, a[1] / s)
            ahead.append(a)
            last = p
        m = self.power(length - 1 - last)
        b = (m[0][0] + m[0][1], m[1][0] + m[1][1])
        out = []
        for i in range(len(places) - 1, -1, -1):
            f = ahead[i]
            z = f[0] * b[0] + f[1] * b[1]
            out.append(f[1] * b[1] / z)
            if i:
                w = math.exp(min(50.0, emissions[i] + self.bias))
                b = (self.move[0][0] * b[0] + self.move[0][1] * w * b[1], self.move[1][0] * b[0] + self.move[1][1] * w * b[1])
                m = self.power(places[i] - places[i - 1] - 1)
                b = (m[0][0] * b[0] + m[0][1] * b[1], m[1][0] * b[0] + m[1][1] * b[1])
                s = b[0] + b[1]
                b = (b[0] / s, b[1] / s)
        return out[::-1]


def train(texts: list[tuple[int, list[tuple[int, list[str], int]]]], names: list[str], rounds: int = 40, rate: float = 0.5,
          penalty: float = 0.02) -> Field:
    """Gradient ascent on sequences (length, [(place, features, tag)]) around their telling tokens.

    Every sequence is the stretch from 4 plain tokens before its first telling token to 4 after its
    last; longer gaps between telling tokens count as 8 tokens.  A bounded list, so plain Python.
    """
    rows = []
    for _, tokens in texts:
        chain: list[tuple[list[str], int]] = [([], O)] * 4
        before = None
        for place, feats, tag in tokens:
            if before is not None:
                chain += [([], O)] * min(8, place - before - 1)
            chain.append((feats, tag))
            before = place
        rows.append(chain + [([], O)] * 4)
    crf = Field({n: 0.0 for n in names}, bias=-2.0, move=(-0.5, 0.0, 0.0))
    square: Counter = Counter()
    n_rows = max(1, len(rows))
    for _ in range(rounds):
        grad: Counter = Counter()
        move = crf.matrix()
        for chain in rows:
            w = [math.exp(min(30.0, crf.bias + sum(crf.weight[f] for f in fs))) for fs, _ in chain]
            ahead, a = [], (1.0, 0.0)
            for x in w:
                o, t = a[0] * move[0][0] + a[1] * move[1][0], (a[0] * move[0][1] + a[1] * move[1][1]) * x
                a = (o / (o + t), t / (o + t))
                ahead.append(a)
            b, was = (1.0, 1.0), O
            for i in range(len(chain) - 1, -1, -1):
                fs, tag = chain[i]
                f = ahead[i]
                m = f[1] * b[1] / (f[0] * b[0] + f[1] * b[1])
                d = tag - m
                grad["bias"] += d
                for x in fs:
                    grad[x] += d
                p = ahead[i - 1] if i else (1.0, 0.0)
                pair = (p[0] * move[0][0] * b[0], p[0] * move[0][1] * w[i] * b[1], p[1] * move[1][0] * b[0], p[1] * move[1][1] * w[i] * b[1])
                z = sum(pair)
                before = chain[i - 1][1] if i else O
                for j, key in ((1, "OT"), (2, "TO"), (3, "TT")):
                    grad[key] += (1.0 if (before, tag) == ((0, 1), (1, 0), (1, 1))[j - 1] else 0.0) - pair[j] / z
                b = (move[0][0] * b[0] + move[0][1] * w[i] * b[1], move[1][0] * b[0] + move[1][1] * w[i] * b[1])
                s = b[0] + b[1]
                b = (b[0] / s, b[1] / s)
        values = {"bias": crf.bias, "OT": crf.move[0], "TO": crf.move[1], "TT": crf.move[2], **crf.weight}
        for k, v in values.items():
            g = (grad[k] - penalty * v) / n_rows
            square[k] = 0.9 * square[k] + 0.1 * g * g if k in square else g * g
            values[k] = v + rate * g / (math.sqrt(square[k]) + 1e-6) if g else v
        crf.bias = values.pop("bias")
        crf.move = (values.pop("OT"), values.pop("TO"), values.pop("TT"))
        crf.weight = values
        rate *= 0.96
    return crf


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; rows without an id are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, crf_sample: int = CRF_SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Field:
    """Learns from at most ``sample`` labelled rows, chosen by a hash of their ids; held-out rows are never read."""
    known = (labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("y"))
             .where(~held_out(F.col("doc"))).groupBy("doc").agg(F.max("y").alias("y")))
    chosen = known.orderBy(F.xxhash64("doc"), "doc").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "doc")
    rows = materialise(rows.where("t is not null"), "train")
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return Field()
    prior = n[1] / (n[0] + n[1])

    def count(only: frozenset | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tally: Counter = Counter()
            known: dict[str, list[str]] = {}
            for b in batches:
                for t in b["t"]:
                    got: set[str] = set()
                    for w in set(_TOKEN.findall(t.lower())):
                        if (fs := known.get(w)) is None:
                            fs = known[w] = [f for f in features(w) if only is None or f in only]
                        got.update(fs)
                    tally.update(got)
                if len(known) > CACHE_WORDS:
                    known = {}
            yield pd.DataFrame({"f": list(tally), "n": list(tally.values())}).astype({"f": object, "n": "int64"})
        return run

    toxic = (rows.where("y = 1").mapInPandas(count(None), "f string, n long").groupBy("f").agg(F.sum("n").alias("n1"))
             .where("n1 >= 3").orderBy(F.desc("n1"), "f").limit(CANDIDATES))
    toxic = materialise(toxic, "candidates")
    only = frozenset(r["f"] for r in toxic.select("f").collect())
    clean = rows.where("y = 0").mapInPandas(count(only), "f string, n long").groupBy("f").agg(F.sum("n").alias("n0"))
    tally = toxic.join(clean, "f", "left").withColumn("n0", F.coalesce("n0", F.lit(0)))
    bar = math.log(max(10, len(only)))
    rate = (F.col("n1") + 0.5) / (F.col("n1") + F.col("n0") + 1.0)
    gain = (F.col("n1") + F.col("n0")) * (rate * F.log(rate / prior) + (1 - rate) * F.log((1 - rate) / (1 - prior)))
    told = (tally.withColumn("rate", rate).withColumn("gain", gain)
            .where((F.col("rate") >= max(0.8, prior)) & (F.col("gain") > bar))
            .orderBy(F.desc("gain"), "f").limit(MAX_FEATURES))
    names = [r["f"] for r in told.select("f").collect()]
    wanted = frozenset(names)

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, y, t in zip(b["doc"], b["y"], b["t"]):
                words = _TOKEN.findall(t.lower())
                got = [(k, [f for f in features(w) if f in wanted]) for k, w in enumerate(words)]
                got = [(k, fs) for k, fs in got if fs]
                if got:
                    out.append((i, len(words), [k for k, _ in got], [" ".join(fs) for _, fs in got], y))
            yield pd.DataFrame(out, columns=["doc", "n", "at", "fs", "y"])

    seen = (rows.mapInPandas(tag, "doc long, n long, at array<long>, fs array<string>, y int")
            .orderBy(F.xxhash64("doc"), "doc").limit(crf_sample).collect())
    return train([(r["n"], [(k, fs.split(" "), r["y"]) for k, fs in zip(r["at"], r["fs"])]) for r in seen], names)


def _scorer(crf: Field):
    """Function from a column of texts to their scores and spans, with a bounded table of words."""
    chain = Chain(crf)
    known: dict[str, float | None] = {}

    def run(column: pa.Array) -> tuple[list[float], list[list[list[int]]]]:
        scores, spans = [], []
        for t in (x for k in range(0, len(column), 256) for x in column.slice(k, 256).to_pylist()):
            if len(known) > CACHE_WORDS:
                known.clear()
            words = _TOKEN.findall(t.lower()) if t else []
            for w in words:
                if w not in known:
                    known[w] = crf.emission(w)
            at = [k for k, w in enumerate(words) if known[w] is not None]
            clean = 1.0
            m = chain.marginals(at, [known[words[k]] for k in at], len(words))
            for x in m:
                clean *= 1.0 - x
            scores.append(min(1.0, max(0.0, 1.0 - clean)))
            bad = {k for k, x in zip(at, m) if x >= SPAN}
            spans.append([list(p.span()) for k, p in enumerate(_TOKEN.finditer(t)) if k in bad] if bad else [])
        return scores, spans

    return run


def score(docs: DataFrame, crf: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, spans) per row of ``docs``; spans are the offsets of toxic tokens.

    Null and empty texts score as texts without telling tokens: 0.  Whole texts are read; repeated rows get a row
    each, rows without an id too; other columns of any name are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = _scorer(crf)
        for b in batches:
            scores, spans = tell(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.list_(pa.int32())))],
                                             names=["i", "score", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return src.mapInArrow(released(run), "i long, score double, spans array<array<int>>").select(
        F.col("i").alias(id_col), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")


def clean(docs: DataFrame, crf: Field, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text the field does not call toxic (score below THRESHOLD)."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = _scorer(crf)
        for b in batches:
            for k in range(0, b.num_rows, SLICE):
                part = b.slice(k, SLICE)
                scores, _ = tell(part.column(at))
                yield part.filter(pa.array([x < THRESHOLD for x in scores], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)
