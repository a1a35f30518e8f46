"""Document likelihood from a subword lattice.

A text is a sequence of word tokens and one end.  A token's probability mixes two parts:

* its discounted share of the training tokens, (c - d) / N;
* the mass d * V / N so set aside, times the word's probability under a subword unigram model.  That
  is the sum over *all* segmentations of the word into pieces of an existing vocabulary: the first
  piece, further pieces, the end of the word.  The lattice of a word is summed by a forward recursion
  in log space.

The vocabulary is given (a sentencepiece model: its pieces, and its scores, which are ranks and start
the weights by Zipf's law); the weights of its pieces are then re-estimated on the training words by
expectation maximisation over the same lattices, each distinct word counting once (words the training
texts lack are like those they use least).  Both parts sum to one over all words.

From a text's second token on the lattice has a further edge for each word the text used before, of
weight CACHE times its share of the tokens so far; the other edges share the rest.  So the model is a
proper distribution over texts.

Word counts, vocabulary size and piece weights come from all training documents.  Words of very many
texts are looked up in a table of bounded size; all others meet their counts in a shuffle join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import lower_words, materialise, mix

FREQUENT = 100_000             # words in the table that every task gets, at most
FLUSH_WORDS = 400_000          # words a task counts before it sends them on
ROUNDS = 2                     # of expectation maximisation
CACHE = 0.2                    # weight of words the text used before
LONG_WORD = 96                 # words longer than this are handled one by one
NONE = -1e30
_TABLE_BITS = 20


@dataclass
class Pieces:
    """Pieces of the vocabulary and their log weights; a piece that starts a word begins with a blank."""

    names: list[bytes]
    logp: np.ndarray           # start pieces sum to one; further pieces with the end of a word do
    end: float

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        rank: dict[bytes, float] = {bytes([b]): 40_000.0 for b in range(256)}
        rank[b" "] = 1_000.0
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.get_score(i) < -1e6:
                continue
            name = model.id_to_piece(i).replace("▁", " ").encode().lower()
            if name and b" " not in name[1:]:
                rank[name] = min(rank.get(name, math.inf), 2.0 - model.get_score(i))
        names = sorted(rank)
        return cls(names, *_normalised(names, np.array([1.0 / (rank[n] + 10.0) for n in names]), None))

    def index(self) -> _Index:
        return _Index(self)


def _normalised(names: list[bytes], mass: np.ndarray, end: float | None):
    start = np.array([n.startswith(b" ") for n in names])
    further = mass[~start].sum()
    end = further / 3 if end is None else end
    logp = np.where(start, np.log(mass / mass[start].sum()), np.log(mass / (further + end)))
    return logp, math.log(end / (further + end))


class _Index:
    """Finds pieces, and what pieces begin with, by hash: slots by the hash's low bits, checked by the whole hash."""

    def __init__(self, pieces: Pieces):
        self.logp, self.end = pieces.logp, pieces.end
        lens = np.array([len(n) for n in pieces.names])
        self.width = width = int(lens.max())
        self.rand = np.random.default_rng(5).integers(1, 2**63, (width, 256), dtype=np.uint64)
        mat = np.frombuffer(b"".join(n.ljust(width, b"\0") for n in pieces.names), dtype=np.uint8).reshape(-1, width)
        ahead = np.zeros((len(lens), width), dtype=np.uint64)
        h = np.zeros(len(lens), dtype=np.uint64)
        for k in range(width):
            h = h + self.rand[k][mat[:, k]]
            ahead[:, k] = mix(h + np.uint64(k + 1))
        keys, node = np.unique(ahead[np.arange(width) < lens[:, None]], return_inverse=True)
        self.keys = np.append(keys, np.uint64(0))
        self.piece = np.full(len(keys), -1, dtype=np.int32)               # of a beginning that is a piece itself
        self.piece[node[np.cumsum(lens) - 1]] = np.arange(len(lens))
        self.slots: list[np.ndarray] = []
        rest, at = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            row = np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
            where, first = np.unique(at[rest], return_index=True)
            row[where] = rest[first]
            self.slots.append(row)
            rest = np.delete(rest, first)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The beginnings with these hashes, or -1."""
        at = self._slot(key)
        out = self.slots[0][at]
        rest = np.flatnonzero((out >= 0) & (self.keys[out] != key))
        for row in self.slots[1:]:
            out[rest] = row[at[rest]]
            rest = rest[(out[rest] >= 0) & (self.keys[out[rest]] != key[rest])]
        out[rest] = -1
        return out

    def lattice(self, mat: np.ndarray, lens: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """[l - 1][i]: the words (columns of ``mat``) that spell a piece at i .. i + l, and those pieces.

        A place is followed only as long as its bytes begin some piece, so long pieces cost what occurs of them.
        """
        length, n = mat.shape
        flat = np.ascontiguousarray(mat).ravel()
        at = np.flatnonzero(np.arange(length)[:, None] < lens)            # byte i of word w is at i * n + w
        left, h = lens[at % n] - at // n, np.zeros(len(at), dtype=np.uint64)
        out, rows = [], np.arange(length + 1) * n
        for k in range(min(self.width, length)):
            more = left > k
            at, left, h = at[more], left[more], h[more]
            h = h + self.rand[k][flat[at + k * n]]
            node = self._find(mix(h + np.uint64(k + 1)))
            more = node >= 0
            at, left, h = at[more], left[more], h[more]
            piece = self.piece[node[more]]
            hit = piece >= 0
            own, piece = at[hit], piece[hit]
            cut, words = np.searchsorted(own, rows).tolist(), own % n
            out.append([(words[a:b], piece[a:b]) for a, b in zip(cut, cut[1:])])
        return out

    def forward(self, mat: np.ndarray, lens: np.ndarray, lattice: list) -> tuple[np.ndarray, np.ndarray]:
        """alpha[i, w] (log mass of all ways to spell the first i bytes) and the words' log probabilities."""
        length, n = mat.shape
        alpha = np.full((length + 1, n), NONE)
        alpha[0] = 0.0
        for j in range(1, length + 1):
            ways = []
            for k in range(1, min(len(lattice), j) + 1):
                words, piece = lattice[k - 1][j - k]
                if len(words):
                    ways.append((words, alpha[j - k][words] + self.logp[piece]))
            alpha[j] = _logsum(ways, n)
        return alpha, alpha[lens, np.arange(n)] + self.end

    def expected(self, mat: np.ndarray, lens: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected uses of each piece, and of the end of a word, in ``weight`` copies of the words."""
        length, n = mat.shape
        lattice = self.lattice(mat, lens)
        alpha, total = self.forward(mat, lens, lattice)
        beta = np.full((length + 1, n), NONE)
        beta[lens, np.arange(n)] = self.end
        used, uses = [], []
        for i in range(length - 1, -1, -1):
            ways = []
            for k in range(1, min(len(lattice), length - i) + 1):
                words, piece = lattice[k - 1][i]
                if len(words):
                    way = self.logp[piece] + beta[i + k][words]
                    ways.append((words, way))
                    used.append(piece)
                    uses.append(np.exp(np.minimum(0.0, alpha[i][words] + way - total[words])) * weight[words])
            beta[i] = np.where(i < lens, _logsum(ways, n), beta[i])
        return np.bincount(np.concatenate(used), weights=np.concatenate(uses), minlength=len(self.logp)), float(weight.sum())


def _logsum(ways: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    top = np.full(n, NONE)
    for words, way in ways:
        top[words] = np.maximum(top[words], way)
    out = np.zeros(n)
    for words, way in ways:
        out[words] += np.exp(way - top[words])
    some = top > NONE / 2
    return np.where(some, top + np.log(np.where(some, out, 1.0)), NONE)


def _batches(words: list[bytes], n: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, bytes of the words as columns with a blank ahead, lengths), words of like length together."""
    lens = np.array([len(w) + 1 for w in words])
    order = np.argsort(lens, kind="stable")
    at = 0
    while at < len(order):
        take = n if lens[order[min(at + n, len(order)) - 1]] <= LONG_WORD else max(1, int((lens[order[at:at + n]] <= LONG_WORD).sum()))
        some = order[at: at + take]
        width = int(lens[some].max())
        mat = np.frombuffer(b"".join((b" " + words[i]).ljust(width, b"\0") for i in some), dtype=np.uint8).reshape(-1, width).T
        yield some, mat, lens[some]
        at += len(some)


def log10_words(words: list[bytes], index: _Index) -> np.ndarray:
    """log10 of the words' probabilities under the subword model."""
    out = np.empty(len(words))
    for some, mat, lens in _batches(words):
        out[some] = index.forward(mat, lens, index.lattice(mat, lens))[1] / math.log(10)
    return out


def log10_add(log: np.ndarray, more: np.ndarray) -> np.ndarray:
    """log10(10 ** log + more): ``log`` itself where nothing is added, so no probability is too small."""
    with np.errstate(divide="ignore", under="ignore"):
        return np.where(more > 0, np.log10(10.0 ** np.maximum(log, -300.0) + more), log)


# ------------------------------------------------------------------------------------ Spark
def is_held_out(doc: str | None, modulus: int = 7, rest: int = 2) -> bool:
    return doc is None or zlib.crc32(doc.encode()) % modulus == rest


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, n) from (i, t): uses in training documents and in all; the null word is the end of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, other = Counter(), Counter()

        def out():
            c, n = Counter(learnt), Counter(learnt)
            n.update(other)
            words = list(n)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(map(c.__getitem__, words), pa.int64()),
                                               pa.array(n.values(), pa.int64())], names=["word", "c", "n"])

        for b in batches:
            for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist()):
                into = other if is_held_out(i) else learnt
                into.update(lower_words(t))
                into[None] += 1
                if len(learnt) + len(other) > FLUSH_WORDS:
                    yield out()
                    learnt, other = Counter(), Counter()
        if learnt or other:
            yield out()

    return (docs.select("i", "t").mapInArrow(run, "word binary, c long, n long").groupBy("word")
            .agg(F.sum("c").alias("c"), F.sum("n").alias("n")))


def train_pieces(words: DataFrame, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Re-estimates the weights on the training words.  The driver sees one row per piece."""
    for _ in range(rounds):
        def run(batches: Iterator[pd.DataFrame], now=pieces) -> Iterator[pd.DataFrame]:
            index = now.index()
            uses, ends = np.zeros(len(now.names)), 0.0
            for b in batches:
                own, weight = list(b["word"]), np.ones(len(b))
                for some, mat, lens in _batches(own):
                    u, e = index.expected(mat, lens, weight[some])
                    uses += u
                    ends += e
            there = np.flatnonzero(uses)
            yield pd.DataFrame({"piece": np.append(there, -1).astype(np.int64), "uses": np.append(uses[there], ends)})

        got = words.select("word").mapInPandas(run, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses"))
        told = {r["piece"]: r["uses"] for r in got.collect()}            # at most the vocabulary's size
        if not told.get(-1):
            return pieces
        mass = np.full(len(pieces.names), 0.01)
        for piece, n in told.items():
            if piece >= 0:
                mass[piece] += n
        pieces = Pieces(pieces.names, *_normalised(pieces.names, mass, told[-1]))
    return pieces


def score(docs: DataFrame, path: str, frequent: int = FREQUENT, rounds: int = ROUNDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score) per row of ``docs``.

    Words have A-Z lower-cased; every text ends with one end token.  ``base_score`` is the add-one
    unigram model of the contract, ``score`` the whole model, ``lattice_score`` the sum over all segmentations of
    the text's words under the vocabulary's own weights alone, without counts, re-estimation or cache (the text's
    end as in ``score``); all are log10, and finite whatever the words.  A null text is empty (its
    end alone is scored); rows without an id are scored and never learnt from; repeated rows count as
    often as they come.  Words of any length are scored whole.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").cast("string").alias("i"), F.col(text_col).alias("t"))
    counted = materialise(count_words(src), "counts")
    is_word = F.col("word").isNotNull()
    learnt = F.col("c") > 0
    told = counted.agg(F.sum("c").alias("N"), F.count_if(learnt).alias("V"), F.count_if(learnt & is_word).alias("Vw"),
                       F.count_if(is_word & (F.col("c") == 1)).alias("n1"), F.count_if(is_word & (F.col("c") == 2)).alias("n2")).first()
    n_all, v_all = told["N"] or 0, told["V"]
    base_total = n_all + v_all + 1
    discount = min(0.9, max(0.1, told["n1"] / max(1, told["n1"] + 2 * told["n2"])))
    spare = discount * told["Vw"] / n_all if n_all and told["Vw"] else 1.0
    given = Pieces.load(path)
    pieces = train_pieces(counted.where(is_word & learnt), given, rounds)

    def log_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, raw = pieces.index(), given.index()
        for b in batches:
            own, c = list(b["word"]), b["c"].to_numpy(dtype=float)
            sub = log10_words(own, index)
            share = np.maximum(0.0, c - discount) / max(1, n_all)
            yield pd.DataFrame({"word": own, "c": b["c"], "n": b["n"], "lm": log10_add(sub + math.log10(spare), share),
                                "raw": log10_words(own, raw)})

    words = materialise(counted.where(is_word).mapInPandas(log_of, "word binary, c long, n long, lm double, raw double"), "words")
    end = counted.where(~is_word).first()
    c_end = end["c"] if end else 0
    lm_end = math.log10(c_end / n_all) if c_end else math.log10(spare)

    # the most used words, at most `frequent`: a threshold from a short histogram of counts
    step = F.floor(F.log2("n") * 16)
    hist = sorted(((r["b"], r["count"]) for r in words.groupBy(step.alias("b")).count().collect()), reverse=True)
    total, low = 0, None
    for b, n in hist:
        if total + n > frequent:
            break
        total, low = total + n, b
    top = [] if low is None else words.where(step >= low).select("word", "c", "lm", "raw").collect()
    rest = 1 - CACHE
    c_top = np.array([r["c"] for r in top], dtype=float)
    table = spark.sparkContext.broadcast((
        {bytes(r["word"]): k for k, r in enumerate(top)}, np.log10((c_top + 1) / base_total),
        math.log10(rest) + np.array([r["lm"] for r in top], dtype=float), c_top > 0, np.array([r["raw"] for r in top], dtype=float)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        place, base_of, alone_of, learnt_of, raw_of = table.value
        get = place.get
        for b in batches:
            out: tuple[list, ...] = tuple([] for _ in range(9))

            def add(*row):
                for column, value in zip(out, row):
                    column.append(value)

            for i, t in zip(b.column("i").to_pylist(), b.column("t").to_pylist()):
                uid += 1
                words = lower_words(t)
                ids = np.array([get(w, -1) for w in words], dtype=np.int64)
                at = np.flatnonzero(ids >= 0)
                own = ids[at]
                base = math.log10((c_end + 1) / base_total) + base_of[own].sum()
                n_known = int(c_end > 0) + int(learnt_of[own].sum())
                lm = lm_end          # one factor `rest` too many at the first token, one too few at the end
                raw = lm_end + raw_of[own].sum()
                if len(own):         # how often each token's word was used before it
                    order = np.argsort(own, kind="stable")
                    word, j = own[order], at[order]
                    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                    before = np.arange(len(word)) - np.repeat(first, np.diff(np.append(first, len(word))))
                    lm += log10_add(alone_of[word], CACHE * before / np.maximum(1, j)).sum()
                rare: dict[bytes, list | None] = {}
                for j in np.flatnonzero(ids < 0).tolist():
                    w = words[j]
                    if w not in rare:
                        rare[w] = None
                    elif (seen := rare[w]) is None:
                        rare[w] = [CACHE / j]
                    else:
                        seen.append(CACHE * (len(seen) + 1) / j)
                for w, f in rare.items():
                    add(uid, None, w, 1 + len(f or ()), None, None, None, f, None)
                add(uid, i, None, len(words) + 1, n_known, base, lm, None, raw)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.float64()]
    names = ["uid", "i", "word", "n", "n_known", "base", "lm", "again", "raw"]
    seen = materialise(src.mapInArrow(
        look_up, "uid long, i string, word binary, n long, n_known long, base double, lm double, again array<double>, raw double"), "lookups")
    alone = F.lit(math.log10(rest)) + F.col("lm")
    repeated = F.coalesce(F.aggregate("again", F.lit(0.0), lambda total, f: total + F.log10(F.pow(F.lit(10.0), alone) + f)), F.lit(0.0))
    rare = seen.where(is_word).select("uid", "word", F.col("n").alias("k"), "again").join(
        words.select("word", "c", "lm", F.col("raw").alias("word_raw")), "word").groupBy("uid").agg(
        F.sum(F.when(learnt, F.col("k")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("k") * F.log10((F.col("c") + 1) / F.lit(base_total))).alias("rare_base"),
        F.sum(alone + repeated).alias("rare_lm"), F.sum(F.col("k") * F.col("word_raw")).alias("rare_raw"))
    zero = F.lit(0.0)
    return seen.where(~is_word).join(rare, "uid", "left").select(
        F.col("i").cast("long").alias("doc_id"),
        F.coalesce(F.crc32(F.col("i").cast("binary")) % 7 == 2, F.lit(True)).alias("held_out"),
        F.col("n").alias("n_tokens"), (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"), (F.col("lm") + F.coalesce("rare_lm", zero)).alias("score"),
        (F.col("raw") + F.coalesce("rare_raw", zero)).alias("lattice_score"))
