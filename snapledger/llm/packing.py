"""Best-fit packing of token sequences, improved by swap-based local search.

Only lengths matter for packing, and there are at most ``capacity`` different ones.  So bins are
planned on the histogram of lengths: a *pattern* (the lengths in a bin) stands for all bins alike.
Its size is bounded by the capacity, not by the number of documents.  Spark counts the histogram,
numbers the pieces of each length, and gives every piece its place in the plan.

Local search on patterns exchanges one piece for one, two for one, or moves a piece between underfull
bins whenever that increases the sum of squared fills, which empties bins one after the other.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import materialise

CAPACITY = 2048
CACHE_WORDS = 300_000          # words, and words without marks, whose ids a worker remembers
SEARCH_STEPS = 20_000          # swaps tried at most (each handles all bins of its two patterns)


# ------------------------------------------------------------------------------------ tokens
# Letters whose lower case no version of Unicode changed, and marks that begin no contraction or special token.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([-.,;:!?#%&*$@()/+=~^|_\"]*)")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens:
    """Token ids of texts by way of their words.

    The tokenizer's normaliser and splitter treat blanks and line breaks as separators, so the ids of
    a text are the ids of its words one after another.  A word of Latin letters and trailing marks
    splits between the two, and its lower-case letters are one unit of the model.  Other words go
    through the whole tokenizer.  Most frequent words are met early, so tables simply stop growing.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.bytes = _byte_letters()

    @classmethod
    def of(cls, path: str) -> WordTokens:
        """The one of this worker process: its tables outlive a task."""
        if path not in _SHARED:
            _SHARED[path] = cls(path)
        return _SHARED[path]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if m := _PLAIN.fullmatch(word):
            core = m[1].lower()
            if (ids := self.letters.get(core)) is None:
                unit = core if core.isascii() else "".join(map(self.bytes.__getitem__, core.encode()))
                ids = array("I", [t.id for t in self.model.tokenize(unit)]).tobytes()
                if len(self.letters) < CACHE_WORDS:
                    self.letters[core] = ids
            if m[2]:
                if (marks := self.letters.get(m[2])) is None:
                    marks = self.letters[m[2]] = self._whole(m[2])
                ids += marks
        else:
            ids = self._whole(word)
        if len(self.words) < CACHE_WORDS:
            self.words[word] = ids
        return ids

    def ids(self, texts: list) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        get, out = self.words.get, []
        for t in texts:
            words = [] if t is None else t.replace("\n", " ").replace("\t", " ").split(" ")
            parts = list(map(get, words))
            if None in parts:
                for k, p in enumerate(parts):
                    if p is None:
                        parts[k] = get(words[k]) or self._word(words[k])
            out.append(b"".join(parts))
        return out


_SHARED: dict[str, WordTokens] = {}


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and ``end_id``, cut where longer than ``capacity``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordTokens.of(path)
        for b in batches:
            for a in range(0, len(b), 256):
                part = b.iloc[a: a + 256]
                rows = []
                for i, ids in zip(part["i"], words.ids(list(part["t"]))):
                    ids += end
                    rows += [(i, k, at // 4, len(x) // 4, zlib.crc32(x)) for k, at in enumerate(range(0, len(ids), 4 * capacity))
                             for x in [ids[at: at + 4 * capacity]]]
                yield pd.DataFrame(rows, columns=["i", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("long").cast("string").alias("i"), F.col(text_col).alias("t"))
    return src.mapInPandas(run, "i string, piece int, start long, length long, ids_crc32 long").select(
        F.col("i").cast("long").alias("doc_id"), "piece", "start", "length", "ids_crc32")


# ------------------------------------------------------------------------------------ plan
Pattern = tuple[int, ...]


def best_fit(histogram: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing on a histogram: pattern -> number of bins."""
    open_bins: dict[int, Counter] = defaultdict(Counter)       # room -> patterns
    rooms: list[int] = []                                      # sorted rooms in use

    def put(room: int, pattern: Pattern, n: int) -> None:
        at = bisect_right(rooms, room)
        if not at or rooms[at - 1] != room:
            rooms.insert(at, room)
        open_bins[room][pattern] += n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_right(rooms, length - 1)
            if at < len(rooms):                                # the tightest bins with room
                room = rooms[at]
                pattern, n = next(iter(open_bins[room].items()))
            else:
                room, pattern, n = capacity, (), left
            fit = min(room // length, left)                    # a tightest bin stays the tightest while it fits
            take = min(n, left // fit)
            if pattern:
                open_bins[room][pattern] -= take
                if not open_bins[room][pattern]:
                    del open_bins[room][pattern]
                if not open_bins[room]:
                    rooms.remove(room)
            filled = pattern + (length,) * fit
            put(capacity - sum(filled), filled, take)
            left -= take * fit
    out: Counter = Counter()
    for patterns in open_bins.values():
        out.update(patterns)
    return +out


def _swaps(a: Pattern, b: Pattern, room_a: int, room_b: int):
    """Changes that give bin a more: (from a, from b, gain of a), best first gain wins."""
    best = None
    for y in set(b):                                           # move one piece
        if y <= room_a and (best is None or y > best[2]):
            best = ((), (y,), y)
    for x in set(a):                                           # one for one
        for y in set(b):
            if 0 < y - x <= room_a and (best is None or y - x > best[2]):
                best = ((x,), (y,), y - x)
    values = sorted(set(b))
    for x in set(a):                                           # two of b for one of a
        for i, y in enumerate(values):
            for z in values[i:]:
                if (y != z or b.count(y) > 1) and 0 < y + z - x <= room_a and (best is None or y + z - x > best[2]):
                    best = ((x,), (y, z), y + z - x)
    for i, x in enumerate(sorted(set(a))):                     # two of a for one of b
        for w in sorted(set(a))[i:]:
            if x == w and a.count(x) < 2:
                continue
            for y in values:
                if 0 < y - x - w <= room_a and (best is None or y - x - w > best[2]):
                    best = ((x, w), (y,), y - x - w)
    return best


def local_search(bins: Counter, capacity: int, steps: int = SEARCH_STEPS) -> Counter:
    """Swaps between underfull bins while that raises the sum of squared fills; empty bins go.

    The emptiest pattern gives: each step moves as much as possible out of its bins into bins of a
    fuller pattern (fuller gains squared fill, emptier loses less).  Ends at a local optimum, at the
    bound ceil(total / capacity), or after ``steps`` tries.
    """
    bins = Counter(bins)
    least = -(-sum(sum(p) * n for p, n in bins.items()) // capacity)
    tried: set = set()
    for _ in range(steps):
        if sum(bins.values()) <= least:
            break
        under = sorted((p for p in bins if sum(p) < capacity), key=lambda p: (sum(p), p))
        change = None
        for giver in under[:4]:
            for taker in reversed(under):
                if taker == giver and bins[giver] < 2 or sum(taker) < sum(giver) or (giver, taker) in tried:
                    continue
                found = _swaps(taker, giver, capacity - sum(taker), capacity - sum(giver))
                if found and sum(giver) - found[2] >= 0:
                    change = (giver, taker, *found)
                    break
                tried.add((giver, taker))
            if change:
                break
        if not change:
            break
        giver, taker, out_of_taker, out_of_giver, _ = change
        n = bins[giver] // 2 if giver == taker else min(bins[giver], bins[taker])
        g, t = Counter(giver), Counter(taker)
        g.subtract(out_of_giver), g.update(out_of_taker)
        t.subtract(out_of_taker), t.update(out_of_giver)
        for old in (giver, taker):
            bins[old] -= n
            if not bins[old]:
                del bins[old]
        for new in (g, t):
            if key := tuple(sorted(new.elements(), reverse=True)):
                bins[key] += n
    return bins


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter:
    return local_search(best_fit(histogram, capacity), capacity)


def _slots(bins: Counter) -> dict[str, np.ndarray]:
    """Runs of equal slots: pieces low <= number < low + n of a length go to sequences first + i, at offset."""
    used: Counter = Counter()
    rows, first = [], 0
    for pattern in sorted(bins, reverse=True):
        n, offset = bins[pattern], 0
        for length in pattern:
            rows.append((length, used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "low": table[:, 1], "first": table[:, 2], "offset": table[:, 3]}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (as ``pieces`` gives it) with ``sequence_id`` and ``offset``.

    Every piece has one place; sequences hold at most ``capacity`` ids, without gaps from 0.  The plan
    that goes to the tasks has at most a few rows per different length.
    """
    cut = materialise(cut.withColumn("tie", F.xxhash64("doc_id", "piece", "ids_crc32")), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}   # at most `capacity` rows
    slots = _slots(plan_bins(histogram, capacity))

    # the number of a piece among those of its length, counted in two levels: no window holds a hot length
    n_buckets = math.isqrt(sum(histogram.values())) + 1         # as many buckets as rows in one, at most
    dealt = cut.withColumn("bucket", F.pmod("tie", F.lit(n_buckets)))
    sums = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n_in"))
    up_to = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n_in").over(up_to), F.lit(0))).drop("n_in")
    inside = Window.partitionBy("length", "bucket").orderBy("tie", "doc_id", "piece")
    counted = dealt.join(sums, ["length", "bucket"]).withColumn("number", F.col("before") + F.row_number().over(inside) - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = {length: i for i, length in reversed(list(enumerate(slots["length"])))}
        ends = Counter(slots["length"].tolist())
        for b in batches:
            seq, off = np.empty(len(b), dtype=np.int64), np.empty(len(b), dtype=np.int64)
            length, number = b["length"].to_numpy(), b["number"].to_numpy()
            for v in np.unique(length):
                at, lo = np.flatnonzero(length == v), starts[v]
                run = lo + np.searchsorted(slots["low"][lo: lo + ends[v]], number[at], side="right") - 1
                seq[at] = slots["first"][run] + number[at] - slots["low"][run]
                off[at] = slots["offset"][run]
            b["sequence_id"], b["offset"] = seq, off
            yield b[["doc", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return counted.select(F.col("doc_id").cast("string").alias("doc"), "piece", "start", "length", "ids_crc32", "number").mapInPandas(
        place, "doc string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").select(
            F.col("doc").cast("long").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
