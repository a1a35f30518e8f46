"""Helpers the operators of this subpackage share: words, hashing, hot keys."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.session import cut_lineage

# A group of at least 1/HOT_GROUPS of all rows is "hot".  By the pigeonhole principle at
# most HOT_GROUPS groups can be hot, whatever the data: the bound of every broadcast below.
HOT_GROUPS = 4000
HOT_LEAST = 64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Letters A-Z to a-z, and every ASCII character but letters and digits to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_pow = np.ones(1, dtype=np.uint64)
_pow_inv = np.ones(1, dtype=np.uint64)


def hot_rows(total: int) -> int:
    """Rows from which on a group counts as hot; at most HOT_GROUPS groups reach it."""
    return max(HOT_LEAST, -(-total // HOT_GROUPS))


def join_groups(left: DataFrame, groups: DataFrame, key: list[str], size: str, total: int,
                how: str = "left") -> DataFrame:
    """``left`` joined to ``groups`` (one row per key) where a few keys may hold most rows.

    ``groups[size]`` is the number of ``left`` rows of the key and ``total`` the number of all
    ``left`` rows.  Hot groups (at most HOT_GROUPS by pigeonhole, so a broadcast of bounded
    size) never shuffle ``left``; every other key has fewer than ``hot_rows(total)`` rows and
    goes through an ordinary shuffle join.  Keys must not be null.  The result keeps ``size``.
    """
    least = hot_rows(total)
    hot = F.broadcast(groups.where(F.col(size) >= least))
    cold = groups.where(F.col(size) < least)
    there = left.join(hot, key, "inner")
    rest = left.join(F.broadcast(groups.where(F.col(size) >= least).select(*key)), key, "left_anti").join(cold, key, how)
    return there.unionByName(rest)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A table in the folder of ``spark.checkpoint.dir``, read back: cuts the lineage."""
    return cut_lineage(df, f"llm-{name}")


def utf8(text) -> bytes:
    """UTF-8 of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def lower_words(text) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return utf8(text).lower().split()


def folded(text) -> bytes:
    """UTF-8 of the text, A-Z lower-cased, with a space for each byte of ASCII that is no letter or digit."""
    return utf8(text).translate(_FOLD)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _pow_inv
    if len(_pow) < n:
        size = max(n, 2 * len(_pow), 4096)
        up = np.full(size, _P, dtype=np.uint64)
        down = np.full(size, _P_INV, dtype=np.uint64)
        up[0] = down[0] = 1
        _pow, _pow_inv = np.cumprod(up), np.cumprod(down)
        if size > 1 << 24:                       # one giant text must not keep its tables for good
            got = _pow, _pow_inv
            _pow, _pow_inv = _pow[:4096].copy(), _pow_inv[:4096].copy()
            return got
    return _pow, _pow_inv


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any substring follows (``range_hash``)."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end): equal substrings, equal hashes."""
    _, down = _powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a text's bytes."""
    edge = np.diff(_SPACE[data].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(text) -> np.ndarray:
    """One 64-bit hash per word (as ``lower_words``), in text order."""
    data = np.frombuffer(utf8(text).lower(), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, dtype=np.uint64)
    return range_hash(prefix_hash(data), *word_spans(data))


def shingle_set(text, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle, none none."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(n, len(w))
    h = w[: len(w) - n + 1].copy()
    for i in range(1, n):
        h = h * np.uint64(0x100000001B3) + w[i: len(w) - n + 1 + i]
    return np.unique(mix(h + np.uint64(n)))


def release() -> None:
    """Gives what this Python worker holds but doesn't use back to the system."""
    global _pow, _pow_inv
    _pow, _pow_inv = _pow[:1].copy(), _pow_inv[:1].copy()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                    # another C library: it keeps its own ways
        pass


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for tasks of stages that follow one another: workers live on, what a task used does not."""
    def go(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()
    return go


def code_points(name: str) -> Column:
    return F.coalesce(F.length(name), F.lit(0)).cast("long")
