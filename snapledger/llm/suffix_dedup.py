"""Repeated passages across documents: column-wise suffix sorting of many short strings.

A byte goes if a ``window``-byte string that covers it also starts in a document with a smaller id.

1. Documents are packed into blocks (rows of a written table; a row is never split).
2. Each window names one *anchor*: the smallest-hash ``gram``-byte string inside it.  Equal windows
   name equal anchors, so only the anchors' hashes travel first, packed, to find out which anchors
   occur in more than one document.  Answers come back as bits per block.
3. Around every occurrence of a shared anchor lies a *segment*: the run of windows that name it.
   Distinct segments of a block travel, aligned on their anchor, to the task that owns the anchor.
4. There the multi-document construction runs column by column from the right: each round inserts
   one symbol of every segment, and updates the order of all suffixes (the preceding symbols in
   that order are the round's piece of the Burrows-Wheeler transform) and the common prefixes of
   neighbours.  Neighbours with a common prefix of a whole window form a class; a segment's window
   is repeated if its class holds a smaller document id.
5. The answers go back, one bit per window, and each block cuts its documents.

What the external-memory algorithm keeps in sequential files between rounds is here bounded arrays
per task; between steps, the written tables in ``spark.checkpoint.dir`` are those files.  Within one
column all suffixes are aligned, so a window needs comparing with its own column only.

An anchor found in very many blocks is *hot*: its windows travel one by one, dealt by their own
hash, so no task owns more than its share of a passage that most documents hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import materialise, mix, prefix_hash, range_hash, released, utf8

WINDOW, GRAM = 50, 24
BLOCK_BYTES = 1 << 20
PART_BYTES = 8 << 20           # text per owner of anchors
HOT_BLOCKS = 1024              # blocks from which on an anchor's windows are dealt one by one
CHUNK = 50_000                 # segments sorted together
_NO_ID = np.iinfo(np.int64).max
_BLOCK = "block long, n_bytes long, n_docs int, ids binary, known binary, lens binary, rest array<string>, payload binary"


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    packed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit(None).cast("string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=1)
        ids, texts, rests, size = [], [], [], 0

        def row():
            known = np.array([i is not None and i == i for i in ids], dtype=bool)
            whole = np.array([int(i) if k else _NO_ID for i, k in zip(ids, known)], dtype=np.int64)
            lens = np.array([len(t) for t in texts], dtype=np.int64)
            return pd.DataFrame({"block": [serial], "n_bytes": [size], "n_docs": [len(ids)], "ids": [whole.tobytes()],
                                 "known": [known.tobytes()], "lens": [lens.tobytes()], "rest": [list(rests)],
                                 "payload": [press.compress(b"".join(texts))]})

        for b in batches:
            for i, t, r in zip(b["i"].tolist(), b["t"], b["r"]):
                raw = utf8(t)
                if ids and size + len(raw) > block_bytes:
                    yield row()
                    serial += 1
                    ids, texts, rests, size = [], [], [], 0
                ids.append(None if pd.isna(i) else int(i))
                texts.append(raw)
                rests.append(r)
                size += len(raw)
        if ids:
            yield row()

    # ids travel as text: a nullable long would reach pandas as a double
    src = docs.select(F.col(id_col).cast("long").cast("string").alias("i"), F.col(text_col).alias("t"), packed.alias("r"))
    return src.mapInPandas(released(run), _BLOCK)


class Block:
    """A block's bytes, documents and anchors, the same whenever they are computed."""

    def __init__(self, row, parts: int, window: int, gram: int):
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.known = np.frombuffer(row.known, dtype=bool)
        lens = np.frombuffer(row.lens, dtype=np.int64)
        self.ends = np.cumsum(lens)
        self.starts = self.ends - lens
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.payload, max_output_size=max(1, row.n_bytes)), dtype=np.uint8)
        self.parts, self.window, self.gram = parts, window, gram
        self.first, self.last, self.pos, h = self._anchors()
        # entries: the block's distinct anchors, by owner, then hash
        name = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        self.names, self.entry = np.unique((name % np.uint64(parts)) << np.uint64(32) | name >> np.uint64(32), return_inverse=True)
        self.doc = np.searchsorted(self.ends, self.first, side="right")

    def _anchors(self):
        n, window, gram = len(self.data), self.window, self.gram
        none = np.zeros(0, dtype=np.int64)
        if n < window:
            return none, none, none, none.astype(np.uint64)
        self.prefix = prefix_hash(self.data)
        g = np.arange(n - gram + 1)
        h = range_hash(self.prefix, g, g + gram)
        m = (h & np.uint64(0xFFFFFFFF00000000)) | g.astype(np.uint64)     # leftmost among equals
        width, span = window - gram + 1, 1
        while 2 * span <= width:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if span < width:
            m = np.minimum(m[: len(m) - (width - span)], m[width - span:])
        pos = (m & np.uint64(0xFFFFFFFF)).astype(np.int64)                # of windows 0 .. n - window
        ok = np.ones(len(pos), dtype=bool)
        for e in self.ends[:-1]:                                          # no window crosses documents
            ok[max(0, e - window + 1): e] = False
        new = np.ones(len(pos), dtype=bool)
        new[1:] = (pos[1:] != pos[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(pos)) - 1
        first, last = first[ok[first]], last[ok[first]]
        return first, last, pos[first], h[pos[first]]

    def owners(self):
        """(part, slice of entries) for every owner that has any."""
        part = (self.names >> np.uint64(32)).astype(np.int64)
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(part))):
            yield int(part[a]), slice(a, b)

    def many(self):
        """Whether an entry's anchor occurs in two documents of this block."""
        low, high = np.full(len(self.names), len(self.ids)), np.full(len(self.names), -1)
        np.minimum.at(low, self.entry, self.doc)
        np.maximum.at(high, self.entry, self.doc)
        return high > low

    def flags(self, answers):
        """Shared and hot flags of the entries, from the owners' answers."""
        shared, hot = np.zeros(len(self.names), dtype=bool), np.zeros(len(self.names), dtype=bool)
        by = {a["part"]: a["bits"] for a in answers}
        for part, at in self.owners():
            if (bits := by.get(part)) is not None:
                both = np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[: 2 * (at.stop - at.start)].astype(bool)
                shared[at], hot[at] = both[: len(both) // 2], both[len(both) // 2:]
        return shared, hot

    def segments(self, shared, hot):
        """Occurrences of shared anchors: first and last window, anchor, document, owner."""
        use = shared[self.entry]
        hot = hot[self.entry[use]]
        first, last, pos, doc = (x[use] for x in (self.first, self.last, self.pos, self.doc))
        part = (self.names[self.entry[use]] >> np.uint64(32)).astype(np.int64)
        n = (last - first + 1)[hot]
        one = np.repeat(first[hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if len(one):
            own = (mix(range_hash(self.prefix, one, one + self.window) + np.uint64(5)) % np.uint64(self.parts)).astype(np.int64)
            first, last = np.append(first[~hot], one), np.append(last[~hot], one)
            pos, doc = np.append(pos[~hot], np.repeat(pos[hot], n)), np.append(doc[~hot], np.repeat(doc[hot], n))
            part = np.append(part[~hot], own)
        return first, last, pos, doc, part

    def distinct(self, first, last, pos, doc, part):
        """Per owner: the distinct segments' sample occurrence and smallest id, and which occurrence has which."""
        if not len(first):
            return
        key = mix(range_hash(self.prefix, first, last + self.window) + (pos - first).astype(np.uint64))
        order = np.lexsort((self.ids[doc], key, part))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (part[order][1:] != part[order][:-1])
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        sample = order[new]                                # the smallest id comes first
        cut = np.flatnonzero(np.diff(part[sample], prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(sample))):
            yield int(part[sample[a]]), slice(a, b), sample, which


def column_wise(symbols: np.ndarray, first: np.ndarray, last: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """Bit c of row i: the window from column c of segment i also starts in one with a smaller id.

    ``symbols`` holds one segment per row in columns first .. last (inclusive).  Columns are taken
    from the right.  ``order`` sorts the suffixes that start in the column before; ``lcp[k]`` is the
    common prefix of the suffixes k - 1 and k.  A round reads the transform ``bwt`` (the symbols in
    front of those suffixes), which alone decides where the longer suffixes go.
    """
    found = np.zeros(len(symbols), dtype=np.uint32)
    order, lcp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    for col in range(symbols.shape[1] - 1, -1, -1):
        entering = np.flatnonzero(last == col)                           # empty suffixes, before all others
        order = np.concatenate([entering, order])
        lcp = np.concatenate([np.zeros(len(entering), dtype=np.uint8), lcp])
        stay = np.flatnonzero(first[order] <= col)
        if not len(stay):
            order, lcp = order[stay], lcp[stay]
            continue
        bwt = symbols[order[stay], col]
        place = stay[np.argsort(bwt, kind="stable")]
        sym = symbols[order[place], col]
        fresh = np.zeros(len(place), dtype=np.uint8)
        same = np.flatnonzero(sym[1:] == sym[:-1]) + 1
        if len(same):
            fresh[same] = np.minimum(_range_min(lcp, place[same - 1] + 1, place[same]) + 1, window)
        order, lcp = order[place], fresh
        if col + window <= symbols.shape[1]:
            head = lcp < window
            head[0] = True
            at = np.flatnonzero(head)
            least = np.minimum.reduceat(ids[order], at)
            hit = np.repeat(least, np.diff(np.append(at, len(order)))) < ids[order]
            found[order[hit]] |= np.uint32(1 << col)
    return found


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low .. high]) for each pair (inclusive)."""
    span = high - low + 1
    level = np.frexp(span)[1] - 1                          # floor(log2(span))
    out = np.empty(len(low), dtype=values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[low[at]], table[high[at] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


def _shared(parts_key, group: pd.DataFrame, hot_blocks: int) -> pd.DataFrame:
    """Which anchors occur in several documents (in two blocks, or twice in one), and which in very many blocks."""
    names = [np.frombuffer(v, dtype=np.uint32) for v in group["names"]]
    many = [np.unpackbits(np.frombuffer(v, dtype=np.uint8))[: len(x)].astype(bool) for v, x in zip(group["many"], names)]
    every = np.concatenate(names)
    _, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
    twice = np.zeros(len(count), dtype=bool)
    twice[inverse[np.concatenate(many)]] = True
    shared, hot = ((count > 1) | twice)[inverse], (count >= hot_blocks)[inverse]
    ends = np.cumsum([len(x) for x in names])
    bits = [np.packbits(np.concatenate([shared[e - len(x): e], hot[e - len(x): e]])).tobytes() for e, x in zip(ends, names)]
    return pd.DataFrame({"block": group["block"], "part": group["part"], "bits": bits})


def _settle(key, group: pd.DataFrame, window: int, gram: int) -> pd.DataFrame:
    """Runs the column-wise construction over the segments of one owner."""
    reach = window - gram
    width = reach + window
    inflate = zstandard.ZstdDecompressor()
    mats, ids = [], []
    for raw, n, size in zip(group["segments"], group["n"], group["n_bytes"]):
        got = inflate.decompress(raw, max_output_size=int(size))
        ids.append(np.frombuffer(got, dtype=np.int64, count=n))
        off = np.frombuffer(got, dtype=np.uint8, count=n, offset=8 * n).astype(np.int64)
        span = np.frombuffer(got, dtype=np.uint8, count=n, offset=9 * n).astype(np.int64)
        text = np.frombuffer(got, dtype=np.uint8, offset=10 * n)
        mat = np.zeros((n, width + 2), dtype=np.uint8)
        begin = reach - off
        row = np.repeat(np.arange(n), span)
        col = np.arange(len(text)) - np.repeat(np.cumsum(span) - span, span) + np.repeat(begin, span)
        mat[row, col] = text
        mat[:, width], mat[:, width + 1] = begin, begin + span - 1
        mats.append(mat)
    every, every_ids = np.concatenate(mats), np.concatenate(ids)
    # equal segments of different blocks become one; those of one anchor stay together
    turned = np.ascontiguousarray(np.roll(every, -reach, axis=1)).view(f"V{width + 2}").ravel()
    _, sample, inverse = np.unique(turned, return_index=True, return_inverse=True)
    least = np.full(len(sample), _NO_ID, dtype=np.int64)
    np.minimum.at(least, inverse, every_ids)
    own = every[sample]
    grams = np.ascontiguousarray(own[:, reach: reach + gram]).view(f"V{gram}").ravel()
    anchor = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    bits = np.zeros(len(own), dtype=np.uint32)
    a = 0
    while a < len(own):
        k = np.searchsorted(anchor, a + CHUNK)
        b = int(anchor[k]) if k < len(anchor) else len(own)
        m = own[a:b]
        bits[a:b] = column_wise(m[:, :width], m[:, width].astype(np.int64), m[:, width + 1].astype(np.int64), least[a:b], window)
        a = b
    answer = np.where(every_ids > least[inverse], np.uint32(0xFFFFFFFF), bits[inverse] >> every[:, width].astype(np.uint32))
    press = zstandard.ZstdCompressor(level=1)
    ends = np.cumsum(group["n"].to_numpy())
    return pd.DataFrame({"block": group["block"], "part": group["part"],
                         "masks": [press.compress(answer[e - n: e].astype(np.uint32).tobytes()) for e, n in zip(ends, group["n"])]})


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES, hot_blocks: int = HOT_BLOCKS, as_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, rest) per row of ``docs``.

    ``kept`` are the bytes left (with ``as_text`` a text, without the parts of characters that a cut
    went through), ``rest`` the other columns as JSON.  A null text is empty.  Rows
    with equal ids are one document and don't cut one another.  Rows without an id come last: they
    are cut against all others, and cut nothing.  A document is compared with whole documents as
    they came, not with what is left of them.
    """
    assert gram <= window and window - gram < 32 and 2 * window - gram < 255
    blocks = materialise(_blocks(docs, id_col, text_col, block_bytes), "blocks")
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, -(-total // part_bytes))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                b = Block(row, parts, window, gram)
                many, low = b.many(), b.names.astype(np.uint32)
                out = [(part, row.block, low[at].tobytes(), np.packbits(many[at]).tobytes()) for part, at in b.owners()]
                yield pd.DataFrame(out, columns=["part", "block", "names", "many"])

    named = blocks.drop("rest").mapInPandas(released(name), "part long, block long, names binary, many binary")
    shared = named.groupBy("part").applyInPandas(lambda k, g: _shared(k, g, hot_blocks), "block long, part long, bits binary")
    flags = materialise(shared.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("flags")), "anchors")
    flagged = blocks.join(flags, "block", "left")

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in batch.itertuples():
                if row.flags is None:
                    continue
                b = Block(row, parts, window, gram)
                first, last, pos, doc, part = b.segments(*b.flags(row.flags))
                out = []
                for own, at, sample, _ in b.distinct(first, last, pos, doc, part):
                    s = sample[at]
                    span = last[s] - first[s] + window
                    byte = np.repeat(first[s], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
                    raw = (b.ids[doc[s]].tobytes() + (pos[s] - first[s]).astype(np.uint8).tobytes()
                           + span.astype(np.uint8).tobytes() + b.data[byte].tobytes())
                    out.append((own, row.block, len(s), len(raw), press.compress(raw)))
                yield pd.DataFrame(out, columns=["part", "block", "n", "n_bytes", "segments"])

    sent = flagged.drop("rest").mapInPandas(released(segment), "part long, block long, n long, n_bytes long, segments binary")
    settled = sent.groupBy("part").applyInPandas(lambda k, g: _settle(k, g, window, gram), "block long, part long, masks binary")
    masks = settled.groupBy("block").agg(F.collect_list(F.struct("part", "masks")).alias("masks"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inflate = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.itertuples():
                b = Block(row, parts, window, gram)
                step = np.zeros(len(b.data) + 1, dtype=np.int32)
                if row.masks is not None:
                    first, last, pos, doc, part = b.segments(*b.flags(row.flags))
                    by = {m["part"]: m["masks"] for m in row.masks}
                    mask = np.zeros(0, dtype=np.uint32)
                    sample = which = None
                    for own, at, sample, which in b.distinct(first, last, pos, doc, part):
                        mask = np.append(mask, np.frombuffer(inflate.decompress(by[own]), dtype=np.uint32))
                    if sample is not None:
                        mine = np.where(b.ids[doc] > b.ids[doc[sample]][which], np.uint32(0xFFFFFFFF), mask[which])
                        for k in range(window - gram + 1):
                            at = first[(first + k <= last) & (mine >> np.uint32(k) & np.uint32(1)).astype(bool)] + k
                            np.add.at(step, at, 1)
                            np.add.at(step, at + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                rows = []
                for i, k, s, e, r in zip(b.ids.tolist(), b.known, b.starts, b.ends, row.rest):
                    g = gone[s:e]
                    n = int(np.count_nonzero(g))
                    spans = int(np.count_nonzero(g[1:] & ~g[:-1]) + g[0]) if n else 0
                    left = b.data[s:e][~g].tobytes()
                    rows.append((str(i) if k else None, int(e - s), n, spans, left.decode("utf-8", "ignore") if as_text else left, r))
                yield pd.DataFrame(rows, columns=["i", "n_bytes", "n_removed", "n_spans", "kept", "rest"])

    out = flagged.join(masks, "block", "left").mapInPandas(
        released(cut), f"i string, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}, rest string")
    return out.select(F.col("i").cast("long").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept", "rest")
