"""MinHash near-duplicate detection on word shingles.

Method: one permutation hashing (one hash per shingle, the smallest value of each of ``k`` bins),
optimal densification (every empty bin borrows from a bin drawn independently for it), banded
buckets, and star-shaped candidate edges: a bucket of n texts makes n - 1 candidate pairs, each to
its most central member, the one whose own buckets hold the most.  Copies of a text collapse before
that.  Every candidate is confirmed on the full shingle sets.

A star can miss a link of a member that is unlike the centre.  Such a member is loose: it is then
compared with all members of the other components that its buckets hold, on the full sets again,
inside tasks that hold a bounded part of a component and stream the loose members past it, so no
pair becomes a row.  So every two texts that share a bucket are linked, in one component already,
or were compared.  Nothing is ruled out by estimates; what remains is the banding itself: a pair at
0.8 shares no bucket with probability (1 - 0.8^8)^56 < 4e-5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import hot_rows, join_groups, materialise, mix, released, shingle_set

# A pair at 0.8 shares a bucket with probability 1 - (1 - 0.8^8)^56 > 0.99996, one at 0.05 (chance
# similarity of unrelated texts, of which pairs grow with the square of the corpus) with 2e-9.
BANDS, ROWS = 56, 8
BESIDE = 100_000               # ids that the scan for shingle sets gets by broadcast at most, counted first; more are joined by a shuffle
CHUNK = 1 << 20                # shingles of a component that a task holds at a time, on average


def _probe_order(k: int) -> np.ndarray:
    """For each bin an independent order in which it looks for a bin to borrow from."""
    rng = np.random.default_rng(7)
    return np.stack([rng.permutation(k) for _ in range(k)])


def signature(shingles: np.ndarray, k: int, probes: np.ndarray) -> np.ndarray:
    """One value per bin from one hash per shingle (sorted, distinct, not empty)."""
    width = np.uint64((1 << 64) // k + 1)
    bins = (shingles // width).astype(np.int64)
    first = np.searchsorted(bins, np.arange(k))
    full = first < len(bins)
    full[full] = bins[first[full]] == np.flatnonzero(full)
    source = np.arange(k)
    empty = np.flatnonzero(~full)
    for low, high in ((0, 12), (12, k)):                   # most bins find one within a few probes
        if not len(empty):
            break
        there = full[probes[empty, low:high]]
        at = np.argmax(there, axis=1)
        found = there[np.arange(len(empty)), at]
        source[empty[found]] = probes[empty[found], low + at[found]]
        empty = empty[~found]
    return shingles[first[source]]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(bands, rows)
    h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        h = mix(h ^ parts[:, i]) + np.uint64(i)
    return h


def sign(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): d1, d2 are a 128-bit digest of the whole set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        probes = _probe_order(bands * rows)
        for b in batches:
            out = []
            for i, t in zip(b["i"], b["t"]):
                s = shingle_set(t, words)
                if len(s):
                    sig = signature(s, bands * rows, probes)
                    keys = band_keys(sig, bands, rows).astype(np.int64)
                    d1 = int(np.bitwise_xor.reduce(mix(s + np.uint64(1))).astype(np.int64))
                    d2 = int(np.add.reduce(mix(s ^ np.uint64(0x5BD1E995))).astype(np.int64))
                    out.append((i, len(s), d1, d2, keys))
                else:
                    out.append((i, 0, 0, 0, None))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "d1", "d2", "bands"]).astype({"doc_id": "Int64"})

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInPandas(
        released(run), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(doc, shingles) of (doc, t): the set as bytes of its sorted hashes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "shingles": [shingle_set(t, words).tobytes() for t in b["t"]]})

    return texts.select("doc", "t").mapInPandas(released(run), "doc long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |A & B| >= percent * |A | B|, compared on full sets.

    Pairs are gathered by ``a``; one with very many partners is split over several tasks, each of
    which reads that set once and streams the partners past it, so memory holds two sets.
    """
    least = hot_rows(pairs.count())
    hot = pairs.groupBy("a").count().where(F.col("count") >= least)
    cut = (pairs.join(F.broadcast(hot), "a", "left")
           .withColumn("chunk", F.when(F.col("count").isNull(), F.lit(0)).otherwise(
               F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / least))).cast("long")))
    roles = (cut.select(F.col("b").alias("doc"), "a", "chunk", F.lit(1).alias("role"))
             .unionByName(cut.select(F.col("a").alias("doc"), "a", "chunk", F.lit(0).alias("role")).distinct()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre, owns = None, []
        for b in batches:
            found = []
            for doc, a, chunk, role, raw in zip(b["doc"], b["a"], b["chunk"], b["role"], b["shingles"]):
                s = np.frombuffer(raw, dtype=np.uint64)
                if role == 0:
                    if centre != (a, chunk):
                        centre, owns = (a, chunk), []
                    owns.append(s)                         # several only where an id has several texts
                    continue
                for own in owns:
                    small, large = (own, s) if len(own) < len(s) else (s, own)
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int(np.count_nonzero(large[at] == small))
                    if 100 * both >= percent * (len(own) + len(s) - both):
                        found.append((a, doc))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (roles.join(sets, "doc").repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role")
            .mapInPandas(released(run), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(doc, label): the smallest document reachable, for every document with an edge (a, b).

    Labels spread along edges and jump to their label's label; each round is a written table and
    nothing is gathered.  Many labels meet the edges in joins of shuffled tables, which adaptive
    execution splits where a document has very many edges.
    """
    both = materialise(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = materialise(both.groupBy(F.col("u").alias("doc")).agg(F.min("v").alias("m"))
                         .select("doc", F.least("doc", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("doc").alias("u"), F.col("label").alias("l")), "u")
                .groupBy(F.col("v").alias("doc")).agg(F.min("l").alias("near")))
        jump = labels.select(F.col("doc").alias("near"), F.col("label").alias("jump"))
        step = (near.join(labels, "doc").withColumn("near", F.least("label", "near")).join(jump, "near")
                .select("doc", F.least("near", "jump").alias("label"), F.col("label").alias("old")))
        labels = materialise(step, "labels")
        if labels.where("old <> label").isEmpty():
            return labels.select("doc", "label")


def _labelled(rows: DataFrame, labels: DataFrame, doc: str, name: str) -> DataFrame:
    """``rows`` with the label of ``doc`` as ``name``; a document without a label is its own."""
    known = labels.select(F.col("doc").alias(doc), F.col("label").alias(name))
    return rows.join(known, doc, "left").withColumn(name, F.coalesce(name, doc))


def settle(asks: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the documents of ``asks`` (doc, n, component) and the members (doc, n, component) of those components.

    Members are cut into classes of like size, of which a document meets its own and the two beside
    it, and classes into chunks of about CHUNK shingles.  A chunk is held in one sorted array; each
    document asked for counts its shingles there member by member.  One link to a chunk is enough:
    a component's members are connected already.
    """
    step = math.log(100 / percent)
    of = (F.floor(F.log(F.col("n")) / step) if step > 0 else F.col("n")).cast("long")
    held = members.withColumn("size", of)
    chunks = held.groupBy("component", "size").agg(F.ceil(F.sum("n") / CHUNK).alias("chunks"), F.count("*").alias("n_members"))
    total = members.count()
    inside = join_groups(held, chunks, ["component", "size"], "n_members", total, "inner").select(
        "doc", "component", "size", F.pmod(F.xxhash64("doc"), "chunks").alias("chunk"), F.lit(0).alias("role"))
    # only classes that a component has: a component has few, most have one
    near = F.abs(F.col("own") - F.col("size")) <= (1 if step > 0 else 0)
    asked = (asks.withColumn("own", of).join(chunks, "component").where(near)
             .select("doc", "component", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("role")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, own, docs, table = None, [], [], None
        for b in batches:
            found = []
            for doc, *at, role, raw in zip(b["doc"], b["component"], b["size"], b["chunk"], b["role"], b["shingles"]):
                s = np.frombuffer(raw, dtype=np.uint64)
                if tuple(at) != key:
                    key, own, docs, table = tuple(at), [], [], None
                if role == 0:
                    own.append(s)
                    docs.append(doc)
                    continue
                if not own:                                # a chunk that no member's hash fell into
                    continue
                if table is None:
                    value, who = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
                    order = np.argsort(value, kind="stable")
                    table = value[order], who[order], np.array([len(x) for x in own])
                value, who, size = table
                low, high = np.searchsorted(value, s, "left"), np.searchsorted(value, s, "right")
                n = high - low
                place = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                both = np.bincount(who[place], minlength=len(size))
                hit = np.flatnonzero(100 * both >= percent * (len(s) + size - both))
                if len(hit):
                    found.append((doc, docs[hit[0]]))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rows = inside.unionByName(asked).join(sets, "doc")
    keys = ["component", "size", "chunk"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "role").select("doc", *keys, "role", "shingles").mapInPandas(released(run), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Two texts are linked when 100 * intersection >= percent * union of their sets of ``words``-word
    shingles (A-Z lower-cased; fewer words: the whole text is one shingle).  ``component_id`` is the
    smallest doc_id reachable over links, itself included; ``kept`` marks that document.

    Null or blank texts have no shingles and link with nothing.  Rows with equal ids are one
    document (each row is returned).  A null id cannot be named as a copy: such a row has a null
    component and is kept.  Extra columns are ignored; empty tables give no rows.
    """
    signed = materialise(sign(docs, words, bands, rows, id_col, text_col), "signed")
    live = signed.where("n_shingles > 0 and doc_id is not null")
    # Equal sets collapse first: a group of copies costs one row from here on.
    groups = materialise(live.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_rows"),
                                                      F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "groups")
    member = groups.select("rep", F.explode("bands").alias("bucket"))
    bucket = materialise(member.groupBy("bucket").agg(F.count("*").alias("n_in")).where("n_in > 1"), "buckets")
    # one row per bucket on the right: adaptive execution splits a bucket that holds very many members
    shared = materialise(member.join(bucket, "bucket"), "shared")
    # the centre of a bucket: the member whose buckets hold the most
    weight = shared.groupBy("rep").agg(F.sum("n_in").alias("weight"))
    ranked = materialise(shared.join(weight.join(groups.select("rep", "n"), "rep"), "rep"), "ranked")
    centre = ranked.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("least"), F.col("n"))).alias("c"), F.first("n_in").alias("n_in"))
    centre = centre.select("bucket", "n_in", (-F.col("c.least")).alias("centre"), F.col("c.n").alias("n_centre"))
    stars = materialise(join_groups(ranked.drop("n_in", "weight"), centre, ["bucket"], "n_in", ranked.count(), "inner"), "stars")
    fits = F.expr(f"rep <> centre and 100 * least(n, n_centre) >= {percent} * greatest(n, n_centre)")     # sizes alone rule out the others

    asked = materialise(stars.where(fits | (F.col("n_in") > 2)).select(F.col("rep").alias("doc"))
                        .unionByName(stars.where(fits).select(F.col("centre").alias("doc"))).distinct(), "asked")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("t"))
    sets = materialise(_sets(texts.join(F.broadcast(asked) if asked.count() <= BESIDE else asked, "doc", "left_semi"), words), "sets")
    pairs = materialise(stars.where(fits).select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = materialise(confirm(pairs, sets, percent), "links")
    labels = components(links)

    # a loose member is not in its centre's component; it asks the other components of its buckets
    named = _labelled(_labelled(stars.where("n_in > 2").drop("n_centre"), labels, "rep", "own"), labels, "centre", "main")
    named = materialise(named.select("bucket", "rep", "n", "own", "main"), "named")
    loose = named.where("own <> main")
    others = loose.select("bucket", F.col("own").alias("component")).distinct()
    asks = loose.join(others, "bucket").where("own < component").select(F.col("rep").alias("doc"), "n", "component").unionByName(
        loose.select(F.col("rep").alias("doc"), "n", F.col("main").alias("component"))).distinct()
    asks = materialise(asks, "asks")
    if not asks.isEmpty():
        wanted = asks.groupBy("component").agg(F.count("*").alias("n_asks"))
        members = _labelled(groups.select(F.col("rep").alias("doc"), "n"), labels, "doc", "component").join(wanted, "component").drop("n_asks")
        # only documents with a bucket of three or more, whose sets are at hand
        members = members.join(sets.select("doc").distinct(), "doc", "left_semi")
        more = materialise(settle(asks, members, sets, percent), "links")
        if not more.isEmpty():
            known = labels.where("doc <> label").select(F.col("label").alias("a"), F.col("doc").alias("b"))
            labels = components(known.unionByName(more))

    found = _labelled(groups, labels, "rep", "component").select("d1", "d2", "component", "n_rows")
    rows_out = join_groups(live.select("doc_id", "n_shingles", "d1", "d2"), found, ["d1", "d2"], "n_rows", live.count(), "left")
    none = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    out = rows_out.select("doc_id", "n_shingles", "component").unionByName(none)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))
