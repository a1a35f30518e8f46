"""Conversation prefix trie, summed up by centroid decomposition.

Every conversation is rebuilt from the first turns of another one and its own later turns.  A node of the trie is
a distinct sequence of first turns; it is told by its depth and 128 bits that are the XOR, over its turns, of a hash
of (place, turn).  Running places and XORs are made in two levels: rows are range-partitioned by conversation
and place, each task scans its rows in order, and at most one conversation per partition began before it, so that
what carries over is a row per partition.  No conversation has to fit a task.

Sums over subtrees come from the centroid decomposition of the forest of parent edges.  Each component
has a top and a weight; its centroid is the deepest node with at least half the weight below it, and the nodes
above it on the way to the top are just those that have as much.  Taking the centroid out leaves a component for
each of its children and one above it, none with more than half the weight.  What the centroid had below it in its
component is totalled and added to all nodes from the centroid to the top: whatever the shape of the
forest, a node gets at most one addition per halving.  Components of more than ``bound`` weight are split by joins and
aggregations, a round for all of them at once; the others are split further inside tasks, each a component at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import join_groups, materialise
from snapledger.llm.mixing import n_words

SHARED, STEP = 4, 20           # a conversation takes crc32(id) % SHARED turns of conversation id - id % STEP
BOUND = 20_000                 # weight, and so nodes at most, of a component that one task splits further
CHUNK_BITS = 12                # ids in a chunk of a digest's text: 2^12


def running(rows: DataFrame, key: str, order: list[str], xors: list[str], name: str) -> DataFrame:
    """``rows`` (written) with ``at``, the place among the rows of its ``key`` from 1, and each of ``xors`` as the XOR so far."""
    kept = [f.name for f in rows.schema]
    more = ["part", "at", *(f"{x}_run" for x in xors)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count, sofar = TaskContext.get().partitionId(), None, 0, [0] * len(xors)
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(kept.index(key)).to_numpy()
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            start = np.repeat(first, np.diff(np.append(first, len(k))))
            at = np.arange(len(k)) - start + 1
            again = (start == 0) & (k[0] == last)                # the group that the batch before it left open
            at[again] += count
            runs = []
            for n, x in enumerate(xors):
                total = np.append(0, np.bitwise_xor.accumulate(b.column(kept.index(x)).to_numpy()))
                r = total[1:] ^ total[start]
                r[again] ^= sofar[n]
                runs.append(r)
            last, count, sofar = k[-1], at[-1], [r[-1] for r in runs]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(k), part)), pa.array(at), *map(pa.array, runs)], names=kept + more)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"`{c}` long" for c in more)])
    dealt = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    found = materialise(dealt.mapInArrow(run, schema), name)
    # only the first and the last key of a partition can go on in another one: two rows a partition
    edges = found.groupBy("part").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    over = edges.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    ends = found.join(F.broadcast(over), key).groupBy(key, "part").agg(F.max("at").alias("n"), *(F.bit_xor(x).alias(x) for x in xors))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(key, "part", F.sum("n").over(before).alias("n_before"), *(F.bit_xor(x).over(before).alias(f"{x}_before") for x in xors)).where(
        "n_before is not null")
    fixed = found.join(F.broadcast(carry), [key, "part"], "left")
    return fixed.select(*[c for c in kept if c not in xors], (F.col("at") + F.coalesce("n_before", F.lit(0))).alias("at"), *(F.col(x).alias(f"{x}_own") for x in xors), *(
        F.col(f"{x}_run").bitwiseXOR(F.coalesce(f"{x}_before", F.lit(0))).alias(x) for x in xors))


def rebuilt(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            shared: int = SHARED, step: int = STEP) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, depth, len, words, h1, h2) of the rebuilt conversations, and the conversations (conv_id, len)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    told = materialise(talks.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), key.alias("key"), n_words(text).alias("words"),
        F.monotonically_increasing_id().alias("row")), "trie-told")
    placed = running(told, "conv_id", ["turn", "key", "row"], [], "trie-placed").select("conv_id", "at", "key", "words")
    takes = F.crc32(F.col("conv_id").cast("string")) % shared
    heads = materialise(placed.where((F.col("conv_id") % step == 0) & (F.col("at") < shared)), "trie-heads").withColumnRenamed("conv_id", "base")
    talk = placed.groupBy("conv_id").agg(F.max("at").alias("size")).withColumn("takes", takes).withColumn("base", F.col("conv_id") - F.col("conv_id") % step)
    talk = talk.join(heads.groupBy("base").agg(F.count("*").alias("there")), "base", "left").withColumn(
        "led", F.least("takes", F.coalesce("there", F.lit(0))))
    talk = materialise(talk.withColumn("len", F.col("led") + F.greatest(F.lit(0), F.col("size") - F.col("takes"))), "trie-talks")
    led = talk.join(heads, "base").where("at <= takes").select("conv_id", F.col("at").alias("depth"), "len", "words", "key")
    own = join_groups(placed.where(F.col("at") > takes), talk.select("conv_id", "size", "takes", "led", "len"), ["conv_id"], "size",
                      told.count(), "inner").select("conv_id", (F.col("at") - F.col("takes") + F.col("led")).alias("depth"), "len", "words", "key")
    steps = led.unionByName(own).select("conv_id", "depth", "len", "words", F.xxhash64("key", "depth").alias("h1"),
                                        F.xxhash64("depth", "key", F.lit("second")).alias("h2"))
    return materialise(steps, "trie-steps"), talk.select("conv_id", "len")


def trie(steps: DataFrame, talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and the ``steps`` with their running XORs.

    A node is (conv_id, depth): the smallest conversation that starts with it, and its depth; with parent_conv_id,
    n_convs, n_children, words of its last turn, weight (turns of its members from here on) and its XORs h1, h2.
    """
    run = running(steps, "conv_id", ["depth"], ["h1", "h2"], "trie-run").drop("at")
    one = run.groupBy("depth", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
        F.min(F.col("h1").bitwiseXOR(F.col("h1_own"))).alias("up1"), F.min(F.col("h2").bitwiseXOR(F.col("h2_own"))).alias("up2"))
    one = materialise(one, "trie-distinct")
    kids = one.groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("h1"), F.col("up2").alias("h2")).agg(F.count("*").alias("n_children"))
    zero = F.lit(0).cast("long")
    root = talks.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "conv_id", "n_convs", zero.alias("words"), "weight",
                       F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"))
    full = one.unionByName(root).join(kids, ["depth", "h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    full = materialise(full, "trie-full")
    above = full.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("up1"), F.col("h2").alias("up2"),
                        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("size"))
    below = join_groups(full.where("depth > 0"), above, ["depth", "up1", "up2"], "size", full.count(), "inner").drop("size")
    top = full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return materialise(below.unionByName(top).drop("up1", "up2"), "trie-nodes"), run


def _sum_component(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums over subtrees of one component, its nodes by depth (the top first), by centroid decomposition."""
    out = [[0] * len(parent) for _ in values]
    size, child = [0] * len(parent), [-1] * len(parent)
    open_parts = [list(range(len(parent)))]
    while open_parts:
        part = open_parts.pop()
        top = part[0]
        for i in part:
            size[i], child[i] = 1, -1
        for i in reversed(part):
            if i != top:
                size[parent[i]] += size[i]
        centroid = next(i for i in reversed(part) if 2 * size[i] >= len(part))
        above, under = [], {}
        for i in part:                                          # parents come first
            if i == centroid:
                continue
            if i != top and (parent[i] == centroid or child[parent[i]] >= 0):
                child[i] = i if parent[i] == centroid else child[parent[i]]
                under.setdefault(child[i], []).append(i)
            else:
                above.append(i)
        for value, total in zip(values, out):
            s = value[centroid] + sum(value[i] for p in under.values() for i in p)
            at = centroid
            while True:
                total[at] += s
                if at == top:
                    break
                at = parent[at]
        open_parts += ([above] if above else []) + list(under.values())
    return out


def _inside(parts: DataFrame, values: list[str]) -> DataFrame:
    """(conv_id, depth, *values) summed over subtrees within each component (top_conv, top_depth) of bounded size."""
    names = ["top_conv", "top_depth", "depth", "conv_id", "parent_conv_id", *values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(rows: list[tuple]) -> list[tuple]:
            at = {(r[3], r[2]): n for n, r in enumerate(rows)}
            parent = [at.get((r[4], r[2] - 1), -1) for r in rows]
            sums = _sum_component(parent, [[r[5 + n] for r in rows] for n in range(len(values))])
            return [(r[3], r[2], *s) for r, s in zip(rows, zip(*sums))]

        part, out = [], []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if part and row[:2] != part[0][:2]:
                    out += summed(part)
                    part = []
                part.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["conv_id", "depth", *values])
                out = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*summed(part))], names=["conv_id", "depth", *values])

    return (parts.select(*names).repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", "depth", "conv_id")
            .mapInArrow(run, ", ".join(f"`{c}` long" for c in ["conv_id", "depth", *values])))


def subtree_sums(nodes: DataFrame, places: DataFrame, values: list[str], bound: int = BOUND) -> DataFrame:
    """(conv_id, depth, *values): each value summed over the subtree of each node.

    ``nodes`` are (conv_id, depth, parent_conv_id, weight, *values), with weight 1 or more summed over subtrees.
    ``places`` (conv_id, depth, node, parent) tell the node that a conversation passes at a depth, and its parent.
    """
    keys = ["top_conv", "top_depth"]
    top = nodes.where("parent_conv_id is null").select(F.col("conv_id").alias("top_conv"), F.col("depth").alias("top_depth"))
    live = nodes.select("conv_id", "depth", "parent_conv_id", "weight", *values).crossJoin(F.broadcast(top))     # one row: one tree to begin with
    small, added = [], []
    while True:
        parts = live.groupBy(*keys).agg(F.count("*").alias("n"), F.max("weight").alias("total"))
        told = materialise(join_groups(live, parts, keys, "n", live.count(), "inner"), "trie-parts")
        small.append(told.where(F.col("total") <= bound).drop("n", "total", "weight"))
        large = told.where(F.col("total") > bound)
        if large.isEmpty():
            break
        n_large = large.count()
        heavy = F.expr("2 * weight >= total")
        centre = large.where(heavy).groupBy(*keys).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"), F.first("n").alias("n")).select(
            *keys, F.col("c.depth").alias("c_depth"), F.col("c.conv_id").alias("c_conv"), F.col("c.weight").alias("c_weight"), "n")
        met = materialise(join_groups(large.drop("n"), centre, keys, "n", n_large, "inner"), "trie-met")
        deeper = ~heavy & (F.col("depth") > F.col("c_depth"))
        asked = met.where(deeper).groupBy("conv_id", "c_depth").agg(F.count("*").alias("m"))
        passes = asked.join(places.select("conv_id", (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("to_conv"), F.col("parent").alias("via")),
                            ["conv_id", "c_depth"])
        under = join_groups(met.where(deeper), passes, ["conv_id", "c_depth"], "m", n_large, "inner").drop("m")
        state = materialise(under.unionByName(met.where(~deeper), allowMissingColumns=True).withColumn("role", F.when(
            deeper, F.when(F.col("via") == F.col("c_conv"), F.lit("under")).otherwise(F.lit("above"))).when(
            (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth")), F.lit("centroid")).when(
            heavy, F.lit("path")).otherwise(F.lit("above"))), "trie-state")
        totals = state.where("role in ('under', 'centroid')").groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values), F.first("n").alias("n"))
        way = state.where("role in ('path', 'centroid')").select("conv_id", "depth", *keys)
        added.append(join_groups(way, totals, keys, "n", n_large, "inner").select("conv_id", "depth", *values))
        rest = state.where("role <> 'centroid'")
        is_under = F.col("role") == "under"
        live = rest.select(
            "conv_id", "depth", "parent_conv_id", F.when(F.col("role") == "path", F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            *values, F.when(is_under, F.col("to_conv")).otherwise(F.col("top_conv")).alias("top_conv"),
            F.when(is_under, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"))
    every = small[0]
    for more in small[1:]:
        every = every.unionByName(more)
    found = _inside(every, values)
    for more in added:
        found = found.unionByName(more)
    return found.groupBy("conv_id", "depth").agg(*(F.sum(v).alias(v) for v in values))


def digests(ends: DataFrame, by: list[str]) -> DataFrame:
    """(*by, ends_sha256): SHA-256 of each group's conversation ids in ascending order, joined by commas.

    Ids become texts of at most 2^CHUNK_BITS ids in the JVM.  A digest is one sequence, so the texts of a group pass
    through one task, which holds one text and the state of the digest.
    """
    texts = ends.groupBy(*by, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(
        F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, None

        def line(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1])], names=[*by, "ends_sha256"])

        for b in batches:
            done = []
            for *own, ids in zip(*(c.to_pylist() for c in b.columns)):
                if own != group:
                    if group is not None:
                        done.append((*group, state.hexdigest()))
                    group, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield line(done)
        if group is not None:
            yield line([(*group, state.hexdigest())])

    return (texts.repartition(*by).sortWithinPartitions(*by, "chunk").select(*by, "ids")
            .mapInArrow(run, ", ".join([*(f"`{c}` long" for c in by), "ends_sha256 string"])))


def prefix_trie(talks: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                bound: int = BOUND) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    Turns are in order of ``turn``, null first; equal turns in order of the MD5 of role and text.  Null roles and texts
    are empty; repeated rows are turns of their own; rows without a conversation id belong to none and are left out.
    A conversation takes the first crc32(id) % 4 turns of conversation id - id % 20 in place of as many of its own; of
    one that has none left, the root counts it among its ends.  Words of whole texts are counted.  Extra columns are
    ignored; an empty table has no members and so no nodes, not even a root.
    """
    steps, convs = rebuilt(talks, conv_col, turn_col, role_col, text_col)
    nodes, run = trie(steps, convs)
    named = nodes.select("depth", "h1", "h2", F.col("conv_id").alias("node"), F.col("parent_conv_id").alias("parent"), F.col("n_convs").alias("size"))
    places = join_groups(run.select("conv_id", "depth", "h1", "h2"), named.where("depth > 0"), ["depth", "h1", "h2"], "size", steps.count(), "inner")
    valued = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
    sums = subtree_sums(valued, places.select("conv_id", "depth", "node", "parent"), ["n_leaves", "saved_tokens"], bound)
    zero = F.lit(0).cast("long")
    ends = run.where("depth = len").select("conv_id", "depth", "h1", "h2").unionByName(
        convs.where("len = 0").select("conv_id", zero.alias("depth"), zero.alias("h1"), zero.alias("h2")))
    told = digests(ends, ["depth", "h1", "h2"])
    return (nodes.join(sums, ["conv_id", "depth"]).join(told, ["depth", "h1", "h2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


ORACLE = """
WITH k AS (SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS key,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS at FROM k),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
         list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
      )) % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
led AS (SELECT c.conv_id, t.at AS depth, t.key, t.words FROM c JOIN t ON t.conv_id = c.base AND t.at <= c.h),
n_led AS (SELECT conv_id, count(*) AS n FROM led GROUP BY 1),
s AS (SELECT * FROM led UNION ALL
      SELECT c.conv_id, t.at - c.h + coalesce(n_led.n, 0), t.key, t.words FROM c JOIN t ON t.conv_id = c.conv_id AND t.at > c.h
      LEFT JOIN n_led ON n_led.conv_id = c.conv_id),
r AS (SELECT conv_id, depth, words, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM s
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM r GROUP BY path),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children, p.conv_id AS parent_conv_id FROM n LEFT JOIN kids USING (path)
      LEFT JOIN n p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)),
u AS (SELECT a.path, count(*) FILTER (x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.words) AS saved
      FROM x JOIN r a ON a.conv_id = x.conv_id AND a.depth <= x.depth GROUP BY a.path),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ids FROM r
      JOIN (SELECT conv_id, max(depth) AS depth FROM r GROUP BY 1) USING (conv_id, depth) GROUP BY path)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, x.parent_conv_id, x.n_convs, x.n_children, u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens,
       coalesce(e.ids, sha256('')) AS ends_sha256 FROM x JOIN u USING (path) LEFT JOIN e USING (path)"""
