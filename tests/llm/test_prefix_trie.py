"""The conversation trie against a plain one, for several bounds of what one task sums up."""

import hashlib
import random
import re
import zlib

import pytest

from snapledger.llm import prefix_trie
from tools.oracle_check import compare

SCHEMA = "conv_id long, turn int, role string, text string, depth string, h1 long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    talks = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            talks.setdefault(c, []).append((turn is not None, turn or 0, key, text or ""))
    talks = {c: [(k, len(WORD.findall(t))) for _, _, k, t in sorted(x)] for c, x in talks.items()}
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = tuple(talks.get(base, [])[:h] + own[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * (p[-1][1] if p else 0)
    ends = {p: ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p)))) for p, m in nodes.items()}
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in nodes.items())


def given():
    rnd = random.Random(3)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "hello there" if t == 0 and rnd.random() < 0.6 else f"w {rnd.randrange(3)} " * rnd.randrange(1, 4))
            for c in range(-30, 130) if c % 40 != 20 for t in range(rnd.randrange(1, 9))]
    rows += [(c, t, "user", f"same turn {t}") for c in range(1000, 1060) for t in range(5)]          # copies of one conversation
    rows += [(c, t, "user", f"chain {t}" if t < 60 + c % 7 else f"own {c}") for c in (2000, 2001, 2019, 2031) for t in range(150)]
    rows += [(3000, None, None, None), (3000, None, "user", "b"), (3000, 1, "user", "a"), (3000, 1, "user", "a"), (3000, 1, "assistant", None),
             (3001, 5, "", ""), (3002, 5, None, ""), (None, 1, "user", "x"), (3003, 1, "u", "ser"), (3004, 1, "us", "er"), (3005, 0, "user", "long " * 60000)]
    return [(*r, "clash", 5) for r in rows]


@pytest.mark.parametrize("bound", [1, 40, prefix_trie.BOUND])
def test_against_plain_trie(spark, bound):
    rows = given()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(df, bound=bound)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    have = sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())
    want = brute(rows)
    assert have == want


def test_sums_of_a_component():
    rnd = random.Random(8)
    for n in (1, 2, 3, 10, 200):
        parent = [-1] + [rnd.randrange(max(0, i - 3), i) for i in range(1, n)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        order = sorted(range(n), key=lambda i: depth[i])
        at = {i: k for k, i in enumerate(order)}
        up = [at.get(parent[i], -1) for i in order]
        values = [[rnd.randrange(100) for _ in range(n)] for _ in range(2)]
        want = [list(v) for v in values]
        for v in want:
            for i in range(n - 1, 0, -1):
                v[up[i]] += v[i]
        assert prefix_trie._sum_component(up, values) == want


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)      # its one turn is replaced by none
    got = [tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame([(alone, 0, "user", "hi", None, None)], SCHEMA)).collect()]
    assert got == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_digest_of_many_chunks(spark):
    ids = list(range(-5000, 20000, 3))
    df = spark.createDataFrame([(i, 1) for i in ids] + [(7, 2)], "conv_id long, g long").repartition(7)
    got = {r["g"]: r["ends_sha256"] for r in prefix_trie.digests(df, ["g"]).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"7").hexdigest()}


def test_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", ["op13_prefix_trie"])["op13_prefix_trie"][0] == "match"
