"""License scans against the plain rules: places of phrases, and shares covered near a diagonal."""

import random
import re

from pyspark.sql import functions as F

from snapledger.llm import license_scan
from tools.oracle_check import compare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, phrases, templates, k, slack, share):
    w, places, base = words(text), [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [i for i, x in enumerate(w) if x == p[0] and w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    more, best = set(), 0.0
    for label, t in templates:
        t = words(t)
        votes, at = {}, {}
        for j in range(len(t) - k + 1):
            at.setdefault(tuple(t[j:j + k]), []).append(j)
        for i in range(len(w) - k + 1):
            for j in at.get(tuple(w[i:i + k]), ()):
                votes.setdefault(i - j, set()).update(range(j, j + k))
        for d in votes:
            covered = set().union(*(s for e, s in votes.items() if abs(e - d) <= slack))
            best = max(best, len(covered) / len(t))
            more |= {label} if len(covered) >= share * len(t) else set()
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | more)), 1.0 if places else round(best, 9))


def texts():
    rnd = random.Random(4)
    mit, gpl = license_scan.TEMPLATES[9][1], license_scan.TEMPLATES[1][1]
    assert mit.startswith("Permission") and gpl.startswith("This program")
    out = [None, "", " \n\t", "MIT\tLicense", "mit licenses", "MIT License MIT LICENSE, cc-by CC.BY cc by", "ſ MIT LiCENSE ß", "GNU general\npublic License",
           "gnu gnu general public license general public license", mit, gpl.upper(), "x " * 50 + mit.replace("free of charge, ", "") + " y" * 40]
    out.append("Licensed under CC BY-NC 4.0.\n" + gpl + "\n" + gpl.replace("either version 3", "version 3"))
    for _ in range(60):
        w = words(rnd.choice([mit, gpl])) * rnd.choice([1, 1, 2])
        for _ in range(rnd.randrange(0, 12)):
            at = rnd.randrange(len(w))
            w[at:at + rnd.randrange(0, 3)] = ["other"] * rnd.randrange(0, 3)
        out.append(" ".join(w[rnd.randrange(4):]))
    out.append(("word " * 30 + "mit license ") * 9000)             # longer than a piece
    out.append("a" * 1_500_000 + " apache license")
    return out


def test_against_plain_rules(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts())] + [(None, "cc by", "x", 1), (5, "cc by", "x", 1), (5, "cc by", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, pos int").repartition(3)
    got = license_scan.scan(df)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(((i if i is not None else -1, *brute(t, license_scan.PHRASES, license_scan.TEMPLATES, 4, 6, 0.8)) for i, t, _, _ in rows), key=repr)
    have = sorted(((r[0] if r[0] is not None else -1, *r[1:7], round(r[7], 9)) for r in got.collect()), key=repr)
    assert have == want
    assert license_scan.scan(df.where("false")).count() == 0


def test_words_moved_within_the_slack_still_cover(spark):
    template = (("own", " ".join(f"w{i}" for i in range(40))),)
    w = template[0][1].split()
    near = " ".join(w[:20] + ["x"] * 5 + w[20:])                   # one part is 5 words off: both diagonals count
    far = " ".join(w[:20] + ["x"] * 50 + w[20:])
    df = spark.createDataFrame([(1, near), (2, far)], "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], round(r["score"], 3)) for r in license_scan.scan(df, {}, template).collect()}
    assert got == {1: ("own", 1.0), 2: ("", 0.5)}
    _, found = license_scan.hits(df, {}, template)
    spans = {(r["row"], r["diagonal"], r["start"], r["end"]) for r in license_scan.spans(found).collect()}
    assert {s[1:] for s in spans} == {(0, 0, 45), (5, 0, 45), (0, 0, 20), (50, 70, 90)}


def test_names_of_columns_and_sql(spark):
    df = spark.createDataFrame([(1, "MIT license")], "key long, body string")
    assert license_scan.scan(df, id_col="key", text_col="body").select(F.col("labels")).first()[0] == "mit"
    assert compare(spark, "/root/testdata/sf0.001", ["op11_license_scan"])["op11_license_scan"][0] == "match"
