"""The corpus pipeline on a small corpus with planted cases, each stage against brute force."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_minhash import brute as brute_near
from tests.llm.test_packing_mixing import fill
from tests.llm.test_suffix_dedup import LAST

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghilmnoprstu") for _ in range(rnd.randrange(2, 9))) for _ in range(900)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    rows, toxic = [], {}
    passage = say(60)
    for i in range(240):
        text = say(rnd.randrange(30, 200))
        if i % 6 == 0:
            text += " you stupid grumbling idiot " + say(5)
        elif i % 7 == 0:
            text = say(20) + " " + passage + " " + say(20)
        elif i % 10 == 3:
            rows.append((1000 + i, " ".join(text.split()[:-1] + ["changed"])))
            rows.append((2000 + i, text))
        toxic[i] = int(i % 6 == 0)
        rows.append((i, text))
    rows += [(5000, None), (5001, ""), (None, say(50)), (None, None), (5002, "é " + "x" * 200), (1, rows[1][1])]
    docs = [(i, t, "en", rnd.choice(["a", "b", None] + ["hot"] * 6), len(t or "")) for i, t in rows]
    return docs, [(i, 1, y) for i, y in toxic.items() if i % 9]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    d = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus()
    spark.createDataFrame(docs, COLUMNS).repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    out, df = [], spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, df, d).write.parquet(f"{d}/{name}")
        after = spark.read.parquet(f"{d}/{name}")
        out.append((name, df.columns, [tuple(r) for r in df.collect()], after.columns, [tuple(r) for r in after.collect()]))
        df = after
    return {name: rest for name, *rest in out}, d


def test_columns(stages):
    for name, (_, _, columns, _) in stages[0].items():
        if name != "best_fit_packing":
            assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxic_documents_go(stages):
    _, before, _, after = stages[0]["toxicity"]
    gone = Counter(before) - Counter(after)
    assert {r[0] for r in gone} == {i for i in range(240) if i % 6 == 0}
    assert not Counter(after) - Counter(before)


def test_one_of_each_group_stays(stages):
    _, before, _, after = stages[0]["near_dedup"]
    kept = {i for i, (_, _, k) in brute_near([(i, t) for i, t, *_ in before if i is not None], 5, 80).items() if k}
    assert sorted(r[0] for r in after if r[0] is not None) == sorted(kept) and len(kept) < len({r[0] for r in before})
    assert sum(r[0] is None for r in after) == sum(r[0] is None for r in before)
    assert set(after) <= set(before)


def test_repeated_passages_are_cut(stages):
    _, before, _, after = stages[0]["suffix_array_dedup"]
    first = {}
    for i, t, *_ in before:
        b, k = (t or "").encode(), LAST if i is None else i
        for j in range(len(b) - 49):
            first[b[j:j + 50]] = min(k, first.get(b[j:j + 50], LAST))
    want = []
    for i, t, lang, source, _ in before:
        b, k = (t or "").encode(), LAST if i is None else i
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < k:
                gone[j:j + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        want.append((i, left, lang, source, len(left)))
    assert Counter(want) == Counter(after) and any(len(w[1]) < len(b[1] or "") for w, b in zip(want, before))


def test_sources_are_mixed(stages):
    _, before, _, after = stages[0]["source_mixing"]
    size, taken = Counter(), Counter()
    for r in before:
        size[r[3]] += len((r[1] or "").split())
    largest = Counter()
    for r in before:
        largest[r[3]] = max(largest[r[3]], len((r[1] or "").split()))
    for r in after:
        taken[r[3]] += len((r[1] or "").split())
    want = fill({s: size[s] for s in {r[3] for r in before}}, 3)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    times = Counter((r[0], r[1]) for r in after)
    assert max(times.values()) <= 3
    assert {r[:2] for r in after} <= {r[:2] for r in before}                # whole texts
    assert {r[:2] for r in before if not (r[1] or "").split()} <= {r[:2] for r in after}


def test_sequences(stages):
    _, before, columns, after = stages[0]["best_fit_packing"]
    rows = [dict(zip(columns, r)) for r in after]
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r[0] for r in before)
    seq = defaultdict(list)
    for r in rows:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seq.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(seq) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_columns_of_any_name_and_ties(spark, tmp_path):
    """Extra columns named like the operators' own, repeated rows, several texts of an id: no stage but packing changes a column."""
    rnd = random.Random(1)
    say = lambda n: " ".join(rnd.choice("abcdefghijklmnop") * rnd.randrange(1, 5) for _ in range(n))
    rows = [(i, say(40)) for i in range(60)] + [(3, "other text of three"), (3, "other text of three"), (4, None), (None, "x"), (None, "x")]
    names = "doc_id long, text string, lang string, source string, n_chars long, doc string, score double, predicted int, spans string, rep long, size int, row string, " \
            "n_words int, rest string, block int, t string, i string"
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "d", 0.5, 1, "sp", 7, 1, "r", 2, "re", 1, "t", "i") for i, t in rows], names).repartition(3)
    spark.createDataFrame([(i, 0, i % 2) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, str(tmp_path))
        assert after.columns == df.columns, name
        first, again = (Counter(map(str, x.collect())) for x in (after, stage(spark, df.repartition(5), str(tmp_path))))
        assert first == again, name
    assert stage(spark, df, str(tmp_path)).count() >= 60
    assert corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count() == len(rows)


def test_run_is_the_stages_and_works_on_nothing(spark, stages, tmp_path):
    got = corpus_pipeline.run(spark, stages[1])
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    _, _, columns, after = stages[0]["best_fit_packing"]
    assert Counter(map(tuple, got.select(cols).collect())) == Counter(tuple(r[columns.index(c)] for c in cols) for r in after)
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
