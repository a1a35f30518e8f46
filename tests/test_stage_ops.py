"""Two-level collapse equals the one-level collapse + geometry metrics (hot key, NULLs, repeated parts)."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapledger.operators import gates, stage
from snapledger.sources.fields import FieldSpec

FIELDS = [FieldSpec("a", "a", "string"), FieldSpec("b", "b", "bigint"), FieldSpec("t", "t", "bigint", volatile=True)]


def _sq(x, d=0.001):
    ring = [[x, 61.0], [x + d, 61.0], [x + d, 61.0 + d], [x, 61.0 + d], [x, 61.0]]
    return json.dumps({"type": "Polygon", "coordinates": [ring]})


def test_two_level_equals_one_level(spark):
    rows = []
    for i in range(300):                                    # hot key: 300 parts, repeats and NULLs
        rows.append(("hot", i % 7 + 1, None if i % 3 == 0 else f"v{i % 11}", None if i % 5 == 0 else i,
                     i, _sq(-149.0 + (i % 20) * 0.01)))
    rows += [("k2", 1, None, 5, 1, _sq(-148.0)), ("k2", 2, "x", None, 9, _sq(-148.5)),
             ("k3", 1, "only", 1, 1, None)]
    df = spark.createDataFrame(rows, "k string, part int, a string, b long, t long, g string")
    one = stage.collapse(df, "k", FIELDS, "part", "g", typed=True, collect_geometry=False)
    met = stage.geometry_metrics(df, "k", "g")
    want = one.join(met, "k", "left").select("k", "a", "b", "t", "feature_count", "n_parts",
                                             F.round("area_m2", 6).alias("area"), "xmin", "geom_hash")
    got = stage.collapse_two_level(df, "k", FIELDS, "part", "g").select(
        "k", "a", "b", "t", "feature_count", F.when(F.col("n_parts") > 0, F.col("n_parts")).alias("n_parts"),
        F.round("area_m2", 6).alias("area"), "xmin", "geom_hash")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    hot = got.filter("k = 'hot'").first()
    assert hot.feature_count == 300 and hot.n_parts == 20


def test_part_numbers_of_any_size(spark):
    rows = [("k", 1_000_000, "late", None), ("k", 999_999, "early", None), ("j", 10**12, "late", None), ("j", 7, "early", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "k string, part long, a string, b long, t long").withColumn("g", F.lit("x"))
    assert {r.a for r in stage.collapse(df, "k", FIELDS, "part", "g", typed=True, collect_geometry=False).collect()} == {"early"}


def test_broken_lines_and_bad_casts(spark, tmp_path):
    fields = [FieldSpec("A", "a", "string"), FieldSpec("B", "b", "int"), FieldSpec("D", "d", "timestamp", epoch_millis=True)]
    lines = ['{"K": "1", "A": "x", "B": "12.0"}', '{"K": "2", "A": "y", "B": "xx", "D": "soon"}', '{"K": "3", "A": ', '{"A": "no key"}', "{}"]
    (tmp_path / "p.ndjson").write_text("\n".join(lines) + "\n")
    raw = stage.read_features(spark, str(tmp_path), fields, "K", geom_src=None)
    counts, casts = Observation("counts"), Observation("casts")
    snap = stage.stage_snapshot(raw, "K", fields, None, None, "k", 2026, observation=counts, casts=casts)
    assert sorted((r.k, r.b) for r in snap.collect()) == [("1", 12), ("2", None)]
    assert counts.get == {"dropped_unkeyed": 2, "broken_lines": 1, "source_features": 5}
    assert casts.get == {"bad_casts": 2}
    gates.assert_parsed(0, 2, most_bad_casts=2)
    for args in ((counts.get["broken_lines"],), (0, casts.get["bad_casts"])):
        with pytest.raises(gates.GateError):
            gates.assert_parsed(*args)
    with pytest.raises(Exception, match="broken record"):       # nobody would be told: stop
        stage.drop_unkeyed(raw, "K").collect()
