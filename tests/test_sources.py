"""Sources and catalog helpers: GeoJSON FeatureCollection flattening, views, JSON SQL, describe."""

import json

from pyspark.sql import functions as F

from snapledger.operators import stage
from snapledger.sources import store


def test_flatten_feature_collection(spark, tmp_path):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"Parcel_ID": "P1", "Owner_Name": "A"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"Parcel_ID": "P2", "Owner_Name": None}, "geometry": None}]}
    (tmp_path / "page.json").write_text(json.dumps(fc))
    rows = {r.Parcel_ID: r for r in stage.flatten_feature_collection(spark, str(tmp_path)).collect()}
    assert set(rows) == {"P1", "P2"}
    assert json.loads(rows["P1"]["__geometry"])["type"] == "Polygon"
    assert rows["P2"]["__geometry"] is None


def test_one_collection_is_many_tasks(spark, tmp_path):
    """Byte ranges of one file, with braces and quotes in strings, escapes, nested properties and members around the features."""
    odd = ['a{b', 'a}b"', '{"type": "Feature"}', "\\", '\\"{', "é{ü}", "line\nbreak {", "", "}}}{{{"]
    feats = [{"type": "Feature", "id": i, "properties": {"Parcel_ID": f"P{i}", "Note": odd[i % len(odd)], "More": {"deep": {"x": [i, "{"]}} if i % 5 == 0 else None},
              "geometry": None if i % 7 == 0 else {"type": "Polygon", "coordinates": [[[i, 0], [1, 0], [1, 1], [i, 0]]]}} for i in range(400)]
    fc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:4326 {"}}, "features": feats, "tail": {"type": "note"}}
    (tmp_path / "one.json").write_text(json.dumps(fc, ensure_ascii=False))
    (tmp_path / "pretty.json").write_text(json.dumps({"type": "FeatureCollection", "features": feats[:9]}, indent=2))
    (tmp_path / "none.json").write_text(json.dumps({"features": [], "type": "FeatureCollection"}))
    from snapledger.sources import collections
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for size in ("2000", "400", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            tasks = spark.read.option("lineSep", "{").text(str(tmp_path / "one.json")).rdd.getNumPartitions()
            got = [json.loads(r.value) for r in collections.features(spark, str(tmp_path / "one.json")).orderBy("nth").collect()]
            more = collections.features(spark, str(tmp_path)).count()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert (tasks > 20 or size == "100000000") and more == 409
        assert got == feats
    rows = {r.Parcel_ID: r for r in stage.flatten_feature_collection(spark, str(tmp_path / "one.json"), ["Parcel_ID", "Note", "Absent"]).collect()}
    assert {k: r.Note for k, r in rows.items()} == {f["properties"]["Parcel_ID"]: f["properties"]["Note"] for f in feats}
    assert {r.Absent for r in rows.values()} == {None} and rows["P7"]["__geometry"] is None
    assert json.loads(rows["P8"]["__geometry"]) == feats[8]["geometry"]


def test_views_sql_json_and_describe(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    store.register_views({"snapledger_t": df})
    out = [json.loads(r.value) for r in store.sql_json(spark, "SELECT k, v FROM snapledger_t ORDER BY k").collect()]
    assert out == [{"k": "a", "v": 1}, {"k": "b", "v": 2}]
    d = store.describe(spark).filter(F.col("table") == "snapledger_t").orderBy("column").collect()
    assert [(r.column, r.data_type) for r in d] == [("k", "string"), ("v", "bigint")]


def test_read_features_all_string_then_cast(spark, tmp_path):
    from snapledger.plans import parcels
    (tmp_path / "p.ndjson").write_text(json.dumps({"Parcel_ID": "P", "Appraisal_Year": 12.0, "Deed_Date": 86400000,
                                                   "Unknown": 1}) + "\n")
    raw = stage.read_features(spark, str(tmp_path), parcels.FIELDS, parcels.KEY_SRC, parcels.PART_SRC, parcels.GEOM_SRC)
    assert all(f.dataType.simpleString() == "string" for f in raw.schema.fields)
    typed = stage.cast_columns(raw, [f for f in parcels.FIELDS if f.dst in ("appraisal_year", "deed_date")]).first()
    assert typed.appraisal_year == 12 and str(typed.deed_date) == "1970-01-02 00:00:00"


def test_a_byte_range_is_added_up_in_runs(spark, tmp_path, monkeypatch):
    """One byte range of many pieces: no window holds a whole range, whatever the range holds."""
    from snapledger.sources import collections
    monkeypatch.setattr(collections, "RUN_BITS", 3)
    feats = [{"type": "Feature", "properties": {"k": i, "note": '{"}' if i % 3 else "}\\"}, "geometry": {"a": {"b": i}}} for i in range(90)]
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps({"type": "FeatureCollection", "features": feats}))
    found = collections.features(spark, str(tmp_path))
    windows = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line and "_own" in line]
    assert windows and all("run#" in line for line in windows)
    for name in "ab":
        rows = found.where(F.col("file").endswith(f"{name}.json")).orderBy("nth").collect()
        assert [json.loads(r.value) for r in rows] == feats and [r.nth for r in rows] == list(range(1, 91))
