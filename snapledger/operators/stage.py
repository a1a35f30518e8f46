"""Staging: raw multi-part records -> one typed, cleaned, hashed row per key.

Pipeline (lazy, one Catalyst plan):
  read_features -> drop_unkeyed -> collapse -> cast -> clean -> hash

``collapse`` is one ``groupBy(key)``: partial aggregation runs map-side, so a
key with millions of parts still ships one buffer per map task.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapledger.functions.values import plausible_year
from snapledger.operators import scd2
from snapledger.session import cut_lineage
from snapledger.sources.fields import FieldSpec, cast_expr, hashed_columns, read_schema

BROKEN = "_broken_line"


def read_features(spark: SparkSession, path: str, fields: list[FieldSpec], key_src: str,
                  part_src: str | None = None, geom_src: str | None = "__geometry",
                  failfast: bool = False) -> DataFrame:
    """NDJSON (one record per line), explicit all-STRING columns; absent -> NULL, extra ignored.

    A line that is no JSON record keeps its text in ``_broken_line``: it is a fault of the
    transfer, not a record without a key, and ``drop_unkeyed`` counts it or stops at it.
    """
    schema = read_schema(fields, key_src, part_src, geom_src).add(BROKEN, "string")
    return (spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN)
            .option("mode", "FAILFAST" if failfast else "PERMISSIVE")
            .json(path))


def flatten_feature_collection(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """GeoJSON FeatureCollection files -> one row per feature: properties as text + geometry JSON text (``sources.collections``)."""
    from snapledger.sources import collections

    return collections.flatten(spark, path, columns)


def drop_unkeyed(df: DataFrame, key: str, observation: Observation | None = None) -> DataFrame:
    """Drop rows whose key is NULL or ''; the counts land in ``observation`` after the first action.

    Broken lines (see ``read_features``) are counted apart as ``broken_lines``, for
    ``gates.assert_parsed``; without an observation that could tell of them they stop the job.
    """
    unkeyed = F.col(key).isNull() | (F.col(key).cast("string") == "")
    broken = F.col(BROKEN).isNotNull() if BROKEN in df.columns else F.lit(False)
    if observation is not None:
        df = df.observe(observation, F.count_if(unkeyed & ~broken).alias("dropped_unkeyed"),
                        F.count_if(broken).alias("broken_lines"), F.count(F.lit(1)).alias("source_features"))
    elif BROKEN in df.columns:
        stop = F.raise_error(F.concat(F.lit("broken record: "), F.substring(F.col(BROKEN), 1, 200)))
        df = df.withColumn(BROKEN, F.when(broken, stop).otherwise(F.col(BROKEN)))
        return df.filter(F.coalesce(F.length(BROKEN), F.lit(0)) >= 0).filter(~unkeyed).drop(BROKEN)
    return df.filter(~unkeyed & ~broken).drop(BROKEN)


def bad_casts(fields: list[FieldSpec]) -> Column:
    """How many of a raw row's values are there but can't be read as their type."""
    bad = [F.when(F.col(f.src).isNotNull() & (F.trim(f.src) != "") & cast_expr(f).isNull(), 1).otherwise(0)
           for f in fields if f.type != "string" or f.epoch_millis]
    return sum(bad[1:], bad[0]) if bad else F.lit(0)


def observe_casts(df: DataFrame, fields: list[FieldSpec], observation: Observation) -> DataFrame:
    """Count unreadable values into ``observation`` as ``bad_casts`` (for ``gates.assert_parsed``)."""
    return df.observe(observation, F.sum(bad_casts(fields)).alias("bad_casts"))


def order_key(part_col: str | None, geom_col: str | None) -> Column:
    """Deterministic part order: part number (as a number, of any size), then md5 of the raw geometry text."""
    part = F.col(part_col) if part_col else F.lit(None)
    geom = F.col(geom_col) if geom_col else F.lit(None).cast("string")
    number = F.round(part.try_cast("double")).try_cast("bigint") if part_col else F.lit(0).cast("bigint")
    return F.struct(F.coalesce(number, F.lit(0)).alias("part"), F.md5(F.coalesce(geom, F.lit(""))).alias("id"))


def collapse(df: DataFrame, key: str, fields: list[FieldSpec], part_col: str | None = None,
             geom_col: str | None = None, key_dst: str | None = None,
             typed: bool = False, collect_geometry: bool = True) -> DataFrame:
    """One row per key.  Per field: the first non-NULL value in part order; volatile -> max.

    ``typed`` says the inputs already carry the spec types (otherwise they are
    raw text and cast after the collapse).  Adds ``feature_count`` and, with a
    geometry column, the sorted distinct non-NULL part geometries ``geom_parts``.
    """
    ordk = "_order_key"
    d = df.withColumn(ordk, order_key(part_col, geom_col))
    aggs = []
    for f in fields:
        c = F.col(f.src)
        if f.volatile:
            v = F.max(cast_expr(f, c) if not typed else c)
        else:
            # NULL values must not win: give them a NULL ordering, which min_by skips
            v = F.min_by(c, F.when(c.isNotNull(), F.col(ordk)))
            if not typed:
                v = cast_expr(f, v)
        aggs.append(v.alias(f.dst))
    aggs.append(F.count(F.lit(1)).cast("int").alias("feature_count"))
    if geom_col and collect_geometry:
        # for keys of few parts; ``dissolve.geometries`` unites them without gathering them, ``geometry_metrics`` only measures
        aggs.append(F.array_sort(F.collect_set(geom_col)).alias("geom_parts"))
    return d.groupBy(F.col(key).alias(key_dst or key)).agg(*aggs)


def geometry_metrics(df: DataFrame, key: str, geom_col: str, key_dst: str | None = None) -> DataFrame:
    """Per key, from its distinct parts and without collecting them: part count, equal-area m2
    (sum over distinct parts: exact for interior-disjoint parts), bbox and an order-free hash.

    Part measures are computed map-side (parallel with the scan), then parts are
    de-duplicated on (key, md5 of the part text) carrying only numbers -- a key
    holding a large share of all parts is spread over many tasks -- and the
    per-key step is a partial aggregation.
    """
    from snapledger.operators import geo

    k = key_dst or key
    text = F.col(geom_col)
    # parse once into a column: the measures below reference the geometry several times
    parsed = df.filter(text.isNotNull()).select(
        F.col(key).alias(k), F.md5(text).alias("_id"), F.xxhash64(text).alias("_h"),
        geo.parse_geojson(text).alias("_geom"))
    g = F.col("_geom")
    per = parsed.select(k, "_id", "_h", geo.area_m2(g).alias("_area"), geo.bbox(g).alias("_b")).select(
        k, "_id", "_h", "_area", "_b.xmin", "_b.ymin", "_b.xmax", "_b.ymax")
    # copies of one part carry equal measures: any aggregate picks them (numeric -> hash aggregation)
    parts = per.groupBy(k, "_id").agg(
        F.max("_area").alias("_area"), F.max("_h").alias("_h"), F.min("xmin").alias("xmin"),
        F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
    return parts.groupBy(k).agg(
        F.count(F.lit(1)).cast("int").alias("n_parts"), F.sum("_area").alias("area_m2"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        # XOR of the distinct parts' hashes: independent of part order, no collection, no overflow
        F.bit_xor("_h").alias("geom_hash"))


def collapse_two_level(df: DataFrame, key: str, fields: list[FieldSpec], part_col: str, geom_col: str,
                       key_dst: str | None = None) -> DataFrame:
    """``collapse`` + ``geometry_metrics`` from ONE scan, in two aggregation levels (typed inputs).

    Level 1 groups by (key, part geometry): per field the first non-NULL value in part
    order *with its part number* (the rest of the order key, the md5 of the geometry, is the
    group's), the row count, the volatile max and the part's equal-area measures.  Level 2 groups by key and picks each
    field by the smallest order key.  The same order key decides as in
    ``collapse``, so results are identical; a key holding a large share of all
    parts is spread over many tasks at level 1 instead of one.
    """
    from snapledger.operators import geo

    k = key_dst or key
    text = F.col(geom_col)
    d = df.select(F.col(key).alias(k), *[F.col(f.src) for f in fields], text.alias("_text"), order_key(part_col, None)["part"].alias("_part"))
    g1 = []
    for f in fields:
        c = F.col(f.src)
        if f.volatile:
            g1.append(F.max(c).alias(f.dst))
        else:
            part = F.when(c.isNotNull(), F.col("_part"))
            g1 += [F.min_by(c, part).alias(f.dst), F.min(part).alias(f.dst + "__part")]
    g1.append(F.count(F.lit(1)).alias("_rows"))
    lvl1 = d.groupBy(k, "_text").agg(*g1).withColumn("_id", F.md5(F.coalesce("_text", F.lit(""))))
    # measures once per distinct part (after de-duplication, from a bound column)
    lvl1 = lvl1.withColumn("_geom", geo.parse_geojson(F.col("_text")))
    lvl1 = lvl1.select("*", geo.area_m2(F.col("_geom")).alias("_area"), geo.bbox(F.col("_geom")).alias("_b"))
    g2 = []
    for f in fields:
        if f.volatile:
            g2.append(F.max(f.dst).alias(f.dst))
        else:
            part = F.col(f.dst + "__part")
            g2.append(F.min_by(f.dst, F.when(part.isNotNull(), F.struct(part, "_id"))).alias(f.dst))
    g2 += [F.sum("_rows").cast("int").alias("feature_count"),
           F.count("_text").cast("int").alias("n_parts"), F.sum("_area").alias("area_m2"),
           F.min("_b.xmin").alias("xmin"), F.min("_b.ymin").alias("ymin"),
           F.max("_b.xmax").alias("xmax"), F.max("_b.ymax").alias("ymax"),
           F.bit_xor(F.when(F.col("_text").isNotNull(), F.xxhash64("_text"))).alias("geom_hash")]
    return lvl1.groupBy(k).agg(*g2)


def cast_columns(df: DataFrame, fields: list[FieldSpec], keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text columns -> typed ``dst`` columns (no collapse)."""
    return df.select(*keep, *[cast_expr(f).alias(f.dst) for f in fields])


def clean(df: DataFrame, rules: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Null out values failing a predicate: ``{column: predicate(col) -> boolean Column}``."""
    return df.withColumns({c: F.when(pred(F.col(c)), F.col(c)) for c, pred in rules.items()})


def clean_years(df: DataFrame, cols: tuple[str, ...], as_of_year: int) -> DataFrame:
    """Keep a year only when it is plausible: 1850 .. as_of_year + 1 (NULL otherwise)."""
    return clean(df, {c: (lambda col: plausible_year(col, as_of_year)) for c in cols})


def stage_snapshot(raw: DataFrame, key_src: str, fields: list[FieldSpec], part_src: str | None,
                   geom_src: str | None, key_dst: str, as_of_year: int,
                   year_cols: tuple[str, ...] = (), observation: Observation | None = None,
                   casts: Observation | None = None) -> DataFrame:
    """raw records -> drop unkeyed -> collapse -> union of parts -> clean -> attr_hash.

    With ``geom_src`` the parts' GeoJSON is united (``geom``) and measured (``area_m2``, ``n_parts``, ``parts_overlap``);
    the hash covers the union's canonical text, so how parts are cut or ordered doesn't count as a change.
    ``observation`` gets the row counts, ``casts`` the number of unreadable values.
    """
    from snapledger.operators import dissolve, geo

    kept = drop_unkeyed(raw, key_src, observation)
    if casts is not None:
        kept = observe_casts(kept, fields, casts)
    extra = None
    if geom_src:
        kept = cut_lineage(kept, "kept")          # read for the attributes and, in two columns, for the parts
    snap = collapse(kept, key_src, fields, part_src, geom_src, key_dst=key_dst, collect_geometry=False)
    if geom_src:
        parts = kept.select(F.col(key_src).alias("_key"), geo.parse_geojson(F.col(geom_src)).alias("geom"))
        shapes = dissolve.geometries(parts, "_key")
        snap = snap.join(shapes, F.col(key_dst) == F.col("_key"), "left").drop("_key")
        snap = snap.withColumn("n_parts", F.coalesce("n_parts", F.lit(0)))
        extra = F.coalesce(geo.canonical_text(F.col("geom")), F.lit(""))
    if year_cols:
        snap = clean_years(snap, year_cols, as_of_year)
    cols = hashed_columns(fields)
    return snap.withColumn("attr_hash", scd2.row_hash(cols, extra))
