"""License scans by diagonal voting.

Every word k-gram of every text, rolled over its words, is joined by Spark to the k-grams of the templates
(a broadcast table: templates are given as a parameter and bounded by ``MOST_GRAMS``).  A hit votes for its
diagonal, document position minus template position: a copy of a template votes for one diagonal all along,
and inserted or missing words move it to a neighbouring one.  So the votes of diagonals at most ``slack``
apart are merged round each diagonal, and the span they make is verified: the words of the template that it
covers, each seen in a gram whose second, independent hash agrees too, must be a large enough share.

Phrases are templates as long as their own k-gram: there each hit is a place where the words stand in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import folded, materialise, mix, prefix_hash, range_hash, word_spans

GRAM, SLACK, SHARE = 4, 6, 0.8
MOST_GRAMS = 100_000           # rows of the broadcast table of template grams
PIECE = 1 << 20                # bytes hashed at a time; a longer text is hashed in pieces that end between words

# Phrases that name a license, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that licenses ask to be copied, and lines in which texts name them; with their labels.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
             "(at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)

# A rearrangement of the bytes: the second hash of a word is the first one of its rearranged bytes.
_TURNED = np.random.default_rng(20250117).permutation(256).astype(np.uint8)


def _two_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and two 64-bit hashes of the words of folded bytes, a bounded piece at a time."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            cut = data.find(b" ", end) if cut <= at else cut
            end = len(data) if cut < 0 else cut
        piece = np.frombuffer(data[at:end], dtype=np.uint8)
        a, b = word_spans(piece)
        found.append((a + at, range_hash(prefix_hash(piece), a, b), range_hash(prefix_hash(_TURNED[piece]), a, b)))
        at = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-grams that start at each word but the last k - 1."""
    n = max(0, len(words) - k + 1)
    h = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i: i + n])
    return h


def _stream(docs: DataFrame, widths: list[int], id_col: str, text_col: str) -> DataFrame:
    """(row, pos, h, g): every k-gram of every row; pos -1 is the row's own line, h its id and g its number of words."""
    schema = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("h", pa.int64()), ("g", pa.int64())])

    def lines(first: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        start, h, g = _two_hashes(b" ".join(texts))
        doc = np.searchsorted(at, start, side="right") - 1
        n = np.bincount(doc, minlength=len(texts))
        pos = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
        rows, places, hs, gs = [np.arange(len(texts))], [np.full(len(texts), -1)], [], [n]
        for k in widths:
            inside = np.flatnonzero(doc[: max(0, len(doc) - k + 1)] == doc[k - 1:])
            rows.append(doc[inside])
            places.append(pos[inside])
            hs.append(rolled(h, k)[inside].view(np.int64))
            gs.append(rolled(g, k)[inside].view(np.int64))
        own = pa.array(ids, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(rows) + first), pa.array(np.concatenate(places).astype(np.int32)),
            pa.concat_arrays([own, pa.array(np.concatenate(hs))]), pa.array(np.concatenate(gs))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0), b.column(1)):
                ids.append(i.as_py())
                texts.append(folded(t.as_py()))
                size += len(texts[-1])
                if size >= PIECE:
                    yield lines(first, ids, texts)
                    first, ids, texts, size = first + len(ids), [], [], 0
            if ids:
                yield lines(first, ids, texts)
                first += len(ids)

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "row long, pos int, h long, g long")


def _template_grams(spark: SparkSession, phrases: dict[str, str], templates, k: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """The grams (th, tg, template, tpos), the templates (template, label, phrase, width, n) and the widths."""
    grams, known = [], []
    for phrase, label, text in [(True, v, t) for t, v in phrases.items()] + [(False, v, t) for v, t in templates]:
        _, h, g = _two_hashes(folded(text))
        width = len(h) if phrase else k
        if not len(h) or len(h) < width:
            raise ValueError(f"a template needs at least {width or 1} words: {text!r}")
        grams += [(int(x), int(y), len(known), p) for p, (x, y) in enumerate(
            zip(rolled(h, width).view(np.int64), rolled(g, width).view(np.int64)))]
        known.append((len(known), label, phrase, width, len(h)))
    if len(grams) > MOST_GRAMS:
        raise ValueError(f"templates have {len(grams)} grams, more than {MOST_GRAMS}")
    return (spark.createDataFrame(grams, "th long, tg long, template int, tpos int"),
            spark.createDataFrame(known, "template int, label string, phrase boolean, width int, n int"),
            sorted({w for _, _, _, w, _ in known}))


def hits(docs: DataFrame, phrases: dict[str, str] | None = None, templates=TEMPLATES, k: int = GRAM,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id, n_words) of ``docs``, and all hits (row, pos, tpos, template, label, phrase, width, n)."""
    grams, known, widths = _template_grams(docs.sparkSession, PHRASES if phrases is None else phrases, templates, k)
    stream = _stream(docs, widths, id_col, text_col)
    met = stream.join(F.broadcast(grams), (F.col("pos") >= 0) & (F.col("h") == F.col("th")), "left")
    kept = materialise(met.where((F.col("pos") < 0) | (F.col("g").bitwiseXOR(F.col("tg")) == 0)), "license-hits")
    rows = kept.where("pos < 0").select("row", F.col("h").alias("doc_id"), F.col("g").alias("n_words"))
    found = kept.where("pos >= 0").select("row", "pos", "tpos", "template").join(F.broadcast(known), "template")
    return rows, found


def spans(found: DataFrame, slack: int = SLACK) -> DataFrame:
    """(row, label, template, diagonal, start, end, share): what is found round each diagonal that has votes.

    ``start`` and ``end`` are words of the text, end excluded; ``share`` is the part of the template's words
    that grams on the diagonals at most ``slack`` away cover.
    """
    votes = found.where("not phrase").withColumn("diagonal", F.col("pos") - F.col("tpos")).groupBy(
        "row", "template", "label", "width", "n", "diagonal").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("tpos").alias("at"))
    near = votes.withColumn("to", F.explode(F.sequence(F.col("diagonal") - slack, F.col("diagonal") + slack)))
    words = F.expr("size(array_distinct(flatten(transform(flatten(collect_list(at)), p -> sequence(p, p + width - 1)))))")
    return (near.groupBy("row", "template", "label", "width", "n", "to").agg(
        F.max(F.col("to") == F.col("diagonal")).alias("own"), F.min("lo").alias("start"),
        (F.max("hi") + F.col("width")).alias("end"), words.alias("words"))
        .where("own").select("row", "label", "template", F.col("to").alias("diagonal"), "start", "end",
                             (F.col("words") / F.col("n")).alias("share")))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates=TEMPLATES, k: int = GRAM, slack: int = SLACK,
         share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per row of ``docs``.

    ``n_base`` counts the places of phrases, overlapping ones too; ``first_word`` and ``last_word`` are the
    smallest and largest word at which one starts (from 0), null without any.  ``labels`` adds to the labels of
    phrases those of templates of which a span covers at least ``share`` of the words.  ``score`` is the largest
    share that any span reaches, whether it gives a label or not; 1 with a phrase, 0 without any hit.

    Null and empty texts have no words, empty labels and score 0.  Rows are scanned one by one: repeated rows
    and rows without an id give a row each.  Long texts are hashed in pieces and read whole.  Extra columns
    are ignored; an empty table gives no rows.
    """
    rows, found = hits(docs, phrases, templates, k, id_col, text_col)
    base = found.where("phrase").groupBy("row").agg(
        F.count("*").alias("n_base"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"),
        F.collect_set("label").alias("base"))
    more = spans(found, slack).groupBy("row").agg(
        F.collect_set(F.when(F.col("share") >= share, F.col("label"))).alias("more"), F.max("share").alias("best"))
    none = F.array().cast("array<string>")
    listed = rows.join(base, "row", "left").join(more, "row", "left")
    return listed.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def oracle(phrases: dict[str, str] | None = None, templates=TEMPLATES, k: int = GRAM, slack: int = SLACK, share: float = SHARE) -> str:
    """The same result in DuckDB's SQL: grams as texts, votes paired by their distance."""
    quoted = [(str(i), v, "true" if p else "false", folded(t).decode().split()) for i, (p, v, t) in enumerate(
        [(True, v, t) for t, v in (PHRASES if phrases is None else phrases).items()] + [(False, v, t) for v, t in templates])]
    values = ",\n".join(f"({i}, '{v}', {p}, ['{"', '".join(w)}'], {len(w) if p == 'true' else k})" for i, v, p, w in quoted)
    widths = sorted({len(w) if p == "true" else k for _, _, p, w in quoted})
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH k(template, label, phrase, words, width) AS (VALUES {values}),
t AS (SELECT *, len(words) AS n, unnest(range(0, len(words) - width + 1)) AS tpos FROM k),
tg AS (SELECT template, label, phrase, width, n, CAST(tpos AS BIGINT) AS tpos, array_to_string(words[tpos + 1:tpos + width], ' ') AS gram FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
g AS (SELECT r, pos, width, array_to_string(words[pos + 1:pos + width], ' ') AS gram
      FROM (SELECT r, words, width, unnest(range(0, len(words) - width + 1)) AS pos
            FROM d CROSS JOIN (SELECT unnest({widths}) AS width) WHERE len(words) >= width)),
h AS (SELECT g.r, g.pos, tg.* EXCLUDE (gram) FROM g JOIN tg ON g.gram = tg.gram AND g.width = tg.width),
b AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS base
      FROM h WHERE phrase GROUP BY r),
v AS (SELECT DISTINCT r, template, label, n, pos - tpos AS diagonal, tpos + unnest(range(0, width)) AS word FROM h WHERE NOT phrase),
c AS (SELECT a.r, a.template, a.label, a.diagonal, count(DISTINCT o.word) / any_value(a.n) AS share
      FROM (SELECT DISTINCT r, template, label, n, diagonal FROM v) a
      JOIN v o ON a.r = o.r AND a.template = o.template AND abs(a.diagonal - o.diagonal) <= {slack} GROUP BY 1, 2, 3, 4),
m AS (SELECT r, max(share) AS best, list(DISTINCT label) FILTER (share >= {share}) AS more FROM c GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, array_to_string(coalesce(base, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN b ON d.r = b.r LEFT JOIN m ON d.r = m.r"""
