"""Ranked lexical search by bag deduplication.

Documents are restricted to the vocabulary of the items: what is left of a text is a vector of term
frequencies, and that vector with the document's length norm ``m`` decides its score for every item.  So
documents are put into classes by a hash of (vector, m), verified by the vector itself, which is part of the
key that the classes are made by.  A class is scored once, for all items; its members, equal in score, follow
in the order of their ids, and no more of them than the report has places.

Items are taken in blocks of bounded text, so that what is broadcast (vocabulary, weights, item lists) is
bounded too.  Document counts, lengths and document frequencies cover all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.llm.common import folded, materialise

BLOCK_BYTES = 4 << 20          # UTF-8 bytes of items in a block, on average
CELLS = 1 << 21                # scores or (class, item, term) triples in memory at once
SALTS = 64                     # partial reports per item, merged in the end


def vectors(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, n, vec) of the documents with a term: n terms in all, vec the little-endian pairs (term, tf) by term."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for b in batches:
            ids, sizes, vecs = [], [], []
            for i, t in zip(b.column(0), b.column(1)):
                terms = folded(t.as_py()).split()
                if terms:
                    found = Counter(map(number.get, terms))
                    found.pop(None, None)
                    ids.append(i.as_py())
                    sizes.append(len(terms))
                    vecs.append(np.array(sorted(found.items()), dtype="<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(vecs, pa.binary())], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "doc_id long, n long, vec binary").withColumn("row", F.monotonically_increasing_id())


def document_frequencies(held: DataFrame, size: int) -> dict[int, int]:
    """How many documents hold each of the ``size`` terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, dtype=np.int64)
        for b in batches:
            for v in b.column(0):
                df[np.frombuffer(v.as_buffer(), dtype="<u4")[::2]] += 1      # a term comes once in a vector
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(df[there])], names=["term", "df"])

    counted = held.select("vec").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in counted.collect()}


def classes(held: DataFrame, k: int) -> DataFrame:
    """(rep, doc_id, row, nth, m, vec): the first ``k`` members of each class in order of ids; the first one has the vector.

    The hash comes first in the key, so that rows are sorted by it; the vector beside it verifies the class.
    """
    key = held.withColumn("hash", F.xxhash64("vec", "m"))
    order = Window.partitionBy("hash", "m", "vec").orderBy(F.col("doc_id").asc_nulls_last(), "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (key.withColumn("nth", F.row_number().over(order))
            .withColumn("rep", F.first("row").over(order)).where(F.col("nth") <= k)
            .select("rep", "doc_id", "row", "nth", "m", F.when(F.col("nth") == 1, F.col("vec")).alias("vec")))


def _best(k: int, score: np.ndarray, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the k best: highest score, then smallest document, then row."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        few = np.flatnonzero(score >= least)
        return few[np.lexsort((row[few], doc[few], -score[few]))[:k]]
    return np.lexsort((row, doc, -score))[:k]


def score_classes(found: DataFrame, known, k: int) -> DataFrame:
    """(q, rep, doc_id, score): for each item the k best classes of every task, by score and first member."""
    schema = pa.schema([("q", pa.int64()), ("rep", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    last = np.iinfo(np.int64).max                                # a document without an id comes after all others

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, first, item, times, n_items = known.value
        # sums of whole numbers are exact in doubles up to 2^53
        exact = np.bincount(item, weights=times, minlength=n_items).max(initial=0) * weight.max(initial=0) * 1e6 < 2 ** 53
        top = [(np.zeros(0, np.int64),) * 3 for _ in range(n_items)]  # score, doc, rep

        def scores(vecs: list, m: np.ndarray) -> np.ndarray:
            pairs = [np.frombuffer(v, dtype="<u4").reshape(-1, 2) for v in vecs]
            at = np.repeat(np.arange(len(vecs)), [len(p) for p in pairs])
            pairs = np.concatenate(pairs).astype(np.int64)
            term, tf = pairs[:, 0], pairs[:, 1]
            part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[at]))
            n = first[term + 1] - first[term]
            out = np.zeros(len(vecs) * n_items, dtype=np.float64 if exact else np.int64)
            ends = np.cumsum(n)
            low = 0
            while low < len(n):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CELLS, side="right")))
                each = np.repeat(np.arange(low, high), n[low:high])
                to = first[term[each]] + np.arange(len(each)) - (ends[each] - n[each] - (ends[low - 1] if low else 0))
                cell, value = at[each] * n_items + item[to], part[each] * times[to]
                if exact:
                    out += np.bincount(cell, weights=value, minlength=len(out))
                else:
                    np.add.at(out, cell, value)
                low = high
            return out.astype(np.int64).reshape(len(vecs), n_items)

        rows = max(1, CELLS // max(1, n_items))
        for b in batches:
            for low in range(0, b.num_rows, rows):
                part = b.slice(low, rows)
                rep = part.column(0).to_numpy()
                doc = part.column(1).fill_null(last).to_numpy()
                got = scores([v.as_buffer() for v in part.column(3)], part.column(2).to_numpy())
                for q in np.flatnonzero(got.max(axis=0, initial=0) > 0):
                    s, d, r = top[q]
                    new = got[:, q]
                    hit = np.flatnonzero((new > 0) & (new >= (s[-1] if len(s) >= k else 0)))
                    if len(hit):
                        s, d, r = np.append(s, new[hit]), np.append(d, doc[hit]), np.append(r, rep[hit])
                        best = _best(k, s, d, r)
                        top[q] = s[best], d[best], r[best]
        for q, (s, d, r) in enumerate(top):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q)), pa.array(r), pa.array(d, mask=d == last), pa.array(s)], schema=schema)

    return found.where("nth = 1").select("rep", "doc_id", "m", "vec").mapInArrow(run, "q long, rep long, doc_id long, score long")


def _first(rows: DataFrame, by: list[Column | str], k: int, tie: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the ``k`` documents of highest score above 0, equal ones by ascending id.

    Terms are runs of letters, digits and non-ASCII characters of the whole text, A-Z lower-cased.  With N
    documents that have a term, L terms in all, n of them in a document and tf of one term, df documents that
    hold it, the score sums w * ((10^9 tf) div (1000 tf + 12 m)) over an item's terms, repeats included;
    w = floor(1000 ln((2N + 2) / (2df + 1))), m = 100 - 25 + (25 n N) div L.

    Null and blank texts have no terms: such documents count nowhere, such items get no rows.  Every row of
    either table counts: repeated documents take a place each, repeated items get a report each.  Documents
    without an id come last among equals.  Extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        own = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        listed = [(r["item_id"], Counter(folded(r["text"]).split())) for r in own.collect()]          # about block_bytes
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*(c for _, c in listed))))}
        if not vocabulary:
            continue
        shared = spark.sparkContext.broadcast(vocabulary)
        held = materialise(vectors(docs, shared, id_col, text_col), "bag-vectors")
        n_docs, length = held.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            return out
        df = document_frequencies(held, len(vocabulary))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], dtype=np.int64)
        lists = sorted((vocabulary[t], q, n) for q, (_, c) in enumerate(listed) for t, n in c.items())
        term, item, times = (np.array(x, dtype=np.int64) for x in zip(*lists))
        first = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        known = spark.sparkContext.broadcast((weight, first, item, times, len(listed)))

        norm = F.expr(f"100 - 25 + (25 * n * {n_docs}L) div {length}L")
        found = materialise(classes(held.where(F.octet_length("vec") > 0).withColumn("m", norm), k), "bag-classes")
        best = score_classes(found, known, k)
        best = _first(best.withColumn("salt", F.pmod("rep", F.lit(SALTS))), ["q", "salt"], k, "rep")
        best = materialise(_first(best, ["q"], k, "rep").select("q", "rep", "score"), "bag-best")
        # at most k classes for each item of the block, k members each
        members = found.select("rep", "doc_id", "row").join(F.broadcast(best), "rep")
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(listed)], f"q long, item_id {kind}")
        out = out.unionByName(_first(members, ["q"], k, "row").join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"))
    return out


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS total FROM d WHERE len(words) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term),
m AS (SELECT r, doc_id, 100 - 25 + (25 * len(words) * n_docs) // total AS m FROM d, g WHERE len(words) > 0),
s AS (SELECT q, item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM (SELECT q, item_id, unnest(words) AS term FROM i) JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY q, item_id, r),
o AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20"""
