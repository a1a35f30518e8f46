"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm import (
    bag_search, html_extract, lattice_lm, license_scan, minhash, mixing, packing, prefix_trie, rabitq, suffix_dedup, topk, toxicity, warc,
)
from snapledger.plans.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op1_minhash")
def op1_minhash(spark: SparkSession, d: str) -> DataFrame:
    """2-word shingles, similarity 0.8 or more, over all documents."""
    return minhash.near_duplicates(table(spark, d, "documents"), words=2, percent=80)


@register("op10_suffix_array")
def op10_suffix_array(spark: SparkSession, d: str) -> DataFrame:
    """50-byte strings that also start in a document with a smaller id, cut from all documents."""
    return suffix_dedup.cut_repeats(table(spark, d, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
             CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def op5_topk(spark: SparkSession, d: str) -> DataFrame:
    """For every 50th vector id, the 5 other vectors of largest integer inner product."""
    return topk.top_k(table(spark, d, "embeddings"), "id % 50 = 0", k=5)


@register("op7_rabitq")
def op7_rabitq(spark: SparkSession, d: str) -> DataFrame:
    """For every 100th vector id, the 10 nearest other vectors that the one-bit codes let through."""
    return rabitq.nearest(table(spark, d, "embeddings"), "id % 100 = 0", k=10)


@register("op2_packing")
def op2_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents as token sequences of at most 2048 ids."""
    import public_tokenizers

    cut = packing.pieces(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut)


@register("op3_mixing", """
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS size,
             1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight FROM z GROUP BY source),
f AS (SELECT *, 3 * size AS top, (sum(size) OVER () - coalesce(sum(3 * size) OVER (ORDER BY size / weight, encode(source) NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY size / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM s WHERE size > 0),
p AS (SELECT s.source, s.size, coalesce(least(f.top, coalesce((SELECT max(level) FROM f WHERE 3 * size / weight > level), 'inf'::DOUBLE) * s.weight), 0) AS target
      FROM s LEFT JOIN f ON f.source IS NOT DISTINCT FROM s.source),
o AS (SELECT z.doc_id, z.size, CAST(p.size AS BIGINT) AS source_size, p.target,
             CAST(floor(p.target + 1e-6) AS BIGINT) AS goal,
             coalesce(sum(z.size) OVER (PARTITION BY p.source ORDER BY ('0x' || substr(md5('42:' || z.doc_id), 1, 8))::BIGINT, z.doc_id, z.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM z JOIN p ON p.source IS NOT DISTINCT FROM z.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE size * (goal // source_size)
            + greatest(0, least(size, goal % source_size - start)) END AS BIGINT) AS taken FROM o""")
def op3_mixing(spark: SparkSession, d: str) -> DataFrame:
    """All documents, sources weighing 1, 2, 3 in turn, at most three epochs."""
    return mixing.mix(table(spark, d, "documents"))


@register("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
           ((('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INTEGER), 5))::BIGINT >> CAST(5 * (3 - k % 4) AS BIGINT)) & 31) + 1 AS INTEGER), 1)), '')
           AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to FROM q""")
def op4_warc(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.round_trip(table(spark, d, "pages"))


@register("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(table(spark, d, "pages"))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of all documents, learnt from rows that aren't held out."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    crf = toxicity.fit(docs, table(spark, d, "labels"))
    return toxicity.score(docs, crf).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    """Likelihood of all documents under the subword lattice model."""
    import public_tokenizers

    return lattice_lm.score(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op11_license_scan", license_scan.oracle())
def op11_license_scan(spark: SparkSession, d: str) -> DataFrame:
    """Licenses that all documents name or copy."""
    return license_scan.scan(table(spark, d, "documents"))


@register("op12_bag_search", bag_search.ORACLE)
def op12_bag_search(spark: SparkSession, d: str) -> DataFrame:
    """The 20 best of all documents for each benchmark item."""
    return bag_search.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


@register("op13_prefix_trie", prefix_trie.ORACLE)
def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    """The trie of all conversations, rebuilt with shared first turns."""
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))
