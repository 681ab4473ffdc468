"""The corpus operators as registered queries, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    ann_scan,
    bloom_rank,
    bpe_codec,
    decision_list,
    line_dedup,
    lm_scoring,
    ngram_join,
    packing,
    quality_fm,
    suffix_dedup,
    toxicity,
    warc,
    whitening,
)
from tallyhouse.llm.common import fold, table
from tallyhouse.session import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site-relative boilerplate lines of all documents; a source is a host."""
    cleaned = line_dedup.drop_boilerplate_lines(table(spark, sf_dir, "documents"), "doc_id", "source", "text")
    return cleaned.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("_doc", "stays")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, RANKS, PATTERN)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return decision_list.judge(docs, decision_list.train(docs, labels, F.lit(True)))


def op8_ann_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_scan.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_digest(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    machine = quality_fm.train(docs, labels, ~held_out)
    scored = quality_fm.score_quality(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chars"), machine)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, "vec_id", "embedding", whitening.fit(vectors, "embedding"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all pages in the shared folder, and what is read back from it."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4()}"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.page_digests(spark, path)


def op13_bloom_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_rank.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_toxicity,
        op3_ngram_join,
        op4_suffix_dedup,
        op5_packing,
        op6_lm_scoring,
        op7_decision_list,
        op8_ann_scan,
        op9_bpe_codec,
        op10_quality_fm,
        op11_whitening,
        op12_warc,
        op13_bloom_rank,
    )
}

ORACLE_SQL = {
    "op1_line_dedup": f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
counted AS (
    SELECT source, line, count(*) AS n
    FROM (SELECT source, unnest(list_distinct(lines)) AS line FROM pages)
    WHERE trim(line, ' ') <> '' GROUP BY source, line HAVING count(*) >= {line_dedup.MIN_PAGES}
),
bad AS (
    SELECT c.source, list(c.line) AS drop_lines FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
    WHERE c.n > t.pages * {line_dedup.RATIO} GROUP BY c.source
),
kept AS (
    SELECT doc_id, p.source, lines,
           list_filter(lines, lambda x: NOT list_contains(coalesce(drop_lines, []), x)) AS left_lines
    FROM pages p LEFT JOIN bad b ON p.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(left_lines), 0) AS n_dropped,
       CASE WHEN lines IS NULL THEN NULL ELSE coalesce(array_to_string(left_lines, chr(10)), '') END AS text
FROM kept
""",
    "op12_warc": f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (SELECT page_id, html, strlen(html) AS n, min(page_id) OVER (PARTITION BY html) AS first FROM payloads),
judged AS (SELECT *, n >= {warc.REVISIT_FROM} AND page_id <> first AS again FROM firsts)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM judged
""",
    "op13_bloom_rank": r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM documents
),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
factors AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM lengths, totals),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, docs
),
asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark)
    GROUP BY ALL
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN factors USING (doc_id)
    GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
