"""Documents to packed training sequences: the corpus operators as stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored and read again as the next one's docs.
All but the last return the columns of ``documents``; stages that change texts also bring ``n_chars`` up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import line_dedup, ngram_join, packing, quality_fm, suffix_dedup
from tallyhouse.llm.common import stored, table
from tallyhouse.llm.queries import PATTERN, RANKS, TOKENIZER


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    return quality_fm.quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source."""
    cleaned = line_dedup.drop_boilerplate_lines(docs, "doc_id", "source", "text")
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return cleaned.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes of passages that start earlier."""
    return suffix_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full windows, mixed by source."""
    return packing.pack_documents(docs, TOKENIZER, RANKS, PATTERN)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", drop_lines),
    ("ngram_join", near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

# A fitted classifier, sketches and a tokenizer are no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
