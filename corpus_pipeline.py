"""A training-data pipeline over ``documents``: each stage takes all that its predecessor kept.

Language ID drops documents without a language; near-deduplication keeps the smallest doc_id of each group of documents that
SimHash fingerprints link (op5's shingle length and bit distance); suffix-array deduplication cuts passages that an earlier document has;
mixing repeats or drops documents so that the sources meet their target weights; packing turns the rest into token sequences.

Stages read the documents' columns doc_id, text, lang, source and n_chars and keep any others.  Each operator's
module states what becomes of nulls, empty texts, ties, repeated rows and empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotterlake.llm import langid, mixing, packing, simhash, suffix_dedup
from blotterlake.llm.common import prepare, scratch_path
from blotterlake.llm.tokens import default_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter go."""
    prepare(spark)
    return langid.keep_known(docs, langid.fit(langid.training_rows(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op5's fingerprints link."""
    prepare(spark)
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller doc_id has."""
    prepare(spark)
    return suffix_dedup.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    prepare(spark)
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document, with its ids."""
    prepare(spark)
    # Four stages before this one have filled the executors' heaps, so workers hold less than in op1.
    return packing.pack_documents(docs, default_tokenizer(), with_ids=True, held_words=250_000, slice_bytes=2 << 20)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", known_language),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # a classifier, hashes and a tokenizer are not SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is stored and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
