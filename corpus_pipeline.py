"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmentry.llm.common import passing_tables, table, written
from segmentry.llm.decontaminate import decontaminated
from segmentry.llm.jaccard import one_of_each
from segmentry.llm.language import identified
from segmentry.llm.packing import pack
from segmentry.llm.pii import without_data


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that no language explains, such as those without letters."""
    return identified(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more."""
    return one_of_each(docs, n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, also with other numbers, names or units."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the terms that reveal it; every document stays."""
    return without_data(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", distinct_documents),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Tokenizers, hashed n-gram models and groups of near copies are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages make of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with passing_tables(spark):
            docs = written(stage(spark, docs, sf_dir), name, stays=True, texts=True)
    return docs
