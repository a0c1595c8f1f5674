"""The corpus pipeline: language ID, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in the shared folder and
read again as the next stage's docs. All but the last return the columns of documents. Repeated rows, nulls, empty
texts and extra columns are handled as each operator's docstring says; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tendril.llm import decontamination, language_id, packing, similar_texts, suffix_dedup
from tendril.llm.shared import table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter go, and no others."""
    return language_id.with_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts (five-word shingles, 0.8 or more) the first document by id and text."""
    return similar_texts.without_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that also start earlier; documents of which nothing is left go."""
    return suffix_dedup.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark table."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts' tokens, dealt to sequences."""
    return packing.pack(docs, packing.default_tokenizer(), with_ids=False)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: SQL has no SimHash over XXH64, no suffix order and no tokenizer; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
