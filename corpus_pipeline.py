"""From raw documents to token files: language identification, near-duplicate removal, benchmark
decontamination, mixing to target weights, token files.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the
last return the columns of the documents; the last returns doc_id, start, n_tokens and ids_crc32 as
read back from the files. Stages keep rows with nulls, repeated rows and extra columns as their
operators say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hydrolens.llm import decontamination, language_id, mixing, near_duplicates, token_files
from hydrolens.llm.common import table
from hydrolens.sources.folders import RunFolder


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go."""
    return language_id.identified(docs, RunFolder(spark))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8)."""
    return near_duplicates.distinct_documents(docs, RunFolder(spark))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"), RunFolder(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of every leaf up to its budget, some of them once more."""
    return mixing.mixed_documents(docs, RunFolder(spark))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, described document by document."""
    return token_files.tokenized(docs)


STAGES = [
    ("language_id", keep_identified),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix),
    ("token_files", write_tokens),
]

# Learned centroids, MinHash and the tokenizer have no SQL: tests/llm/test_pipeline.py checks each stage
# against brute force on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    stored = RunFolder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored.keep(stage(spark, docs, sf_dir), name)
    return docs
