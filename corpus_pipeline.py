"""A training corpus in five stages, from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. Stages stand on their own: each works on
whatever rows it is given, and ``run`` writes each result to the shared folder
before the next stage reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailgrid.llm.decontaminate import uncontaminated
from hailgrid.llm.language import known_languages
from hailgrid.llm.packing import packed
from hailgrid.llm.pii import redacted
from hailgrid.llm.scratch import stored
from hailgrid.llm.simhash import one_of_each_group


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the classifier knows; null texts and texts without a letter go."""
    return known_languages(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, two bits."""
    return one_of_each_group(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words of a benchmark item occur."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 1024 tokens."""
    return packed(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Classifier, fingerprints and packing are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
