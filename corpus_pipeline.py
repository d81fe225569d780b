"""The corpus pipeline: documents -> quality rules -> near duplicates -> decontamination -> surrogates -> mixture.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet in the shared folder and read
again as the next stage's docs, so no stage is computed twice and a lost executor costs only running tasks.

Defined cases, in every stage: a null or empty text has no words, so the quality rules reject it; texts of any length are
worked on whole; rows that repeat an id are different documents, and of equal texts one stays; ties go to the smallest id,
null ids last; null languages and sources stay, a null source is a source of its own; an empty table gives an empty
result; columns beyond those of documents are carried to the end, whatever their names. `copy` and `shuffle_key`, which
the last stage adds, get an underscore where the input has a column of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kartoteka.llm import decontaminate, jaccard, mixing, pii, quality
from kartoteka.llm.common import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates."""
    return pii.replace(docs, counted=False)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, shuffled; adds copy and shuffle_key."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("mixture", mixture),
]
#: SQL can express neither keyed surrogates nor similarity joins over whole tables; tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
