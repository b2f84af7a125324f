"""A training corpus from ``documents`` in five stages, each of which calls one operator.

Each stage is given what its predecessor kept, in the columns of ``documents``; the last one
returns the mixture, one row per copy. Rows with nulls, empty texts and repeated rows are treated
as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from epilink.llm.decontaminate import decontaminate
from epilink.llm.exact_dedup import first_of_each
from epilink.llm.mixing import mix
from epilink.llm.order_minhash import one_of_each
from epilink.llm.tables import release, stored, table
from epilink.llm.toxicity import accepted


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return first_of_each(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; those that mostly consist of them go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources, one row per copy of a document."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier of the first stage has no SQL form; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
