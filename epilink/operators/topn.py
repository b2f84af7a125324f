"""First rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of each group in the given order.

    The rank filter lets Spark cut every group to ``n`` rows per task before the
    shuffle, so a group with most of the rows sends only a few of them.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


# Headline columns of a linked row, in the order shown.
HEADLINE = (
    "district_canonical",
    "epi_week_key",
    "disease",
    "case_count",
    "avg_temperature_c",
    "avg_precipitation_mm",
    "disaster_event_count",
    "max_severity",
    "has_concurrent_disaster",
)


def linked_sample(df: DataFrame, n: int = 10, keys: Sequence[str] = ("district_canonical", "epi_week_key")) -> DataFrame:
    """First ``n`` linked rows by key with the headline columns that are present."""
    shown = [c for c in HEADLINE if c in df.columns]
    rest = [c for c in shown if c not in keys]
    return df.select(*shown).orderBy(*keys, *rest).limit(n)
