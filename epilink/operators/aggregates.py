"""Summary tables by one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def total_by(df: DataFrame, key: str, col: str, name: str = "total") -> DataFrame:
    """Sum per key, largest first; equal sums are ordered by key."""
    return df.groupBy(key).agg(F.sum(col).alias(name)).orderBy(F.col(name).desc(), F.col(key))


def mean_by(df: DataFrame, key: str, col: str, name: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias(name))


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def summaries(
    cases: DataFrame, weather: DataFrame, alerts: DataFrame, key: str = "district_canonical"
) -> dict[str, DataFrame]:
    """The three chart tables: cases, mean temperature and alerts per place."""
    return {
        "cases": total_by(cases, key, "case_count", "cases"),
        "temperature": mean_by(weather, key, "temperature_c", "temp"),
        "alerts": count_by(alerts, key, "alerts"),
    }
