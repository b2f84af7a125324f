"""Ingestion metrics: what arrived, what was valid, per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.numeric import python_round
from ..functions.temporal import iso_utc_now


def success_rate(succeeded: Column, attempted: Column) -> Column:
    """Share of valid records to three digits, 0.0 when nothing was attempted."""
    ratio = succeeded.cast("double") / F.nullif(attempted, F.lit(0)).cast("double")
    return F.coalesce(python_round(ratio, 3), F.lit(0.0))


def ingestion_metrics(
    df: DataFrame,
    valid: Column | None = None,
    source_col: str = "source",
    *,
    by: Sequence[str] = (),
    error: Column | None = None,
) -> DataFrame:
    """One metrics row per source (and per ``by``).

    ``valid`` is the condition a record must meet; without it every record counts
    as valid. ``error`` is a short reason code of an invalid record; the distinct
    reasons are listed, so it must not carry free text.
    """
    ok = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
    errors = (
        F.array_sort(F.collect_set(F.when(~ok, error))) if error is not None else F.array().cast("array<string>")
    )
    counted = df.groupBy(F.col(source_col).alias("source"), *by).agg(
        F.count(F.lit(1)).alias("records_attempted"),
        F.count_if(ok).alias("records_succeeded"),
        *([errors.alias("errors")] if error is not None else []),
    )
    if error is None:
        counted = counted.withColumn("errors", errors)
    return _complete(counted, by)


def observe_ingestion(df: DataFrame, name: str, valid: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count records while they pass through another job, without a pass of their own."""
    ok = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
    observation = Observation(name)
    counted = df.observe(
        observation,
        F.count(F.lit(1)).alias("records_attempted"),
        F.count_if(ok).alias("records_succeeded"),
    )
    return counted, observation


def metrics_row(
    spark: SparkSession, source: str, attempted: int, succeeded: int, errors: Sequence[str] | None = None
) -> DataFrame:
    """The log row of one run whose counts are known."""
    counts = spark.createDataFrame(
        [(source, attempted, succeeded, list(errors or []))],
        "source STRING, records_attempted BIGINT, records_succeeded BIGINT, errors ARRAY<STRING>",
    )
    return _complete(counts)


def batch_metrics(log: DataFrame, source: str) -> DataFrame:
    """One log row for each batch that a stream has written, from the log of its table (``read_log``).

    The counts were committed with the rows, so a batch that failed or was replayed counts once. Batches whose own entries were
    cleaned up are one row of their range.
    """
    # An entry and the first of those it replaces begin with the same batch, and all of those are cleaned up together.
    finest = log.groupBy("first").agg(F.min_by(F.struct("rows", "failed", "at"), "level").alias("e")).select("e.*")
    at = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    counted = finest.select(
        F.lit(source).alias("source"),
        F.col("rows").alias("records_attempted"),
        (F.col("rows") - F.col("failed")).alias("records_succeeded"),
        F.array().cast("array<string>").alias("errors"),
        at.alias("timestamp"),
    )
    return _complete(counted, at=F.col("timestamp"))


def _complete(counted: DataFrame, by: Sequence[str] = (), at: Column | None = None) -> DataFrame:
    attempted, succeeded = F.col("records_attempted"), F.col("records_succeeded")
    return counted.select(
        "source",
        *by,
        (iso_utc_now() if at is None else at).alias("timestamp"),
        attempted,
        succeeded,
        (attempted - succeeded).alias("records_failed"),
        success_rate(succeeded, attempted).alias("success_rate"),
        "errors",
    )


def summarize_metrics(log: DataFrame) -> DataFrame:
    """Runs, attempted and succeeded records per source over a run log."""
    return log.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records_attempted").alias("records_attempted"),
        F.sum("records_succeeded").alias("records_succeeded"),
    )
