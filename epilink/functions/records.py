"""Record-level columns: ids, source tags, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F


def content_hash(cols: Sequence[str]) -> Column:
    """SHA-256 over the columns as text; null and empty text hash differently."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def record_id(cols: Sequence[str] | None = None) -> Column:
    """Id of a row: its content hash, so that reruns agree; a random UUID without columns."""
    return content_hash(cols) if cols else F.uuid()


def prefixed_id(cols: Sequence[str], prefix: str) -> Column:
    """Prefix plus the first eight hex digits of the id, upper case."""
    return F.concat(F.lit(prefix), F.upper(F.left(content_hash(cols), F.lit(8))))


def with_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("source", F.lit(tag))


def with_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace null by a default, column by column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
