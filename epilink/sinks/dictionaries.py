"""Dictionaries that are updated while others read them, and their form as one JSON object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.batches import is_batch_table, read_batches
from .batches import Entry, replace_all
from .tables import upsert_by_key


def write_dictionary(df: DataFrame, path: str) -> Entry:
    """Make ``df`` the new version of the dictionary at ``path``.

    A version is a folder of its own that counts once its entry is in the log: a reader has the old or the new one, never half
    of each, and after a crash in between the old one. ``clean_up`` deletes old versions.
    """
    return replace_all(df, path)


def read_dictionary(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version; no rows, of ``schema``, where there is none yet."""
    return read_batches(spark, path, schema)


def update_dictionary(new: DataFrame, path: str, key: str = "key", order_by: str | None = None) -> Entry:
    """New entries win over those of the current version, other old ones stay (``upsert_by_key``).

    ``order_by``, a column of ``new``, decides between entries of ``new`` with one key and is not stored itself unless the
    dictionary has it.
    """
    spark = new.sparkSession
    if not is_batch_table(spark, path):
        start = spark.createDataFrame([], new.schema)
        return write_dictionary(upsert_by_key(start, new, key, order_by), path)
    old = read_dictionary(spark, path)
    kept = old.columns
    nulls = lambda own, other: {c: F.lit(None).cast(other.schema[c].dataType) for c in other.columns if c not in own.columns}
    merged = upsert_by_key(old.withColumns(nulls(old, new)), new.withColumns(nulls(new, old)), key, order_by)
    return write_dictionary(merged.select(*kept), path)


def json_map_text(df: DataFrame, key: str = "key") -> DataFrame:
    """The dictionary as one JSON object in ``value``, ordered by key; the other way round is ``read_json_map``.

    One object is one value and so one task's work, for dictionaries that were such a file before.
    """
    fields = F.struct(*[c for c in df.columns if c != key])
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), fields.alias("value"))))
    return df.where(F.col(key).isNotNull()).agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def write_json_map(df: DataFrame, path: str, key: str = "key") -> str:
    """:func:`json_map_text` as a text file below ``path``."""
    json_map_text(df, key).write.mode("overwrite").text(path)
    return path

