"""Streaming scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import vocabulary
from .tables import is_folder


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str = vocabulary.BOOTSTRAP_SERVERS,
    *,
    format: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of messages with a ``value`` column, from the earliest one.

    ``format="text"`` reads lines of files in the folder ``topic`` instead, for
    places without a broker. ``options`` passes rate limits such as
    ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(format).options(**(options or {}))
    if format == "kafka":
        return (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .load()
        )
    return reader.load(topic)


def stream_table(spark: SparkSession, folder: str, schema: StructType, name: str) -> DataFrame:
    """Stream of the Parquet table ``name`` of a folder, which is one file or itself a folder of files."""
    path = f"{folder}/{name}"
    reader = spark.readStream.schema(schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    # A stream reads folders alone, so one file is picked from its folder by name.
    return reader.option("pathGlobFilter", name).parquet(folder)
