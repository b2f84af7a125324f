"""Rows to JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocabulary


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON text per row in ``value``; nulls are written, not dropped."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(
    df: DataFrame,
    topic: str,
    servers: str = vocabulary.BOOTSTRAP_SERVERS,
    *,
    format: str = "kafka",
) -> None:
    """Send each row to a topic without a key; ``format="text"`` appends lines to a folder."""
    writer = to_messages(df).write.format(format)
    if format == "kafka":
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    else:
        writer.mode("append").save(topic)
