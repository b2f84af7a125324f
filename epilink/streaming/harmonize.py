"""Message streams to harmonised, partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas, vocabulary
from ..functions.temporal import with_epi_week_key
from ..sinks.batches import FAN_IN, compact, write_batch
from ..sources.payloads import parse_json
from ..sources.topics import read_topic

# Kind of source -> partition column of its table.
PARTITION_COLUMN = {"week": "epi_week_key", "month": "report_month_label", "plain": None}

# Rows of a batch that are printed.
CONSOLE_ROWS = 20
# How often running sources are looked at.
_WATCH_SECONDS = 2


@dataclass(frozen=True)
class SourceConfig:
    """One stream: where it comes from, how it is keyed and where it goes."""

    name: str
    topic: str
    schema: StructType
    kind: str
    path: str
    checkpoint: str
    format: str = "kafka"
    servers: str = vocabulary.BOOTSTRAP_SERVERS
    options: Mapping[str, str] = field(default_factory=dict)
    tee: bool = False
    # "files" is Spark's file sink, "batches" a table with a log (``write_batches``).
    sink: str = "files"


def topic_location(name: str, folder: str | None = None) -> tuple[str, str]:
    """Topic and format of a source: on the broker, or as text files below ``folder``."""
    topic = vocabulary.TOPICS[name]
    return (topic, "kafka") if folder is None else (f"{folder}/{topic}", "text")


def default_sources(base: str, checkpoints: str, *, folder: str | None = None, tee: bool = False, **overrides) -> list[SourceConfig]:
    """The five sources with their topics and table folders; ``tee`` prints the keyed ones."""
    kinds = {"surveillance": "week", "weather": "week", "alerts": "week", "policy": "month", "news": "plain"}
    sources = []
    for name, kind in kinds.items():
        topic, form = topic_location(name, folder)
        sources.append(
            SourceConfig(
                name=name,
                topic=topic,
                format=form,
                schema=schemas.MESSAGES[name],
                kind=kind,
                path=f"{base}/{vocabulary.TABLE_FOLDERS[name]}",
                checkpoint=f"{checkpoints}/{name}",
                tee=tee and kind != "plain",
                **overrides,
            )
        )
    return sources


def harmonize(messages: DataFrame, schema: StructType, kind: str, value_col: str = "value") -> DataFrame:
    """Parse messages, add the week key where the source is weekly, add ``processed_at``.

    Works on streams and on tables. A malformed message stays as an all-null row
    with a null key. Monthly messages carry their key.
    """
    rows = parse_json(messages, schema, value_col)
    if kind == "week":
        rows = with_epi_week_key(rows)
    elif kind not in PARTITION_COLUMN:
        raise ValueError(f"kind must be one of {sorted(PARTITION_COLUMN)}, not {kind!r}")
    return rows.withColumn("processed_at", F.current_timestamp())


def unparsed(schema: StructType):
    """Whether a harmonised row is what is left of a message that could not be parsed."""
    return F.coalesce(*[F.col(f"`{f.name}`").cast("string") for f in schema.fields]).isNull()


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    *,
    available_now: bool = False,
    interval: str = vocabulary.TRIGGER_INTERVAL,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to Parquet exactly once; restarts resume from the checkpoint.

    ``available_now`` works off what is there and ends, otherwise a batch starts
    every ``interval``.
    """
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if name is not None:
        writer = writer.queryName(name)
    return _trigger(writer, available_now, interval).start()


def write_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = None,
    *,
    failed=0,
    show: int = 0,
    fan_in: int = FAN_IN,
    available_now: bool = False,
    interval: str = vocabulary.TRIGGER_INTERVAL,
    name: str | None = None,
    **layout,
) -> StreamingQuery:
    """Append a stream batch by batch to a table with a log; a batch that is replayed adds nothing.

    Each batch is read and parsed once and kept in storage while it is used: it is counted, written in few
    files and, with ``show``, its first rows are printed. Writes are merged as they become many.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if write_batch(batch, batch_id, path, partition_by, failed, **layout) is not None:
                compact(batch.sparkSession, path, partition_by, fan_in, **layout)
            if show:
                print(f"{name}: batch {batch_id}")
                batch.show(show, truncate=False)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    if name is not None:
        writer = writer.queryName(name)
    return _trigger(writer, available_now, interval).start()


def tee_console(
    df: DataFrame,
    name: str,
    *,
    rows: int = CONSOLE_ROWS,
    available_now: bool = False,
    interval: str = vocabulary.TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Print the first rows of every batch untruncated; only those reach the driver.

    A query of its own without a checkpoint, so it reads the source once more.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"{name}: batch {batch_id}")
        batch.show(rows, truncate=False)

    writer = df.writeStream.foreachBatch(show).outputMode("append").queryName(name)
    return _trigger(writer, available_now, interval).start()


def _trigger(writer, available_now: bool, interval: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


def harmonize_stream(
    spark: SparkSession,
    config: SourceConfig,
    *,
    available_now: bool = False,
    interval: str = vocabulary.TRIGGER_INTERVAL,
    messages: DataFrame | None = None,
) -> list[StreamingQuery]:
    """Start a source: topic to harmonised table, plus the console query if asked for."""
    if messages is None:
        messages = read_topic(
            spark, config.topic, config.servers, format=config.format, options=config.options
        )
    rows = harmonize(messages, config.schema, config.kind)
    timing = {"available_now": available_now, "interval": interval}
    key = PARTITION_COLUMN[config.kind]
    if config.sink == "batches":
        show = CONSOLE_ROWS if config.tee else 0
        return [write_batches(rows, config.path, config.checkpoint, key, failed=unparsed(config.schema), show=show, name=config.name, **timing)]
    started = [
        write_stream(
            rows,
            config.path,
            config.checkpoint,
            key,
            name=config.name,
            **timing,
        )
    ]
    if config.tee:
        started.append(tee_console(rows, f"{config.name}_console", **timing))
    return started


def run_all(
    spark: SparkSession,
    configs: Sequence[SourceConfig],
    *,
    available_now: bool = False,
    interval: str = vocabulary.TRIGGER_INTERVAL,
    restarts: int = 0,
) -> list[StreamingQuery]:
    """Run all sources side by side.

    Continuous runs return when any query ends; ``available_now`` runs return
    when all have worked off their input. A source that fails is started again from its checkpoint
    up to ``restarts`` times, the others going on meanwhile; then its error is raised.
    """

    def start(config: SourceConfig) -> list[StreamingQuery]:
        return harmonize_stream(spark, config, available_now=available_now, interval=interval)

    running = {config.name: start(config) for config in configs}
    left = {config.name: restarts for config in configs}
    while True:
        for config in configs:
            failed = next((q for q in running[config.name] if not q.isActive and q.exception() is not None), None)
            if failed is None:
                continue
            if left[config.name] == 0:
                raise failed.exception()
            left[config.name] -= 1
            for query in running[config.name]:
                query.stop()
            running[config.name] = start(config)
        active = [q for queries in running.values() for q in queries if q.isActive]
        ended = [q for queries in running.values() for q in queries if not q.isActive and q.exception() is None]
        if not active or (ended and not available_now):
            if all(q.exception() is None for queries in running.values() for q in queries):
                return [q for queries in running.values() for q in queries]
            continue
        # Wakes up when this one ends, or after a while to look at the others.
        try:
            active[0].awaitTermination(_WATCH_SECONDS)
        except StreamingQueryException:
            pass
