"""Exactly-once writes of a stream's batches, with few files, merged level by level."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import MapType

from ..sources.batches import Entry, entries, live, log_folder, read_batches

# A partition value of a write gets one file for so many rows, and no more files than FILES_PER_KEY.
ROWS_PER_FILE = 1_000_000
FILES_PER_KEY = 16
# Writes of one level that are merged into one of the next.
FAN_IN = 8


def spread(df: DataFrame, key: str, rows_per_file: int = ROWS_PER_FILE, files_per_key: int = FILES_PER_KEY) -> DataFrame:
    """``df`` laid out so that a write by ``key`` makes few files: one for each value, more for one with many rows.

    Only values with more than ``rows_per_file`` rows are broadcast, of which there is at most one for so many rows.
    Rows of such a value are dealt over its files by their content, so a retried task deals them alike.
    """
    hashed = [f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, MapType)]
    value, n, salt = (_free(name, df.columns) for name in ("_key", "_n", "_salt"))
    large = df.groupBy(F.col(key).alias(value)).agg(F.count("*").alias(n)).where(F.col(n) > rows_per_file)
    files = F.least(F.ceil(F.col(n) / rows_per_file), F.lit(files_per_key))
    salted = df.join(F.broadcast(large), F.col(key).eqNullSafe(F.col(value)), "left").withColumn(
        salt, F.coalesce(F.pmod(F.xxhash64(*hashed), files), F.lit(0))
    )
    return salted.repartition(F.col(key), F.col(salt)).drop(value, n, salt)


def _free(name: str, taken: list[str]) -> str:
    return _free(f"_{name}", taken) if name in taken else name


Arrange = Callable[[DataFrame], DataFrame]


def _write(
    df: DataFrame, path: str, level: int, first: int, last: int, key: str | None, failed: Column | int, arrange: Arrange | None, beside: Callable[[Entry], None] | None, **layout
) -> Entry:
    """Write rows to a folder of their own, what goes ``beside`` them, then the entry that makes them count."""
    # Each attempt has its own folder, so nothing that a reader may see is ever overwritten.
    name = f"{level}-{first}-{last}-{uuid.uuid4().hex[:12]}"
    counted = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if isinstance(failed, Column):
        counts.append(F.count(F.when(failed, 1)).alias("failed"))
    laid = arrange(df) if arrange else spread(df, key, **layout) if key else df
    writer = laid.observe(counted, *counts).write.mode("errorifexists")
    (writer.partitionBy(key) if key else writer).parquet(f"{path}/data/batch={name}")
    seen = counted.get
    entry = Entry(level, first, last, name, seen["rows"], seen["failed"] if isinstance(failed, Column) else failed, df.schema.json())
    if beside is not None:
        beside(entry)
    commit(df.sparkSession, path, entry)
    return entry


def commit(spark: SparkSession, path: str, entry: Entry) -> None:
    """Add an entry to the log: one file, which is there as a whole or not at all."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in entry.as_dict().items()], F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("overwrite").json(f"{log_folder(path)}/{_entry_name(entry)}")


def write_batch(
    df: DataFrame, batch_id: int, path: str, key: str | None = None, failed: Column | int = 0, *, arrange: Arrange | None = None, beside=None, **layout
) -> Entry | None:
    """Append a batch once: a batch whose id is committed already adds nothing and gives none.

    ``failed`` marks rows that are counted apart in the log; ``arrange`` lays out the rows otherwise than :func:`spread`;
    ``beside`` is called with the entry before it counts. The ids are those of one checkpoint; a stream that begins
    anew with an empty checkpoint needs an empty table.
    """
    done = entries(df.sparkSession, path)
    if any(e.first <= batch_id <= e.last for e in done):
        return None
    return _write(df, path, 0, batch_id, batch_id, key, failed, arrange, beside, **layout)


def compact(
    spark: SparkSession, path: str, key: str | None = None, fan_in: int = FAN_IN, *, arrange: Arrange | None = None, beside=None, **layout
) -> list[Entry]:
    """Merge every ``fan_in`` neighbouring writes of a level into one of the next, until no level has so many.

    A row is rewritten once a level, so the work per row grows with the logarithm of the number of batches. Readers see
    the old folders until the new entry is there; :func:`clean_up` deletes them later.
    """
    made: list[Entry] = []
    while True:
        current = live(entries(spark, path))
        runs = [current[i : i + fan_in] for i in range(len(current) - fan_in + 1)]
        run = next((r for r in runs if len({e.level for e in r}) == 1), None)
        if run is None:
            return made
        rows = read_batches(spark, path, only=run)
        made.append(_write(rows, path, run[0].level + 1, run[0].first, run[-1].last, key, sum(e.failed for e in run), arrange, beside, **layout))


def replace_all(df: DataFrame, path: str, key: str | None = None, **options) -> Entry:
    """Make ``df`` all that the table holds. Readers see the old rows until the new entry is there, then the new ones."""
    found = entries(df.sparkSession, path)
    level, last = max((e.level + 1 for e in found), default=0), max((e.last for e in found), default=0)
    return _write(df, path, level, 0, last, key, 0, options.pop("arrange", None), options.pop("beside", None), **options)


def clean_up(spark: SparkSession, path: str, older_than_seconds: float = 7 * 24 * 3600) -> list[str]:
    """Delete what no reader needs any more, and give its names: entries and folders replaced so long ago, and folders
    of writes that began so long ago and never got an entry."""
    found = entries(spark, path)
    before = spark._jvm.java.lang.System.currentTimeMillis() - int(older_than_seconds * 1000)
    logged = _folders(spark, log_folder(path))
    old = [e for e in found if logged[_entry_name(e)][1] <= before]
    kept = [e for e in found if not any(o.covers(e) for o in old)]
    gone = []
    for folder, names in ((log_folder(path), {_entry_name(e) for e in kept}), *((f"{path}/{d}", {f"batch={e.batch}" for e in kept}) for d in ("data", "beside"))):
        replaced = {f"batch={e.batch}" for e in found} | {_entry_name(e) for e in found}
        for name, (status, changed) in _folders(spark, folder).items():
            if name not in names and (name in replaced or changed <= before):
                status.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(status.getPath(), True)
                gone.append(name)
    return gone


def _entry_name(entry: Entry) -> str:
    return f"{entry.level}-{entry.first}-{entry.last}"


def _folders(spark: SparkSession, path: str) -> dict:
    """The folders below ``path`` by name, each with the time of its last change."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(root) if fs.exists(root) else []
    return {s.getPath().getName(): (s, s.getModificationTime()) for s in found if s.isDirectory()}
