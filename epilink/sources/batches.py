"""Tables that streams write batch by batch: a log of what counts, and the rows it names.

A table folder holds ``data/batch=<name>/`` folders and ``_log/``, where every committed write has an
entry of its own. An entry covers a range of batch ids; one of a higher level replaces those it
covers. Rows of writes without an entry, or replaced, are not read.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import path_exists

_ENTRY = "level INT, first LONG, last LONG, batch STRING, rows LONG, failed LONG, schema STRING, at TIMESTAMP"


@dataclass(frozen=True)
class Entry:
    """One committed write: batches ``first`` to ``last``, the name of its folder, its rows and how many of them could not be parsed."""

    level: int
    first: int
    last: int
    batch: str
    rows: int
    failed: int
    schema: str

    def covers(self, other: Entry) -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last

    def as_dict(self) -> dict:
        return asdict(self)


def log_folder(path: str) -> str:
    return f"{path}/_log"


def is_batch_table(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, log_folder(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the log of a table, with the time ``at`` of the commit."""
    if not is_batch_table(spark, path):
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).option("recursiveFileLookup", True).json(log_folder(path))


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Entries in the order of their batches; one small row for each write since the last :func:`clean_up`."""
    rows = read_log(spark, path).drop("at").collect()
    return sorted((Entry(**r.asDict()) for r in rows), key=lambda e: (e.first, -e.level, e.last))


def live(found: list[Entry]) -> list[Entry]:
    """The entries that no other one replaces."""
    return [e for e in found if not any(o.covers(e) for o in found)]


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None, only: list[Entry] | None = None) -> DataFrame:
    """Rows of the committed writes of a table, or of the entries ``only``; empty, of ``schema``, where there are none."""
    current = live(entries(spark, path)) if only is None else only
    if schema is None:
        if not current:
            raise ValueError(f"no batches in {path}, so its columns are not known")
        schema = StructType.fromJson(json.loads(current[-1].schema))
    if not current:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/batch={e.batch}" for e in current]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)
