"""Batch scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas
from .payloads import explode_json_map


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path is there, on whatever file system its scheme names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    """True if the path, which is there, is a folder."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jvm_path).isDirectory()


def read_table(
    spark: SparkSession,
    base: str,
    name: str | None = None,
    *,
    recursive: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Scan a Parquet table below ``base``.

    ``recursive`` takes every file under the folder as one table and leaves the
    partition folders' values out.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.parquet(f"{base}/{name}" if name else base)


def read_optional(spark: SparkSession, base: str, name: str, schema: StructType) -> DataFrame:
    """Scan a table, or give an empty one of the same schema where it is missing.

    Of a table that a stream writes by batches only committed writes are read.
    """
    from .batches import is_batch_table, read_batches

    path = f"{base}/{name}"
    if is_batch_table(spark, path):
        return read_batches(spark, path, schema)
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Run log, one JSON object per line; no rows where there is none yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.METRICS)
    return spark.read.schema(schemas.METRICS).json(path)


def read_json_map(spark: SparkSession, path: str, value_schema: StructType = schemas.COORDINATES) -> DataFrame:
    """One JSON object ``key -> struct`` as rows ``(key, <struct fields>)``; no rows where there is no file.

    A JSON object is one value and so one task's work: write a dictionary that has grown
    large to a table once (``write_table``) and read that in parallel.
    """
    if path_exists(spark, path):
        text = spark.read.text(path, wholetext=True)
    else:
        text = spark.createDataFrame([], "value string")
    return explode_json_map(text, "value", value_schema).drop("value")


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """A graph stored by predicate."""
    return read_table(spark, path, schema=schemas.TRIPLES).select(*schemas.TRIPLES.names)
