"""Reading and cutting of tables, shared by the operators of this folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilink.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what a stored step has left behind: models, broadcasts and shuffle files.

    Spark deletes those on the executors once the driver has collected its references to them, which a driver with
    little to do may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_key(*cols):
    """One string for a row: null and text parts never coincide, lengths keep the parts apart."""
    parts = []
    for c in cols:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def whole(df: DataFrame):
    """The row as the struct ``_doc``, so that no column of it can clash with others; ``_doc.*`` gives it back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_doc")
