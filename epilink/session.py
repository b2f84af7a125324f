"""Session construction and the shared scratch folder used by jobs that settle data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "epilink", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Cluster facts (master, memory, packages, ``spark.checkpoint.dir``) come from
    spark-submit; only semantics and adaptive execution are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _LOCAL_FOLDER
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.mkdtemp(prefix="epilink-")
    return _LOCAL_FOLDER


_LOCAL_FOLDER: str | None = None


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns do not clash."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
