"""Reading a stored graph: triples by predicate, and statistics of the predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.patterns import PredicateStatistics
from .batches import entries, is_batch_table, live, read_batches
from .ntriples import read_ntriples

SKETCHES = "p STRING, rows LONG, subjects BINARY, objects BINARY"


def read_graph(spark: SparkSession, path: str) -> DataFrame:
    """Triples of a stored graph, or of N-Triples files where ``path`` holds those."""
    if is_batch_table(spark, path):
        return read_batches(spark, path, schemas.TRIPLES)
    return read_ntriples(spark, path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """``p, rows, subjects, objects`` (sketches) of each write that counts."""
    folders = [f"{path}/beside/batch={e.batch}" for e in live(entries(spark, path))]
    return spark.read.schema(SKETCHES).parquet(*folders) if folders else spark.createDataFrame([], SKETCHES)


def united(sketches: DataFrame) -> DataFrame:
    """One row a predicate of the sketches of several writes."""
    return sketches.groupBy("p").agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("subjects").alias("subjects"), F.hll_union_agg("objects").alias("objects")
    )


def read_statistics(spark: SparkSession, path: str) -> dict[str, PredicateStatistics] | None:
    """Statistics of each predicate of a stored graph; none of N-Triples files."""
    if not is_batch_table(spark, path):
        return None
    sizes = united(read_sketches(spark, path)).select("p", "rows", F.hll_sketch_estimate("subjects").alias("s"), F.hll_sketch_estimate("objects").alias("o"))
    return {r.p: PredicateStatistics(r.rows, r.s, r.o) for r in sizes.collect()}
