"""A stored graph that grows by merges.

The graph is a table with a log (see ``sinks.batches``), by predicate and, within it, in ranges of subjects, so a
pattern reads the files of its predicate and a subject few of them. Beside every write lie the number of triples of
each predicate and sketches of its subjects and objects. They add up, so statistics cost no reading of older triples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..session import settle
from ..sources.batches import Entry, entries, read_batches
from .batches import compact, write_batch


def _arranged(triples: DataFrame) -> DataFrame:
    """Ranges of predicate and subject, sorted: a hot predicate or subject is spread over as many tasks as it needs."""
    return triples.repartitionByRange("p", "s", "o").sortWithinPartitions("p", "s")


def _write_sketches(spark: SparkSession, path: str):
    def beside(entry: Entry) -> None:
        sizes = read_batches(spark, path, schemas.TRIPLES, only=[entry]).groupBy("p").agg(
            F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("s").alias("subjects"), F.hll_sketch_agg("o").alias("objects")
        )
        sizes.coalesce(1).write.parquet(f"{path}/beside/batch={entry.batch}")

    return beside


def merge_graph(triples: DataFrame, path: str) -> int:
    """Add the triples that the graph at ``path`` does not hold yet; how many they were.

    Only the folders of their predicates are read. The merge counts as a whole or not at all, and merging the same
    triples again adds nothing.
    """
    spark = triples.sparkSession
    fresh = triples.select(*schemas.TRIPLES.names).distinct()
    done = entries(spark, path)
    if done:
        fresh = new_triples(fresh, read_batches(spark, path, schemas.TRIPLES))
    batch_id = max((e.last for e in done), default=-1) + 1
    options = {"arrange": _arranged, "beside": _write_sketches(spark, path)}
    added = write_batch(settle(fresh), batch_id, path, "p", **options)
    compact(spark, path, "p", **options)
    return added.rows


def new_triples(triples: DataFrame, stored: DataFrame) -> DataFrame:
    """Those of ``triples``, a set, that ``stored`` does not hold; it is read for the predicates of ``triples`` alone."""
    triples = settle(triples)
    predicates = [r.p for r in triples.select("p").distinct().collect()]
    same = lambda df: df.withColumn("_type", F.coalesce("o_datatype", F.lit("")))
    held = same(stored.where(F.col("p").isin(predicates))).drop("o_datatype")
    return same(triples).join(held, ["s", "p", "o", "o_kind", "_type"], "left_anti").select(*triples.columns)
