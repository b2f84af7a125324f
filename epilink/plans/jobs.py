"""Jobs over harmonised tables in a base folder: link, graph, summaries, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas, vocabulary
from ..operators.aggregates import summaries
from ..operators.graph import edge_table, property_graph, route_triples
from ..operators.link import can_link, link_sources
from ..operators.metrics import summarize_metrics
from ..operators.patterns import policy_status
from ..operators.triples import knowledge_graph
from ..sinks import merge_graph, write_graph, write_ntriples, write_rdfxml, write_table, write_turtle
from ..sources import read_graph, read_metrics, read_optional, read_statistics

LINKED_FOLDER = "cross_source_linked/linked.parquet"


def _table(spark: SparkSession, base: str, kind: str) -> DataFrame:
    return read_optional(spark, base, vocabulary.TABLE_FOLDERS[kind], schemas.harmonised(kind))


def link_job(spark: SparkSession, base: str, out: str | None = None, **options) -> str | None:
    """Write the linked table and return its path; nothing without cases and weather."""
    cases, weather, alerts = (_table(spark, base, kind) for kind in ("surveillance", "weather", "alerts"))
    if not can_link(cases, weather):
        return None
    return write_table(link_sources(cases, weather, alerts, **options), out or f"{base}/{LINKED_FOLDER}")


#: Folder of the stored graph below the folder of its text forms.
STORE_FOLDER = "store"


def graph_job(
    spark: SparkSession, base: str, out: str, ns: str = vocabulary.NAMESPACE, formats: tuple[str, ...] = ("nt", "ttl", "rdf")
) -> int:
    """Merge the graph of the tables into the stored one, export that in each format, return its number of triples."""
    tables = [_table(spark, base, kind) for kind in ("surveillance", "weather", "alerts", "policy")]
    store = f"{out}/{STORE_FOLDER}"
    merge_graph(knowledge_graph(*tables, ns=ns), store)
    triples = read_graph(spark, store)
    if "nt" in formats:
        write_ntriples(triples, f"{out}/knowledge_graph.nt")
    if "ttl" in formats:
        write_turtle(triples, f"{out}/knowledge_graph.ttl", ns)
    if "rdf" in formats:
        write_rdfxml(triples, f"{out}/knowledge_graph.rdf", ns)
    return triples.count()


def property_graph_job(spark: SparkSession, graph: str, out: str) -> tuple[str, str]:
    """A stored graph (or N-Triples files) to node and edge tables, replacing what is there."""
    return write_graph(*property_graph(_routed(spark, graph)), out)


def _routed(spark: SparkSession, graph: str) -> DataFrame:
    """The triples of a graph that may add to the property graph; of a stored one only their predicates are read."""
    triples, statistics = read_graph(spark, graph), read_statistics(spark, graph)
    if statistics is None:
        return triples
    predicates = spark.createDataFrame([(p,) for p in statistics], "p string")
    named = predicates.select(F.lit("").alias("s"), "p", F.lit("").alias("o"), F.col("p").alias("whole"))
    routed = route_triples(named, "whole").where(F.col("route").isNotNull()).collect()
    return triples.where(F.col("p").isin([r.whole for r in routed]))


def edge_job(spark: SparkSession, graph: str, out: str) -> str:
    """A stored graph (or N-Triples files) to the labelled edge table."""
    return write_table(edge_table(read_graph(spark, graph)), out)


def policy_job(spark: SparkSession, graph: str, ns: str = vocabulary.NAMESPACE) -> DataFrame:
    """Policies of a stored graph (or N-Triples files); of a stored one two predicates are read."""
    return policy_status(read_graph(spark, graph), ns, read_statistics(spark, graph))


def summary_job(spark: SparkSession, base: str, out: str | None = None) -> dict[str, DataFrame]:
    """The three summary tables, also written if ``out`` is given."""
    tables = summaries(*(_table(spark, base, kind) for kind in ("surveillance", "weather", "alerts")))
    if out is not None:
        for name, table in tables.items():
            write_table(table, f"{out}/{name}")
    return tables


def metrics_job(spark: SparkSession, log: str) -> DataFrame:
    return summarize_metrics(read_metrics(spark, log))
