"""Property graph and labelled edge tables from triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import local_name


def route_triples(triples: DataFrame, *kept: str) -> DataFrame:
    """Local names plus ``route``: what a triple adds to the property graph, null if nothing; and the columns ``kept``.

    The local predicate name is searched for ``hasDisease``, ``hasDisaster`` and
    ``title``, in this order.
    """
    p = local_name(F.col("p"))
    route = (
        F.when(F.contains(p, F.lit("hasDisease")), "HAS_DISEASE")
        .when(F.contains(p, F.lit("hasDisaster")), "HAS_DISASTER")
        .when(F.contains(p, F.lit("title")), "POLICY")
    )
    return triples.select(
        local_name(F.col("s")).alias("src"), p.alias("p"), local_name(F.col("o")).alias("dst"), route.alias("route"), *kept
    )


def property_nodes(triples: DataFrame) -> DataFrame:
    """Distinct ``(label, name)`` of places, diseases, disasters and policies."""
    node = lambda label, name: F.struct(F.lit(label).alias("label"), F.col(name).alias("name"))
    routed = route_triples(triples).where(F.col("route").isNotNull())
    nodes = (
        F.when(F.col("route") == "HAS_DISEASE", F.array(node("District", "src"), node("Disease", "dst")))
        .when(F.col("route") == "HAS_DISASTER", F.array(node("District", "src"), node("Disaster", "dst")))
        .otherwise(F.array(node("Policy", "src")))
    )
    return routed.select(F.inline(nodes)).distinct()


def property_edges(triples: DataFrame) -> DataFrame:
    """Distinct ``(src_label, src, type, dst_label, dst)``."""
    routed = route_triples(triples).where(F.col("route").isin("HAS_DISEASE", "HAS_DISASTER"))
    target = F.when(F.col("route") == "HAS_DISEASE", "Disease").otherwise("Disaster")
    return routed.select(
        F.lit("District").alias("src_label"),
        "src",
        F.col("route").alias("type"),
        target.alias("dst_label"),
        "dst",
    ).distinct()


def property_graph(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    return property_nodes(triples), property_edges(triples)


def edge_table(triples: DataFrame) -> DataFrame:
    """One labelled edge ``(src, dst, label)`` per pair; of several labels the largest."""
    edges = triples.select(
        local_name(F.col("s")).alias("src"), local_name(F.col("o")).alias("dst"), local_name(F.col("p")).alias("label")
    )
    return edges.groupBy("src", "dst").agg(F.max("label").alias("label"))


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Distinct names at either end of an edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
