"""Batch tables, logs and dictionary updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import broadcast_if_small
from ..operators.topn import top_n_per
from ..session import settle


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> str:
    """Write Parquet and return the path.

    With a partition column, rows are rebalanced on it first: adaptive execution
    then writes few files per value and splits a value that holds most of the
    rows over several tasks.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)
    return path


def append_metrics(df: DataFrame, path: str) -> str:
    """Add rows to the run log, one JSON object per line."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path


def upsert_by_key(old: DataFrame, new: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """Dictionary after an update: new entries win, other old ones stay.

    ``old`` has one row per key. Where ``new`` repeats a key, the row with the
    largest ``order_by`` counts; equal ones, or all without ``order_by``, are told
    apart by their content, so reruns agree. The changes are computed once; if their keys are
    few the old side is filtered where it lies and nothing of it is shuffled.
    Write the result to a new path.
    """
    changes = settle(top_n_per(new, [key], [*([F.col(order_by).desc()] if order_by else []), F.to_json(F.struct(*new.columns))], 1))
    kept = old.join(broadcast_if_small(changes.select(key)), key, "left_anti")
    return kept.unionByName(changes)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> tuple[str, str]:
    """Replace the property graph at ``path`` by these nodes and edges."""
    return write_table(nodes, f"{path}/nodes"), write_table(edges, f"{path}/edges")


def write_triples(triples: DataFrame, path: str) -> str:
    """Store a graph by predicate, so that a pattern reads only the files of its own."""
    return write_table(triples, path, "p")
