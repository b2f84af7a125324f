"""A Merkle manifest of a dataset: a digest of each row, a tree over each source, a tree over the sources.

A leaf is the SHA-256 of the row's columns; the leaves of a source are ordered by id, and every
three consecutive nodes become one until one is left, the digest of the source. The digests of the sources become the
root in the same way. Every row gets its proof, the siblings on its way to the root, and the root
recomputed from its leaf and those siblings.

Leaves are placed by one sort of digests over the whole table, so a source with a third of all rows is cut into as many
superblocks as it needs: 3^8 consecutive nodes (``levels`` = 8), whose tree is the same whatever lies around them. Upwards, each
superblock is reduced to one node, and these are the nodes of the next tier, until one is left of each source. Downwards,
the nodes of a tier and the outer nodes their superblock needs are cogrouped by superblock, which finishes
the local reduction and joins proofs and folds them in one task of at most 6,561 nodes. Texts are read once.

Defined cases: a null column is ``-`` in a leaf, an empty one ``0:``; null ids come first in a source, null sources are a
source and come first; rows with the same id are ordered by leaf, repeated rows are leaves of their own; a source of one
row has its leaf as digest, a single source's digest is the root; an empty table gives an empty table; other
columns of the table do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epilink.llm.ranks import marked, ranked
from epilink.llm.tables import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels of a superblock.
FAN, LEVELS = 3, 8
_DIGEST = 32


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """SHA-256 (binary) of the columns, each written with its length."""
    return F.unhex(F.sha2(F.concat(*map(_field, columns)), 256))


def _join(digests: list[bytes]) -> bytes:
    """The node over ``digests``, which are hashed as hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def local_tree(digests: list[bytes], size: int, levels: int) -> list[list[bytes]]:
    """The tree over a superblock, from its nodes up: to a single node if it is the whole tree of ``size`` nodes, else ``levels`` up."""
    tree = [digests]
    while len(tree[-1]) > 1 if size <= FAN**levels else len(tree) <= levels:
        last = tree[-1]
        tree.append([_join(last[i : i + FAN]) for i in range(0, len(last), FAN)])
    return tree


def siblings(tree: list[list[bytes]], i: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """What stands before and after node ``i`` in its run, and so on up its way."""
    for nodes in tree[:-1]:
        run = i - i % FAN
        yield nodes[run:i], nodes[i + 1 : run + FAN]
        i //= FAN


def pack(steps) -> bytes:
    """Steps of a proof as bytes: the numbers of digests before and after, and the digests."""
    return b"".join(bytes((len(a), len(b))) + b"".join(a) + b"".join(b) for a, b in steps)


def unpack(path: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    out, at = [], 0
    while at < len(path):
        n = [path[at], path[at + 1]]
        at += 2
        sides = []
        for k in n:
            sides.append([path[at + j * _DIGEST : at + (j + 1) * _DIGEST] for j in range(k)])
            at += k * _DIGEST
        out.append((sides[0], sides[1]))
    return out


def fold(node: bytes, steps) -> bytes:
    """The root over ``node`` and the siblings of each step."""
    for before, after in steps:
        node = _join([*before, node, *after])
    return node


def _by_block(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.floor(F.col("place") / FAN**levels)).groupBy("tree", "block")


_NODES = "tree long, place long, size long, node binary"


def _reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """The nodes of the next tier: one for each superblock of ``nodes`` (``tree, place, size, node``)."""

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("place")
        size = int(own["size"].iloc[0])
        top = local_tree(list(own["node"]), size, levels)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "size": [-(-size // FAN**levels)], "node": [top]})

    return _by_block(nodes.select("tree", "place", "size", "node"), levels).applyInPandas(run, _NODES)


def _tiers(nodes: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """``nodes`` and the tiers above it, until every tree has one node. One number a tier comes to the driver."""
    tiers = [nodes]
    while (tiers[-1].agg(F.max("size")).first()[0] or 1) > 1:
        tiers.append(stored(_reduced(tiers[-1], levels), label))
    return tiers


_PATHS = "tree long, place long, node binary, path binary, root binary"


def _paths(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """``tree, place, node, path, root`` of the nodes of a tier; ``outer`` has ``path`` and ``root`` of their superblocks."""

    def run(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("place")
        tree = local_tree(list(own["node"]), int(own["size"].iloc[0]), levels)
        beyond, root = above["path"].iloc[0], above["root"].iloc[0]
        paths = [pack(siblings(tree, i)) + beyond for i in range(len(own))]
        return pd.DataFrame({"tree": own["tree"], "place": own["place"], "node": own["node"], "path": paths, "root": [root] * len(own)})

    blocks = outer.select("tree", F.col("place").alias("block"), "path", "root")
    return _by_block(nodes, levels).cogroup(blocks.groupBy("tree", "block")).applyInPandas(run, _PATHS)


_PROOFS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proved(leaves: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """The rows of the manifest, ids as text, as pandas has no whole numbers beside nulls; ``outer`` has ``path``, ``root`` and ``subroot`` of the superblocks of the leaves."""

    def run(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("place")
        nodes = list(own["node"])
        tree = local_tree(nodes, int(own["size"].iloc[0]), levels)
        beyond, root = unpack(above["path"].iloc[0]), above["root"].iloc[0]
        proofs, folded = [], []
        for i, (node, found) in enumerate(zip(nodes, own["found"])):
            steps = [*siblings(tree, i), *beyond]
            proofs.append(hashlib.sha256(b"".join(b"".join(a) + b"".join(b) for a, b in steps).hex().encode()).hexdigest())
            folded.append(fold(found if found is not None else node, steps))
        n = len(nodes)
        return pd.DataFrame(
            {
                "doc_id": own["doc_id"],
                "leaf": [x.hex() for x in nodes],
                "subroot": [above["subroot"].iloc[0].hex()] * n,
                "root": [root.hex()] * n,
                "proof_sha256": proofs,
                "folded_root": [x.hex() for x in folded],
                "verified": [x == root for x in folded],
            }
        )

    blocks = outer.select("tree", F.col("place").alias("block"), "path", "root", "subroot")
    rows = _by_block(leaves.select("tree", "place", "size", "node", "found", F.col("doc_id").cast("string").alias("doc_id")), levels)
    return rows.cogroup(blocks.groupBy("tree", "block")).applyInPandas(run, _PROOFS)


def placed_leaves(docs: DataFrame, found: Column | None = None, columns: tuple[str, ...] = COLUMNS, source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``tree`` (number of the source), ``place`` in it, ``size``, ``node`` (the leaf), ``found`` and ``doc_id`` of every row.

    ``found`` is the leaf that a check finds now, null where it is the recorded one.
    """
    found = F.lit(None).cast("binary") if found is None else found
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), leaf([F.col(c) for c in columns]).alias("node"), found.alias("found"))
    laid = ranked(marked(rows, "leaves"), ["source", "doc_id", "node", "_row"], "placed")
    sources = stored(laid.groupBy("source").agg(F.min("_place").alias("_begin"), F.count("*").alias("size")), "sources")
    sources = ranked(sources, ["_begin"], "trees").select(F.col("source").alias("_source"), "_begin", "size", F.col("_place").alias("tree"))
    placed = laid.join(sources, F.col("source").eqNullSafe(F.col("_source")))
    return placed.select("tree", (F.col("_place") - F.col("_begin")).alias("place"), "size", "node", "found", "doc_id")


def manifest(
    docs: DataFrame,
    found: Column | None = None,
    columns: tuple[str, ...] = COLUMNS,
    source_col: str = "source",
    id_col: str = "doc_id",
    levels: int = LEVELS,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row, digests in hexadecimal.

    ``folded_root`` is recomputed from ``found`` (see :func:`placed_leaves`) where that is not null, else from the leaf, and
    the recorded siblings; ``verified`` says whether it is the root.
    """
    leaves = stored(placed_leaves(docs, found, columns, source_col, id_col), "tree-leaves")
    tiers = _tiers(leaves, levels, "tier")
    tops = tiers[-1]
    n = tops.count()
    upper = _tiers(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n).cast("long").alias("size"), "node"), levels, "upper")
    above = upper[-1].select("tree", "place", "node", F.lit("").cast("binary").alias("path"), F.col("node").alias("root"))
    for tier in reversed(upper[:-1]):
        above = _paths(tier, above, levels)
    # What is beyond the top of each source's tree.
    roots = stored(above.select(F.col("place").alias("tree"), F.col("node").alias("subroot"), "path", "root"), "roots")
    above = roots.select("tree", F.lit(0).cast("long").alias("place"), "path", "root")
    for tier in reversed(tiers[1:-1]):
        above = _paths(tier, above, levels)
    above = above.select("tree", "place", "path", "root").join(roots.select("tree", "subroot"), "tree")
    proved = _proved(leaves, stored(above, "outer"), levels)
    return proved.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
