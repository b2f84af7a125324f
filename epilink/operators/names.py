"""Place-name resolution: exact alias, alias without blanks, containment, else title case."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import vocabulary
from ..functions.text import normalize_name, python_strip, python_title, squeeze
from ..session import settle
from .lookup import BROADCAST_LIMIT_BYTES, left_lookup, marked, measured_bytes

# Length of the pieces by which containment finds its candidates.
GRAM = 3

_RESOLVED = ["canonical", "province", "matched"]


def alias_table(
    spark: SparkSession, places: Iterable[tuple[str, str, Sequence[str]]] = vocabulary.PLACES
) -> DataFrame:
    """Dictionary ``(alias, canonical, province, rank)``; rank is the match order."""
    rows = [(alias, canonical, province) for canonical, province, aliases in places for alias in aliases]
    ranked = [(*row, rank) for rank, row in enumerate(rows)]
    return spark.createDataFrame(ranked, "alias STRING, canonical STRING, province STRING, rank INT")


def _by_alias(aliases: DataFrame) -> DataFrame:
    """One row per normalised alias: its first rank decides the order, its last entry the place."""
    return (
        aliases.select(normalize_name(F.col("alias")).alias("alias"), "canonical", "province", "rank")
        .where(F.col("alias").isNotNull())
        .groupBy("alias")
        .agg(
            F.min("rank").alias("rank"),
            F.max("rank").alias("last"),
            F.max_by(F.struct("canonical", "province"), "rank").alias("place"),
        )
    )


def _by_tight_alias(exact: DataFrame) -> DataFrame:
    """The same without blanks; of several aliases that coincide the last entry counts."""
    return exact.groupBy(squeeze(F.col("alias")).alias("alias")).agg(F.max_by("place", "last").alias("place"))


def _has_text(name: Column) -> Column:
    return name.isNotNull() & (name != "")


def _finished(df: DataFrame, name_col: str, kept: list[str]) -> DataFrame:
    """The kept columns and the result columns, from the place found (``_place``) or the name itself."""
    # Stripped in a projection of its own: the title case below looks at it several times.
    ready = df.select(*kept, "_place", python_strip(F.col(name_col)).alias("_stripped"))
    has_text = _has_text(F.col(name_col))
    found = F.col("_place").isNotNull() & has_text
    return ready.select(
        *kept,
        F.when(found, F.col("_place.canonical"))
        .when(has_text, python_title(F.col("_stripped")))
        .otherwise(F.lit(vocabulary.UNKNOWN))
        .alias("canonical"),
        F.when(found, F.col("_place.province")).otherwise(F.lit(vocabulary.UNKNOWN)).alias("province"),
        found.alias("matched"),
    )


def resolve_names(df: DataFrame, name_col: str, aliases: DataFrame | None = None, *, min_len: int = 0) -> DataFrame:
    """Add ``canonical``, ``province`` and ``matched`` for a raw place name.

    Steps, first hit wins: normalised name is an alias; the same without blanks;
    an alias contains the name or is contained in it (lowest rank wins); else the
    name in title case with province ``UNKNOWN``. Empty names give ``UNKNOWN``.
    A name that normalises to nothing is contained in every alias, so it takes
    the first one; ``min_len`` sets how long the shorter text of a containment
    must be.

    Every step is an equi-join on the distinct names, whatever the size of the dictionary; the rows
    meet one table of names, which is broadcast if it measures small.
    """
    exact = settle(_by_alias(aliases if aliases is not None else alias_table(df.sparkSession)))
    small = measured_bytes(exact) <= BROADCAST_LIMIT_BYTES
    by_exact = exact.select(F.col("alias").alias("_norm"), F.col("place").alias("_exact"))
    by_tight = _by_tight_alias(exact).select(F.col("alias").alias("_tight_name"), F.col("place").alias("_tight"))
    tried = settle(
        df.select(F.col(name_col).alias("_name"))
        .where(_has_text(F.col("_name")))
        .distinct()
        .withColumn("_norm", normalize_name(F.col("_name")))
        .withColumn("_tight_name", squeeze(F.col("_norm")))
        .join(marked(by_exact, small), "_norm", "left")
        .join(marked(by_tight, small), "_tight_name", "left")
        .select("_name", "_norm", F.coalesce("_exact", "_tight").alias("_place"))
    )
    rest = tried.where(F.col("_place").isNull()).select("_norm").distinct()
    contained = first_related(rest, exact, min_len)
    mapping = (
        tried.join(contained, "_norm", "left")
        .select(F.col("_name").alias(name_col), F.coalesce(F.col("_place"), F.col("hit.place")).alias("_place"))
        .where(F.col("_place").isNotNull())
    )
    kept = [c for c in df.columns if c not in _RESOLVED]
    joined = left_lookup(df.select(*kept), mapping, [name_col])
    return _finished(joined, name_col, kept)


def first_related(names: DataFrame, exact: DataFrame, min_len: int = 0) -> DataFrame:
    """``(_norm, hit)``: of the aliases that contain a name or are contained in it the one with the lowest rank."""
    hits = exact.select("alias", F.struct("rank", "alias", "place").alias("hit"))
    own, listed = names.select(F.col("_norm").alias("text")), hits.select(F.col("alias").alias("text"))
    alias_in_name = containments(listed.where(F.length("text") >= min_len), own).select(
        F.col("inner").alias("alias"), F.col("outer").alias("_norm")
    )
    name_in_alias = containments(own.where(F.length("text") >= min_len), listed).select(
        F.col("outer").alias("alias"), F.col("inner").alias("_norm")
    )
    found = alias_in_name.unionByName(name_in_alias).join(marked(hits, False), "alias").select("_norm", "hit")
    if min_len <= 0:
        # The empty text is contained in every text; there is one empty alias and one empty name at most.
        empty = hits.where(F.col("alias") == "").select(F.lit("").alias("_any"), "hit")
        any_alias = names.withColumn("_any", F.lit("")).join(F.broadcast(empty), "_any").select("_norm", "hit")
        whole = hits.agg(F.min("hit").alias("hit")).select(F.lit("").alias("_norm"), "hit").where(F.col("hit").isNotNull())
        found = found.unionByName(any_alias).unionByName(names.join(F.broadcast(whole), "_norm").select("_norm", "hit"))
    return found.groupBy("_norm").agg(F.min("hit").alias("hit"))


def containments(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """``(inner, outer)``: pairs of distinct texts (``text``) of both sides in which the inner one lies in the outer one.

    The pieces of ``GRAM`` characters of the outer texts are listed. An inner text must have all its pieces in an outer one, so it
    looks only at those that hold its rarest piece, and the pair is then tested. A text shorter than a piece is a piece itself;
    empty texts are left out. There are many more pieces than texts, so no side of these joins is broadcast.
    """
    places = F.sequence(F.lit(0), F.length("text") * GRAM - 1)
    size, start = F.col("_at") % GRAM + 1, F.floor(F.col("_at") / GRAM).cast("int") + 1

    def pieces(texts: DataFrame) -> DataFrame:
        cut = texts.where(F.length("text") > 0).select("text", F.explode(places).alias("_at"))
        fits = start + size - 1 <= F.length("text")
        return cut.where(fits).select("text", size.alias("size"), F.substring(F.col("text"), start, size).alias("piece"))

    held = pieces(outer).select("piece", F.col("text").alias("outer"))
    often = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    own = pieces(inner).where(F.col("size") == F.least(F.length("text"), F.lit(GRAM)))
    known = own.join(marked(often, False), "piece", "left").groupBy("text").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("rarest"))
    # A piece that no outer text has rules out all of them.
    searched = known.where(F.col("rarest.n") > 0).select(F.col("text").alias("inner"), F.col("rarest.piece").alias("piece"))
    return searched.join(marked(held, False), "piece").where(F.contains("outer", F.col("inner"))).select("inner", "outer").distinct()
