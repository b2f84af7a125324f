"""Mixing sources to target weights by temperature.

The token shares ``p`` of the sources are raised to an exponent ``t`` and normalised. The
exponent is found by bisection: the largest in 0 to 1 at which the entropy of the weights reaches
a target, and no less than the one at which no source is repeated more than a limit. The weights
are then realised: each source is dealt by hash into blocks of a bounded number of documents; a
source that is to be seen ``e`` times gives every document ``floor(e)`` times and, in each block,
the documents that come first in a permutation of the block until the rest of its token budget
is used up.

All sums are per source or per block, so a source that holds most of the rows is spread over as
many blocks, and tasks, as it has documents for. Only a fixed number of sums comes to the driver.

Defined cases: a null source is a source of its own; a null or empty text has no tokens, and is
seen as often as whole passes are made of its source; a source without any tokens has weight 0
and is passed once; a single source has weight 1; an unreachable target gives the nearest
exponent (0 or 1); repeated rows are documents of their own; empty tables give empty tables.
"""

from __future__ import annotations

from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilink.llm.tables import row_key, stored

#: Share of the largest possible entropy (that of equal weights) that the weights should reach.
ENTROPY = 0.97
#: How often the documents of a source may be seen for one pass of the least repeated source.
REPEATS = 4.0
#: Documents in a block, on average.
BLOCK_ROWS = 500
#: Exponents tried at once, and rounds: the interval is cut to a 32nd each time.
_WAYS, _ROUNDS = 32, 6


def tokens(text_col: str = "text"):
    """Tokens of a text: its words between white space."""
    return F.coalesce(F.size(F.filter(F.split(text_col, r"\s+"), lambda w: w != "")), F.lit(0)).cast("long")


def exponent(sources: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The exponent for the sources ``(source, tokens)``."""
    row = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count("*")).first()
    if not row[0] or row[3] < 2:
        return 1.0
    total, least, most, n = row
    share = F.col("tokens") / F.lit(float(total))
    lo, hi = 0.0, 1.0
    for _ in range(_ROUNDS):
        tried = [lo + (hi - lo) * k / _WAYS for k in range(_WAYS + 1)]
        # One row for each exponent: a plan of one sum for each would take the driver a class of its own in every round.
        each = sources.select(share.alias("p"), F.posexplode(F.lit(tried)).alias("k", "t")).groupBy("k")
        each = each.agg(F.sum(F.pow("p", "t")).alias("z"), F.sum(F.pow("p", "t") * F.log("p")).alias("weighted")).collect()
        sums = {r.k: (r.z, r.weighted) for r in each}
        # Entropy of p^t / z is log z - t * sum(p^t log p) / z, and falls as t grows.
        reached = [_entropy(*sums[k], t) >= entropy * log(n) for k, t in enumerate(tried)]
        last = max((k for k, ok in enumerate(reached) if ok), default=0)
        lo, hi = tried[last], tried[min(last + 1, _WAYS)]
        if lo == hi:
            break
    # Passes are (least / most)^(t - 1) apart.
    limit = 1.0 - log(repeats) / log(most / least) if most > least else 0.0
    return min(1.0, max(lo, limit))


def _entropy(z: float, weighted: float, t: float) -> float:
    return log(z) - t * weighted / z


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    entropy: float = ENTROPY,
    repeats: float = REPEATS,
    budget: float | None = None,
    block_rows: int = BLOCK_ROWS,
    seed: int = 1,
) -> DataFrame:
    """One row per copy in the mixture: ``doc_id, source, tokens, weight, passes, epoch, block, position``.

    ``budget`` is the number of tokens of the mixture; by default the smallest at which every
    document is seen at least once. ``epoch`` counts the passes over a source from 0, ``position``
    the copies within the block of an epoch.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), tokens(text_col).alias("tokens"), F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text_col)).alias("_order"))
    own = stored(own, "tokens")
    sizes = stored(own.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("_rows")), "sources")
    full = sizes.filter("tokens > 0")
    t = exponent(full, entropy, repeats)
    total = full.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(total or 1))
    z, most = full.agg(F.sum(F.pow(share, F.lit(t))), F.max(F.pow(share, F.lit(1.0 - t)))).first() if total else (1.0, 1.0)
    tokens_wanted = float(budget) if budget is not None else total * z * most
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(t)) / F.lit(z)).otherwise(0.0)
    passes = F.when(F.col("tokens") > 0, F.round(weight * F.lit(tokens_wanted) / F.col("tokens"), 9)).otherwise(1.0)
    plan = sizes.select(
        row_key("source").alias("_source"), weight.alias("weight"), passes.alias("passes"), F.ceil(F.col("_rows") / block_rows).alias("_blocks")
    )
    placed = own.withColumn("_source", row_key("source")).join(plan, "_source").withColumn("block", F.pmod(F.xxhash64("_order"), F.col("_blocks")))
    in_block = Window.partitionBy("_source", "block").orderBy("_order", "doc_id")
    whole = in_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = placed.select(
        "*",
        F.row_number().over(in_block).alias("position"),
        F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_upto"),
        F.sum("tokens").over(whole).alias("_all"),
    )
    epochs = F.floor("passes")
    # In the last, partial pass a document is in if the budget of its block reaches beyond its middle.
    partial = (F.col("_upto") - F.col("tokens") / 2) < F.col("_all") * (F.col("passes") - epochs)
    copies = epochs + F.when(partial, 1).otherwise(0)
    return placed.filter(copies > 0).select(
        "doc_id", "source", "tokens", "weight", "passes", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("epoch"), "block", "position"
    )
