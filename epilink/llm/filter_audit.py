"""What each of several filters removes, alone and after others, from relations of failing ids.

Every filter has a stored table of the ids that fail it. What a prefix of filters leaves does not
depend on its order, so each set of filters is treated once: its survivors are those of the set
without its last filter, less (left anti join) the ids that fail that filter. For a filter that comes
next, the failing ids that are among the survivors (left semi join) are what it removes, those that are not
(left anti join) were removed before and are redundant there. All orders of the filters read
their steps from these relations. Sets are a column, so that there is one join a level, on set and id,
however many sets there are; ids are unique, so no key is hot.

Rows are numbered when they are read, and these numbers are the ids. Only rows that fail something
take part; the others survive everything and are counted. Equal texts are found by SHA-256, rows of the
most frequent ones by a broadcast of a fixed number of groups, so that a text of a third of all rows is in no one task.
Nothing else is broadcast (``merge`` hints): Spark goes by the size of files, and ids, marks and counts by part are many times
larger in the driver's memory.

The filters of the query (fixed values), on whole texts: ``A`` under 50 words, ``B`` distinct words under 65% of the
words, ``C`` letters A-Z over 5% of the characters, ``D`` any of ``#$%&*|``, ``E`` the text of a smaller id.

Defined cases: a null text counts as empty, a null part as the empty string; a row with a null id has no
smaller id and is no smaller id; rows that repeat id and text do not fail ``E`` because of each other; labels
that come more than once or contradict count as their greatest, null as none; a part whose rows
all pass has zeros; empty tables give empty tables; other columns of the table do not matter, whatever their names.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epilink.llm.ranks import marked
from epilink.llm.tables import stored

FILTERS = "ABCDE"
#: Largest groups of equal texts whose rows are found by a broadcast; every other group is smaller than a thousandth of all rows.
_LARGEST = 1000
#: Parts into which rows that share an id are spread where they meet their label.
_SALTS = 16
_SPACE = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def conditions(text: Column) -> dict[str, Column]:
    """Whether a text (not null) fails the filters that need nothing but the text, from its ``_words`` too."""
    n, distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": n < 50,
        "B": 100 * distinct < 65 * n,
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def facts(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per row of ``docs``: ``_row``, ``doc_id``, ``part``, ``_hash`` and the array ``fails`` of filters but ``E``, ``good``, ``toxic``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(part_col, F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", _SPACE), lambda w: w != ""))
    failing = F.array_compact(F.array(*[F.when(fails, F.lit(f)) for f, fails in conditions(F.col("_text")).items()]))
    rows = marked(rows.select("doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("_hash"), failing.alias("fails")), "facts")
    known = labels.groupBy("doc_id").agg((F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    known = known.filter("doc_id is not null and (good or toxic)").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    joined = rows.withColumn("_salt", F.pmod("_row", F.lit(_SALTS)).cast("int")).join(known.hint("merge"), ["doc_id", "_salt"], "left")
    return joined.select("_row", "doc_id", "part", "_hash", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def repeats(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose ``_hash`` a row with a smaller ``doc_id`` has too."""
    groups = rows.groupBy("_hash").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"), F.count("*").alias("_size"))
    groups = stored(groups.filter("_least < _most").drop("_most"), "texts")
    largest = groups.orderBy(F.desc("_size"), "_hash").limit(_LARGEST)
    often = rows.join(F.broadcast(largest), "_hash")
    seldom = rows.join(F.broadcast(largest.select("_hash")), "_hash", "left_anti")
    seldom = seldom.join(groups.join(F.broadcast(largest.select("_hash")), "_hash", "left_anti").hint("merge"), "_hash")
    return often.unionByName(seldom).filter(F.col("doc_id") > F.col("_least")).select(*rows.columns)


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One stored table ``_row, part, good, toxic`` for each filter."""
    carried = ["_row", "part", "good", "toxic"]
    of = {f: rows.filter(F.array_contains("fails", f)) for f in FILTERS[:-1]} | {FILTERS[-1]: repeats(rows)}
    return {f: stored(failing.select(*carried), f"fails-{f}") for f, failing in of.items()}


def _bit(i: int) -> int:
    return 1 << i


def survivors(universe: DataFrame, failing: DataFrame) -> DataFrame:
    """``set, _row, part``: what each set of filters leaves of ``universe`` (``_row, part``), the empty set included.

    ``failing`` has ``filter`` (its number) and ``_row``.
    """
    level = universe.select(F.lit(0).alias("set"), F.lit(-1).alias("_last"), "_row", "part")
    levels = [stored(level, "left")]
    keys = failing.select("filter", "_row").hint("merge")
    for size in range(1, len(FILTERS) + 1):
        # Each set is made once, from the set without its last filter.
        after = F.sequence(F.col("_last") + 1, F.lit(len(FILTERS) - 1))
        grown = levels[-1].filter(F.col("_last") < len(FILTERS) - 1).select("set", "_row", "part", F.explode(after).alias("filter"))
        left = grown.join(keys, ["filter", "_row"], "left_anti")
        levels.append(stored(left.select((F.col("set") + F.expr("shiftleft(1, filter)")).alias("set"), F.col("filter").alias("_last"), "_row", "part"), f"left-{size}"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.drop("_last")


def interactions(rows: DataFrame, tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Counts by part: ``part, set, filter, removed, good_lost, toxic_lost, redundant`` of each filter after each set
    without it (where any row fails it), and ``part, set, kept`` (where any row is left)."""
    failing = None
    for i, f in enumerate(FILTERS):
        one = tables[f].withColumn("filter", F.lit(i))
        failing = one if failing is None else failing.unionByName(one)
    universe = failing.select("_row", "part").distinct()
    left = survivors(universe, failing)
    sets = F.array(*map(F.lit, range(1 << len(FILTERS))))
    without = F.filter(sets, lambda s: F.getbit(s, F.col("filter")) == 0)
    next_ = failing.select("*", F.explode(without).alias("set"))
    here = left.select("set", "_row").hint("merge")
    ones = lambda c: F.sum(F.col(c).cast("long"))
    removed = next_.join(here, ["set", "_row"], "left_semi").groupBy("part", "set", "filter").agg(
        F.count("*").alias("removed"), ones("good").alias("good_lost"), ones("toxic").alias("toxic_lost")
    )
    redundant = next_.join(here, ["set", "_row"], "left_anti").groupBy("part", "set", "filter").agg(F.count("*").alias("redundant"))
    steps = removed.join(redundant.hint("merge"), ["part", "set", "filter"], "full").fillna(0, ["removed", "good_lost", "toxic_lost", "redundant"])
    # Rows that fail nothing are left by every set.
    clean = rows.select("_row", "part").join(failing.select("_row").hint("merge"), "_row", "left_anti").select(F.explode(sets).alias("set"), "part")
    pre = [d.groupBy("part", "set").agg(F.count("*").alias("kept")) for d in (left, clean)]
    kept = pre[0].unionByName(pre[1]).groupBy("part", "set").agg(F.sum("kept").alias("kept"))
    return stored(steps, "steps"), stored(kept, "kept")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step, filter`` and the counts
    ``kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    rows = stored(facts(docs, labels, part_col, id_col, text_col), "rows")
    steps, kept = interactions(rows, failing_ids(rows))
    n, all_ = len(FILTERS), (1 << len(FILTERS)) - 1
    # Orders in which a set of that size comes before a filter.
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)).cast("long") for k in range(n)]), F.bit_count("set") + 1)
    alone = F.col("set") == F.lit(all_) - F.expr("shiftleft(1, filter)")
    whole = steps.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weight).alias("shapley"), F.sum(F.when(alone, F.col("removed")).otherwise(0)).alias("unique_fails")
    )
    listed = []
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            listed.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "filter": f, "set": before, "after": before | _bit(f)})
            before |= _bit(f)
    plan = F.from_json(F.lit(json.dumps(listed)), "array<struct<filter_order:string,step:int,filter:int,set:int,after:int>>")
    out = rows.select("part").distinct().select("part", F.inline(plan))
    out = out.join(steps.hint("merge"), ["part", "set", "filter"], "left").join(whole.hint("merge"), ["part", "filter"], "left")
    out = out.join(kept.withColumnRenamed("set", "after").hint("merge"), ["part", "after"], "left")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    letter = F.substring(F.lit(FILTERS), F.col("filter") + 1, F.lit(1))
    return out.select("part", "filter_order", "step", letter.alias("filter"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
