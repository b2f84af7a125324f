"""Near-duplicate documents by order MinHash over word shingles.

A text is the sequence of its runs of five words, each labelled with its occurrence, so that no
run comes twice. For each of several hash orders the smallest runs are sampled and put back into
text order: the hash of that short sequence is a sketch. Texts with many runs in common and in
the same order share sketches; a moved block breaks them. Candidates that share a sketch are
verified by a banded alignment of the two whole sequences: the longest common subsequence ``c``
within the band in which enough matches can lie, and the similarity ``c / (n + m - c)``, which
for texts without moves is the Jaccard similarity of the runs.

Equal word sequences are collapsed before: a text, not a row or an id, is what sketches, links and classes are about,
and ids come in only to choose the row that stays. All members of a bucket meet its leader first,
which joins most of a group of copies into one component with a number of pairs in proportion to
its size. Then those of different components whose leaders are the same, or in one component, meet,
but only where they can be similar. Let the core of the group be the runs that more than half of its members have,
``e`` the number of runs of a text beyond the core, and ``m`` the number of core runs that the text
lacks. Two texts without a common run beyond the core differ in at least ``e + e' + |m - m'|`` runs, so
either that is little enough or they share one of their rarest runs beyond the core. Both are
joins on keys; they leave out no link, and few pairs of the copies that differ too much to be
linked.

Defined cases: texts without words (null, empty, only marks) are equal to each other only if the
same after trimming white space, null as empty; texts of one to four words are one run and have
equal texts only as duplicates; a repeated row belongs to the class of the row it repeats;
rows that share an id but not the text belong to the classes of their texts; rows with a null id are documents like
others, but stay only where their class has no row with an id; empty tables give empty tables; other columns
of the table do not matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epilink.llm.tables import release, stored, whole
from epilink.llm.words import mix, shingles, slices

WIDTH = 5
THRESHOLD = 0.8
#: Runs sampled per sketch and sketches per text. A pair at 0.8 shares a sketch of four runs with
#: probability 0.4 and none of 24 with 5e-6; short texts sample three, as few runs are alike by chance.
SAMPLED, SKETCHES = 4, 24
SAMPLED_SHORT, SKETCHES_SHORT = 3, 24
#: Runs below which a text has short sketches, and from which it has long ones. The two ranges
#: overlap by more than the threshold lets the lengths of a pair differ.
SHORT_BELOW, LONG_FROM = 110, 80


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs of one text made distinct: each is mixed with the number of its earlier occurrences."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if new.all():
        return runs
    at = np.arange(len(runs))
    count = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(runs)
    out[order] = np.where(count > 0, mix(ranked + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), ranked)
    return out


def _sketches(runs: np.ndarray, sampled: int, seeds: np.ndarray, tag: int) -> list[int]:
    """Hash of the ``sampled`` smallest runs of each order, in text order."""
    if len(runs) <= sampled:
        picked = runs[None, :]
        seeds = seeds[:1]
    else:
        scrambled = mix(runs[None, :] ^ seeds[:, None])
        at = np.sort(np.argpartition(scrambled, sampled - 1, axis=1)[:, :sampled], axis=1)
        picked = runs[at]
    h = np.full(len(picked), tag, dtype=np.uint64) + seeds
    for k in range(picked.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C17) + picked[:, k])
    return h.view(np.int64).tolist()


_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, max(SKETCHES, SKETCHES_SHORT), dtype=np.uint64)


def sketches(runs: np.ndarray) -> list[int]:
    """Sketches of the labelled runs of one text; none where only an equal text can be similar."""
    out: list[int] = []
    if 4 <= len(runs) < SHORT_BELOW:
        out += _sketches(runs, SAMPLED_SHORT, _SEEDS[:SKETCHES_SHORT], 3)
    if len(runs) >= LONG_FROM:
        out += _sketches(runs, SAMPLED, _SEEDS[:SKETCHES], 4)
    return out


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the similarity of two sequences of distinct runs reaches ``threshold``."""
    n, m = len(a), len(b)
    least = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    # With ``least`` matches in order, a match is at most as far off the diagonal as runs may be left over.
    near = (i - j <= n - least) & (j - i <= m - least)
    if near.sum() < least:
        return False
    i, j = i[near], j[near]
    j = j[np.argsort(i)]
    if (np.diff(j) > 0).all():
        return True
    tails: list[int] = []
    for x in j.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails) >= least


_SEEN = "_id long, _hash long, _key binary, _n int, _runs binary, _sketches array<long>"


#: Bits of the filter by which texts without a candidate are left out early; 4 MB, whatever the input.
_FILTER_BITS = 25


def _hash_filter(texts: DataFrame) -> np.ndarray:
    """A bit for each ``_hash``, as 64-bit words. Other hashes may share a bit, none is missed."""
    bit = F.shiftrightunsigned(F.xxhash64("_hash"), 64 - _FILTER_BITS)
    mask = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    rows = texts.select(bit.alias("bit")).select(F.shiftright("bit", 6).alias("at"), mask.alias("mask")).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(1 << (_FILTER_BITS - 6), dtype=np.int64)
    found = rows.toArrow()
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def _read(texts: DataFrame, with_runs: bool) -> DataFrame:
    """Key of the word sequence, number of runs, and either the runs or the sketches of each text.

    ``texts`` has ``_id``, ``_hash`` and ``_text``.
    """

    def run(batches):
        for batch in batches:
            ids, hashes, texts = batch.columns
            for lo, hi, words in slices(texts):
                h = words.hashes()
                spelled, at = words.spellings()
                keys, counts, runs_of, found = [], [], [], []
                for i in range(hi - lo):
                    runs = labelled(shingles(h[words.first[i] : words.first[i + 1]], WIDTH))
                    plain = b"." + spelled[at[i] : at[i + 1]] if len(runs) else b"-" + (texts[lo + i].as_py() or "").strip().encode()
                    keys.append(hashlib.md5(plain).digest())
                    counts.append(len(runs))
                    runs_of.append(runs.tobytes() if with_runs else None)
                    found.append(None if with_runs else sketches(runs))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, hi - lo),
                        hashes.slice(lo, hi - lo),
                        pa.array(keys, pa.binary()),
                        pa.array(counts, pa.int32()),
                        pa.array(runs_of, pa.binary()),
                        pa.array(found, pa.list_(pa.int64())),
                    ],
                    names=["_id", "_hash", "_key", "_n", "_runs", "_sketches"],
                )

    return texts.select("_id", "_hash", "_text").mapInArrow(run, _SEEN)


def _filtered(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """The rows of ``texts`` whose ``_hash`` may be in the filter."""
    sent = texts.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            bit = batch.column(0).to_numpy(zero_copy_only=False)
            keep = (sent.value[bit >> 6] >> (bit & 63)) & 1
            yield batch.select(["_id", "_hash", "_text"]).filter(pa.array(keep == 1))

    bit = F.shiftrightunsigned(F.xxhash64("_hash"), 64 - _FILTER_BITS)
    return texts.select(bit.alias("_bit"), "_id", "_hash", "_text").mapInArrow(run, texts.schema)


def _verified(pairs: DataFrame, runs: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)``, and whether they are ``linked`` by their alignment."""

    def run(batches):
        for batch in batches:
            x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(k)] for k in (2, 3))
            found = [aligned(p, q, threshold) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.bool_())],
                names=["a", "b", "linked"],
            )

    left = runs.select(F.col("_id").alias("a"), F.col("_runs").alias("x"))
    right = runs.select(F.col("_id").alias("b"), F.col("_runs").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _each_run(members: DataFrame, runs: DataFrame) -> DataFrame:
    """``(head, id, run)``: all runs of the members of groups."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                own = [np.frombuffer(v.as_buffer(), np.int64) for v in part.column(2)]
                count = [len(v) for v in own]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.repeat(part.column(k).to_numpy(), count)) for k in (0, 1)), pa.array(np.concatenate(own))], names=["head", "id", "run"]
                )

    rows = members.select("head", "id").join(runs.select(F.col("_id").alias("id"), "_runs"), "id").select("head", "id", "_runs")
    return rows.mapInArrow(run, "head long, id long, run long")


#: Width of the bins in which members of a group look for others.
_BIN = 8


_OPEN = "head long, id long, n int, component long, seeks boolean, f int, g int, beyond array<long>"


def _against_core(members: DataFrame) -> DataFrame:
    """``f``, ``g`` and the runs beyond the core of members with ``_runs`` and the ``_core`` of their group."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                cores = part.column(5)
                core, at = cores.values.to_numpy(), cores.offsets.to_numpy()
                n, f, g, beyond = [], [], [], []
                for i, v in enumerate(part.column(4)):
                    own, of_core = np.frombuffer(v.as_buffer(), np.int64), core[at[i] : at[i + 1]]
                    left = own[~np.isin(own, of_core)]
                    e, m = len(left), len(of_core) - len(own) + len(left)
                    n.append(len(own))
                    f.append(e + m)
                    g.append(e - m)
                    beyond.append(left)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(n, pa.int32()),
                        part.column(2),
                        part.column(3),
                        pa.array(f, pa.int32()),
                        pa.array(g, pa.int32()),
                        pa.array(beyond, pa.list_(pa.int64())),
                    ],
                    names=["head", "id", "n", "component", "seeks", "f", "g", "beyond"],
                )

    return members.select("head", "id", "component", "seeks", "_runs", "_core").mapInArrow(run, _OPEN)


def _open_pairs(members: DataFrame, met: DataFrame, found: DataFrame, runs: DataFrame, threshold: float) -> DataFrame:
    """Pairs that share a group, are in different components, may be similar and did not meet yet.

    A group is all members of leaders that are in one component, so that a text with many sketches
    is not in as many groups. Members of all components of a group but its largest look for others.
    With ``f = e + m`` and ``g = e - m``, ``f + g'`` and ``f' + g`` are both at most the number of runs
    in which a similar pair may differ, or the pair shares a run that is among the rarest ones of both.
    """
    of = found.select("id", "component")
    leaders = of.select(F.col("id").alias("head"), F.col("component").alias("_group"))
    own = members.join(leaders, "head", "left").select(F.coalesce("_group", "head").alias("head"), "id").distinct()
    own = own.join(of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = own.groupBy("head", "component").agg(F.count("*").alias("size"))
    groups = sizes.groupBy("head").agg(F.sum("size").alias("rows"), F.count("*").alias("k"), F.max(F.struct("size", "component")).alias("largest"))
    # A leader has met all others of its length: with one other there is nothing left to do.
    groups = groups.filter("rows > 2 and k > 1").select("head", "rows", F.col("largest.component").alias("largest"))
    own = stored(own.join(groups, "head").withColumn("seeks", F.col("component") != F.col("largest")).drop("largest"), "groups")

    often = _each_run(own, runs).groupBy("head", "run").agg(F.count("*").alias("often")).filter("often > 1")
    rows = own.select("head", "rows").distinct()
    often = stored(often.join(rows, "head").select("head", "run", "often", (F.col("often") * 2 > F.col("rows")).alias("core")), "often")
    # A core has at most twice as many runs as its members on average: one array, no longer than texts are.
    core = often.filter("core").groupBy("head").agg(F.collect_list("run").alias("_core"))
    held = own.join(runs.select(F.col("_id").alias("id"), "_runs"), "id").join(core, "head", "left")
    opened = stored(_against_core(held.withColumn("_core", F.coalesce("_core", F.array().cast("array<long>")))), "open")
    own = opened.drop("beyond").withColumn("bin", F.floor(F.col("g") / _BIN))

    farthest = (1 - threshold) / threshold

    def side(rows: DataFrame, name: str, *keys: str) -> DataFrame:
        return rows.select(*keys, *(F.col(c).alias(f"{c}_{name}") for c in rows.columns if c not in keys))

    different = (F.col("component_a") != F.col("component_b")) & (~F.col("seeks_b") | (F.col("component_a") < F.col("component_b"))) & _alike(threshold)
    may_differ = (F.col("n_a") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    near = (F.col("f_a") + F.col("g_b") <= may_differ) & (F.col("f_b") + F.col("g_a") <= may_differ)
    seeking = own.filter("seeks").withColumn("upto", F.floor((F.col("n") * farthest - F.col("f")) / _BIN)).drop("bin")
    seeking = seeking.join(own.select("head", "bin").distinct(), "head").filter("bin <= upto")
    by_bin = side(seeking, "a", "head", "bin").join(side(own, "b", "head", "bin"), ["head", "bin"]).filter(different & near)

    # Runs that are alone in the group come first among the rarest, and meet nobody.
    common = opened.select("*", F.explode("beyond").alias("run")).withColumn("beyond", F.size("beyond"))
    common = common.join(often.filter("not core").select("head", "run", "often"), ["head", "run"])
    text = Window.partitionBy("head", "id")
    place = F.row_number().over(text.orderBy("often", "run")) + F.col("beyond") - F.count("*").over(text)
    rare = common.withColumn("place", place).filter(F.col("place") <= F.floor(F.col("n") * farthest + 1e-6) + 1)
    # After its first common run, a pair has at most the rest beyond the core and the core in common.
    rare = rare.select("*", (F.col("beyond") - F.col("place") + 1).alias("rest"), (F.col("n") - F.col("beyond")).alias("of_core"))
    rare = stored(rare.drop("beyond", "often", "place"), "rare")
    most = F.least("rest_a", "rest_b") + F.least("of_core_a", "of_core_b")
    reach = most >= (F.col("n_a") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-6
    by_run = side(rare.filter("seeks"), "a", "head", "run").join(side(rare, "b", "head", "run"), ["head", "run"]).filter(different & ~near & reach)

    both = by_bin.select("id_a", "id_b").union(by_run.select("id_a", "id_b"))
    both = both.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    return both.join(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")


def _alike(threshold: float):
    """Lengths of a pair that do not rule out a similarity of ``threshold``."""
    return F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of all ends of the edges ``(a, b)``; a component is named by its smallest id.

    Every round each id takes the smallest label among its neighbours and then the label of that
    label, so the number of rounds grows with the logarithm of the longest path.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels.id == near.a).select("id", "component", F.least("component", "near").alias("next"))
        # The label of the label: where it is still moving, follow it.
        over = step.select(F.col("id").alias("_to"), F.col("next").alias("_over"))
        moved = stored(
            step.join(over, step.next == F.col("_to"), "left").select("id", "component", F.least("next", F.coalesce("_over", "next")).alias("next")),
            "labels",
        )
        labels = moved.select("id", F.col("next").alias("component"))
        if moved.filter("next <> component").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its class, null if it has none), ``n_links`` (texts
    similar to its text that were found as links) and ``kept`` (it is the one of its class that stays).

    Rows that repeat id and text of the kept one are marked as kept too; :func:`one_of_each` then keeps one. ``text_hash`` tells
    rows with the same id apart.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    seen = stored(_read(plain, False).drop("_runs"), "sketches")
    # One text of each word sequence goes on, under a number that is fixed by the storing. The row that would stay comes with it.
    row = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash")))
    texts = seen.groupBy("_key").agg(row.alias("row"), F.any_value("_n").alias("n"), F.any_value("_sketches").alias("_sketches"))
    texts = stored(texts.withColumn("id", F.monotonically_increasing_id()), "texts")
    # The leader of a bucket is the text with the smallest id of a row: what others were copied from mostly came first, and most
    # copies are more like it than like each other. Any leader gives the same classes.
    single = texts.select("id", "n", F.coalesce("row.id", F.lit((1 << 63) - 1)).alias("first"), F.explode("_sketches").alias("bucket"))
    shared = single.groupBy("bucket").agg(F.count("*").alias("_size"), F.min_by("id", "first").alias("head")).filter("_size > 1").drop("_size")
    members = stored(single.join(shared, "bucket").select("id", "n", "head").distinct(), "members")
    lengths = stored(members.select("id", "n").distinct().join(texts.select("id", "_key", F.col("row.hash").alias("_hash")), "id"), "lengths")
    # Few texts are candidates. The filter spares a shuffle of all the others; the join below is exact.
    runs = _read(_filtered(plain, _hash_filter(lengths)), True).select("_hash", "_key", "_runs")
    runs = runs.dropDuplicates(["_key", "_hash"]).join(lengths.select("_key", "_hash", F.col("id").alias("_id")), ["_key", "_hash"])
    runs = stored(runs.select("_id", "_runs"), "runs")
    release(docs.sparkSession)
    heads = lengths.select(F.col("id").alias("head"), F.col("n").alias("n_a"))
    pairs = members.filter("id <> head").join(heads, "head").withColumn("n_b", F.col("n")).filter(_alike(threshold))
    pairs = pairs.select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    met = stored(_verified(pairs, runs, threshold), "met")
    first = met.filter("linked").select("a", "b")
    found = components(first)
    release(docs.sparkSession)
    more = stored(_verified(_open_pairs(members, met, found, runs, threshold), runs, threshold).filter("linked").select("a", "b"), "edges")
    release(docs.sparkSession)
    # The later links join whole components: one link of two components is as good as all.
    of = found.select("id", "component")
    ends = more
    for end in ("a", "b"):
        ends = ends.join(of.withColumnRenamed("id", end), end, "left").withColumn(f"c_{end}", F.coalesce("component", end)).drop("component")
    joined = components(ends.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct())
    own = of.unionByName(joined.select("id", F.col("id").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
    found = own.join(joined.select(F.col("id").alias("component"), F.col("component").alias("whole")), "component", "left").select("id", F.coalesce("whole", "component").alias("component"))
    edges = first.unionByName(more)

    degree = edges.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("_links"))
    classes = found.join(degree, "id", "left")
    text = texts.select("id", "_key", F.struct("row.none", "row.id", "row.hash", F.col("_key").alias("key")).alias("row"))
    # The row that stays is the one with the smallest id of all texts of the class.
    own = found.join(text, "id").groupBy("component").agg(F.min("row").alias("stays"))
    classes = classes.join(own, "component").select("id", "stays", "_links")
    of_text = text.join(classes, "id", "left").select("_key", F.coalesce("stays", "row").alias("stays"), F.coalesce("_links", F.lit(0)).alias("n_links"))
    kept = F.col("_id").eqNullSafe(F.col("stays.id")) & (F.col("_hash") == F.col("stays.hash")) & (F.col("_key") == F.col("stays.key"))
    return seen.select("_id", "_hash", "_key").join(of_text, "_key").select(
        F.col("_id").alias("doc_id"),
        F.col("stays.id").alias("class_id"),
        "n_links",
        kept.alias("kept"),
        F.col("_hash").alias("text_hash"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id; repeated rows count once."""

    def name(id_: str, hashed):
        return F.concat_ws(":", F.coalesce(F.col(id_).cast("long").cast("string"), F.lit("-")), hashed).alias("_row")

    kept = near_duplicates(docs, id_col, text_col, threshold).filter("kept").select(name("doc_id", "text_hash")).distinct()
    own = docs.select(whole(docs), name(id_col, F.xxhash64(text_col)))
    return own.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select("_doc.*")
