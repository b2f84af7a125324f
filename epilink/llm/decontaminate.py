"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

The words of all items go into one automaton. Every text streams through it, word by word; the
state keeps the length of the longest run of words that ends here and occurs in an item. Runs of
``window`` words or more, and whole items that are shorter, are hits; a document is to be cut
where they lie.

Defined cases: a null or empty text has no words and no hits; an item without words never
matches; repeated documents or items are treated alike and on their own; a document with a hit
in every word is contaminated as any other; empty tables give no rows and no hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilink.llm.words import Words, slices, words_of

#: Consecutive item words that make a hit.
WINDOW = 10
#: Item words of one automaton, which takes the driver about 1.1 KB a word while it is built, so 300 MB at most. More
#: items than that are split over several automata, each used on all texts.
SHARD_WORDS = 250_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def item_words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_CAPITALS))


@dataclass
class Automaton:
    """States as arrays. ``keys`` is state * size of the vocabulary + word, sorted, ``to`` its target."""

    vocabulary: np.ndarray
    spelling: list[bytes]
    keys: np.ndarray
    to: np.ndarray
    link: np.ndarray
    length: np.ndarray
    window_state: np.ndarray
    short: list[list[tuple[int, int]]]
    has_short: np.ndarray
    items: dict[int, list[str]]
    shortest: int

    def step(self, state: np.ndarray, size: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and matched lengths of many texts at once."""
        state, size = state.copy(), size.copy()
        open_ = np.arange(len(state))
        while len(open_):
            key = state[open_] * len(self.vocabulary) + word[open_]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            hit = open_[found]
            state[hit] = self.to[at[found]]
            size[hit] += 1
            miss = open_[~found]
            up = self.link[state[miss]]
            ended = miss[up < 0]
            state[ended] = 0
            size[ended] = 0
            open_ = miss[up >= 0]
            state[open_] = up[up >= 0]
            size[open_] = self.length[state[open_]]
        return state, size


def build(items: list[tuple[str, str | None]], window: int = WINDOW) -> Automaton:
    """The automaton of ``(item id, text)`` pairs."""
    number: dict[str, int] = {}
    link, length, nexts = [-1], [0], [{}]
    lines = []

    def extend(last: int, w: int) -> int:
        if w in nexts[last]:
            q = nexts[last][w]
            if length[q] == length[last] + 1:
                return q
            return split(last, w, q)
        cur = len(link)
        link.append(0)
        length.append(length[last] + 1)
        nexts.append({})
        p = last
        while p >= 0 and w not in nexts[p]:
            nexts[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][w]
            link[cur] = q if length[q] == length[p] + 1 else split(p, w, q)
        return cur

    def split(p: int, w: int, q: int) -> int:
        copy = len(link)
        link.append(link[q])
        length.append(length[p] + 1)
        nexts.append(dict(nexts[q]))
        while p >= 0 and nexts[p].get(w) == q:
            nexts[p][w] = copy
            p = link[p]
        link[q] = copy
        return copy

    for item, text in items:
        line = [number.setdefault(w, len(number)) for w in item_words(text)]
        if not line:
            continue
        lines.append((item, line))
        last = 0
        for w in line:
            last = extend(last, w)

    # The state of the last ``window`` words of what a state stands for.
    window_state = np.full(len(link), -1, dtype=np.int64)
    order = np.argsort(length, kind="stable")
    for s in order[1:]:
        up = link[s]
        window_state[s] = s if length[up] < window <= length[s] else window_state[up]
    owners: dict[int, set[str]] = {}
    whole: dict[int, set[tuple[int, str]]] = {}
    for item, line in lines:
        s = n = 0
        for w in line:
            s = nexts[s][w]
            n += 1
            if window_state[s] >= 0:
                owners.setdefault(int(window_state[s]), set()).add(item)
        if len(line) < window:
            whole.setdefault(s, set()).add((len(line), item))
    items_of = {s: sorted(v) for s, v in owners.items()}
    # Whole short items that end where a state ends: those of the state and of all states it links to.
    short: list[list[tuple[int, int]]] = [[] for _ in link]
    for s in order[1:]:
        own = []
        for size, item in sorted(whole.get(int(s), ())):
            code = -1 - len(items_of)
            items_of[code] = [item]
            own.append((size, code))
        short[s] = short[link[s]] + own
    spelled = sorted(number, key=number.get)
    spelling = [w.encode() for w in spelled]
    raw = np.frombuffer(b"".join(spelling), dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in spelling])]).astype(np.int64)
    hashes = words_of(raw, bounds).hashes() if spelling else np.zeros(0, dtype=np.uint64)
    rank = np.argsort(hashes)
    renumber = np.empty_like(rank)
    renumber[rank] = np.arange(len(rank))
    size = max(1, len(rank))
    edges = sorted((s * size + int(renumber[w]), t) for s, e in enumerate(nexts) for w, t in e.items())
    return Automaton(
        vocabulary=hashes[rank],
        spelling=[spelling[i] for i in rank],
        keys=np.array([k for k, _ in edges] or [-1], dtype=np.int64),
        to=np.array([t for _, t in edges] or [0], dtype=np.int64),
        link=np.array(link, dtype=np.int64),
        length=np.array(length, dtype=np.int64),
        window_state=window_state,
        short=short,
        has_short=np.array([bool(x) for x in short]),
        items=items_of,
        shortest=min([window, *(len(line) for _, line in lines)]),
    )


def matches(a: Automaton, words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hits in some texts: position of the last word, length in words, key of ``a.items``.

    Words outside the vocabulary end every match, so a text falls into runs of known words, which
    go through the automaton side by side.
    """
    none = np.zeros(0, dtype=np.int64)
    if not len(a.vocabulary) or not len(words.starts):
        return none, none, none
    h = words.hashes()
    at = np.minimum(np.searchsorted(a.vocabulary, h), len(a.vocabulary) - 1)
    known = a.vocabulary[at] == h
    begins = np.zeros(len(h) + 1, dtype=bool)
    begins[words.first] = True
    opens = known & (begins[:-1] | np.concatenate([[True], ~known[:-1]]))
    closes = known & (begins[1:] | np.concatenate([~known[1:], [True]]))
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    keep = end - start >= a.shortest
    start, end = start[keep], end[keep]
    order = np.argsort(start - end, kind="stable")
    start, size_of = start[order], (end - start)[order]
    state, size = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
    where, long, what = [], [], []
    for t in range(int(size_of[0]) if len(size_of) else 0):
        live = int(np.searchsorted(-size_of, -t, "left"))
        here = start[:live] + t
        state, size = a.step(state[:live], size[:live], at[here])
        full = size >= window
        if full.any():
            where.append(here[full])
            long.append(size[full])
            what.append(a.window_state[state[full]])
        some = a.has_short[state]
        for i in np.flatnonzero(some):
            for n, code in a.short[state[i]]:
                if n <= size[i]:
                    where.append(np.array([here[i]]))
                    long.append(np.array([n]))
                    what.append(np.array([code]))
    if not where:
        return none, none, none
    where, long, what = map(np.concatenate, (where, long, what))
    # Equal hashes are not yet equal words: compare the bytes of every word of a hit.
    true = np.ones(len(where), dtype=bool)
    same: dict[int, bool] = {}
    for i in range(len(where)):
        for p in range(where[i] - long[i] + 1, where[i] + 1):
            if p not in same:
                same[p] = words.word(p) == a.spelling[at[p]]
            if not same[p]:
                true[i] = False
    return where[true], long[true], what[true]


def _per_text(a: Automaton, words: Words, window: int) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Texts with hits: index, hit word positions counted in the text, items."""
    where, long, what = matches(a, words, window)
    if not len(where):
        return
    cover = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.add.at(cover, where - long + 1, 1)
    np.add.at(cover, where + 1, -1)
    hit = np.cumsum(cover)[:-1] > 0
    text = np.searchsorted(words.first, where, "right") - 1
    for i in np.unique(text):
        lo, hi = words.first[i], words.first[i + 1]
        items = sorted({x for k in np.unique(what[text == i]) for x in a.items[int(k)]})
        yield int(i), np.flatnonzero(hit[lo:hi]), items


def _shards(benchmark: DataFrame, id_col: str, text_col: str, shard_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in turn, at most ``shard_words`` words at a time; the driver holds one shard only."""
    part, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        n = len(row[1] or "") // 2 + 1
        if part and size + n > shard_words:
            yield part
            part, size = [], 0
        part.append((row[0] or "", row[1]))
        size += n
    if part:
        yield part




def _scan(docs: DataFrame, text_col: str, automaton, window: int, keep_text: bool) -> DataFrame:
    """``docs`` with ``_n_words``, ``_hits`` (positions of hit words) and ``_items`` of one automaton.

    ``keep_text`` is for a further automaton; after the last one no text goes back to Spark.
    """
    columns = [c for c in docs.columns if keep_text or c != text_col]
    empty = docs.select(*columns, F.lit(0).cast("long").alias("_n_words"), F.array().cast("array<int>").alias("_hits"), F.array().cast("array<string>").alias("_items"))

    def run(batches):
        a = automaton.value
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for lo, hi, words in slices(batch.column(at)):
                counts = np.diff(words.first)
                hits: list[list[int]] = [[]] * (hi - lo)
                items: list[list[str]] = [[]] * (hi - lo)
                for i, found, names in _per_text(a, words, window):
                    hits[i], items[i] = found.tolist(), names
                part = batch.select(columns).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(counts, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    names=[*part.schema.names, "_n_words", "_hits", "_items"],
                )

    return docs.mapInArrow(run, empty.schema)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    columns: list[str] | None = None,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``columns`` of ``docs`` with ``n_words``, ``hits`` (positions of the hit words) and ``items``.

    The items are met in shards of ``shard_words`` words; each shard's automaton, whose size that
    bounds, goes to all executors, and the texts are read once however many shards there are.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c != text_col] if columns is None else columns
    keep = [F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    out = docs.select(*keep, F.col(text_col).alias("_text"), F.array().cast("array<int>").alias("_h"), F.array().cast("array<string>").alias("_i"), F.lit(0).cast("long").alias("_n"))
    shards = _shards(benchmark, item_id, item_text, shard_words)
    names = [f"_c{i}" for i in range(len(columns))]
    part: list | None = next(shards, [])
    while part is not None:
        automaton, part = spark.sparkContext.broadcast(build(part, window)), next(shards, None)
        out = _scan(out, "_text", automaton, window, part is not None).select(
            *names,
            *["_text"] * (part is not None),
            F.array_union("_h", "_hits").alias("_h"),
            F.array_union("_i", "_items").alias("_i"),
            F.col("_n_words").alias("_n"),
        )
    return out.select(
        *(F.col(n).alias(c) for n, c in zip(names, columns)),
        F.col("_n").alias("n_words"),
        F.array_sort("_h").alias("hits"),
        F.array_sort("_i").alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from those of :func:`contamination`."""
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    max_span: int = 0,
    max_coverage: float = 0.5,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages.

    Runs of hit words longer than ``max_span`` words are cut out of the text; a document in which
    hits cover more than ``max_coverage`` of the words is dropped whole. Texts without hits, null
    ones too, are left as they are. The hits of all shards are united first, so the shards make no difference.
    """
    spark = docs.sparkSession
    schema = docs.schema
    hits_col = "_hits"
    while hits_col in docs.columns:
        hits_col += "_"

    def cutter(automaton, last):
        def run(batches):
            a = automaton.value
            for batch in batches:
                at = batch.schema.get_field_index(text_col)
                for lo, hi, words in slices(batch.column(at)):
                    part = batch.slice(lo, hi - lo)
                    hits = dict((i, np.array(h)) for i, h in enumerate(part.column(part.num_columns - 1).to_pylist()) if h)
                    for i, found, _ in _per_text(a, words, window):
                        hits[i] = np.union1d(hits[i], found) if i in hits else found
                    if not last:
                        united = pa.array([hits[i].tolist() if i in hits else [] for i in range(hi - lo)], pa.list_(pa.int32()))
                        yield pa.RecordBatch.from_arrays([*part.columns[:-1], united], names=part.schema.names)
                        continue
                    part = part.select(part.schema.names[:-1])
                    changed: dict[int, str | None] = {}
                    for i, found in hits.items():
                        first, n = words.first[i], words.first[i + 1] - words.first[i]
                        if len(found) > max_coverage * n:
                            changed[i] = None
                            continue
                        raw = words.raw[words.texts[i] : words.texts[i + 1]].tobytes()
                        kept, done = [], 0
                        for run_ in np.split(found, np.flatnonzero(np.diff(found) > 1) + 1):
                            if len(run_) <= max_span:
                                continue
                            b = words.starts[first + run_[0]] - words.texts[i]
                            e = words.ends[first + run_[-1]] - words.texts[i]
                            kept.append(raw[done:b])
                            done = e
                        kept.append(raw[done:])
                        changed[i] = b" ".join(x.strip(b" ") for x in kept).decode() if len(kept) > 1 else raw.decode()
                    if changed:
                        column = part.column(at).to_pylist()
                        for i, text in changed.items():
                            column[i] = text
                        keep = np.array([changed.get(i, "") is not None for i in range(hi - lo)])
                        columns = [*part.columns]
                        columns[at] = pa.array(column, part.schema.field(at).type)
                        part = pa.RecordBatch.from_arrays(columns, schema=part.schema).filter(pa.array(keep))
                    yield part

        return run

    shards = _shards(benchmark, "item_id", "text", shard_words)
    part = next(shards, None)
    if part is None:
        return docs
    docs = docs.withColumn(hits_col, F.array().cast("array<int>"))
    while part is not None:
        automaton, part = spark.sparkContext.broadcast(build(part, window)), next(shards, None)
        docs = docs.mapInArrow(cutter(automaton, part is None), schema if part is None else docs.schema)
    return docs
