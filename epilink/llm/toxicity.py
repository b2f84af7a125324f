"""Toxicity scores by a convolutional text classifier trained in numpy.

A word is the sum of two hashed embeddings, of the whole word and of its first letters, so that a
word that shares one bucket by chance stays weak. Filters of width 1, 2 and 3 slide over the
words of the whole text; the largest response of each filter goes into a logistic layer. Fitting
starts from the log-odds of the buckets and goes on by stochastic gradients. Scores are calibrated on a fifth of
the rows, held back from fitting, so that 0.3 is the score at which precision and recall balance best; the
same is done for every language with enough rows, which gives the thresholds by language.

The score depends on the text alone. It is fitted on the whole texts of all labelled rows that are not held out, where
they lie: tasks count the buckets, go on from one common model in each pass, and count the calibrating rows by their
score; Spark adds that up, and what comes to the driver is bounded by the number of buckets and of steps of the score.

Defined cases: a null or empty text has no words and gets the score of no response, which is low;
rows of unknown or null language use the common threshold; labels that are null or contradict
(then the larger holds) are handled; of rows that share an id the smallest text is learnt from; without labelled rows of both kinds all scores are 0;
repeated rows get equal scores; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilink.llm.tables import release, stored
from epilink.llm.words import Words, slices

THRESHOLD = 0.3
WIDTHS = (1, 2, 3)
_DIM, _FILTERS, _EPOCHS, _DOCS = 8, 8, 5, 64
_WORD_BITS, _STEM_BITS, _STEM_BYTES = 19, 17, 5


#: Rows of eight numbers that the parameters other than embeddings take up: filters, biases, output layer and base.
_SHARED = _FILTERS * sum(WIDTHS) + 2 * len(WIDTHS) + 1
#: Tasks that fit side by side: one for so many rows, up to a number by which the exchange of their parameters is bounded.
_ROWS_EACH, _TASKS = 2000, 64
#: Parameters are added up as whole numbers of this unit, as their sum then does not depend on the order.
_UNIT = float(1 << 30)
#: Words of the texts of one step of gradients; a longer text is a step of its own.
_STEP_WORDS = 1 << 17
#: Log-odds are counted in steps of one 256th up to 64 when scores are calibrated.
_GRID, _FARTHEST = 256, 64


def shared(table: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Filters and biases by width, output layer and base: views of the last rows of ``table``."""
    filters, at = [], len(table) - _SHARED
    for width in WIDTHS:
        filters.append(table[at : at + width * _DIM].reshape(width, _DIM, _FILTERS))
        at += width * _DIM
    n = len(WIDTHS)
    return filters, list(table[at : at + n]), table[at + n : at + 2 * n].reshape(-1), table[-1]


@dataclass
class Model:
    """All parameters in one table of rows of eight, calibration and thresholds by language.

    Row 0 is zeros. Only buckets that were seen in fitting have a row; ``word_rows`` and ``stem_rows`` give the row of
    each bucket, 0 for all others. The last rows are :func:`shared`.
    """

    table: np.ndarray
    word_rows: np.ndarray
    stem_rows: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(self, b: Buckets) -> list[np.ndarray]:
        filters, bias, _, _ = shared(self.table)
        x = self.table[b.words] + self.table[b.stems]
        wide = np.vstack([x, np.zeros((max(WIDTHS), x.shape[1]), x.dtype)])
        return [sum(wide[j : j + len(x)] @ w[j] for j in range(len(w))) + c for w, c in zip(filters, bias)]

    def logits(self, b: Buckets) -> np.ndarray:
        most = [np.maximum.reduceat(c, b.bounds, axis=0)[::2] for c in self.responses(b)]
        _, _, out, base = shared(self.table)
        return np.maximum(np.hstack(most), 0) @ out + base[0]

    def scores(self, words: Words) -> np.ndarray:
        """Score of each of the texts."""
        of_word, of_stem = hashed(words)
        b = Buckets.laid(self.word_rows[of_word], self.stem_rows[of_stem], np.diff(words.first))
        z = self.scale * self.logits(b).astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def hashed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and of its first letters."""
    return tuple((h >> np.uint64(64 - bits)).astype(np.uint32) for h, bits in ((w.hashes(), _WORD_BITS), (w.hashes(_STEM_BYTES), _STEM_BITS)))


@dataclass
class Buckets:
    """Rows of the embeddings of the words of some texts, with blanks (row 0) behind each text so that no filter spans two."""

    words: np.ndarray
    stems: np.ndarray
    bounds: np.ndarray

    @classmethod
    def laid(cls, words: np.ndarray, stems: np.ndarray, count: np.ndarray) -> Buckets:
        gap = max(WIDTHS)
        begin = np.concatenate([[0], np.cumsum(count + gap)])
        at = np.arange(len(words)) + np.repeat(np.arange(len(count)) * gap, count)
        out = [np.zeros(begin[-1] + 1, dtype=np.int32) for _ in range(2)]
        out[0][at], out[1][at] = words, stems
        # Pairs of first and last place of a text, a blank one for an empty text.
        bounds = np.column_stack([begin[:-1], begin[:-1] + np.maximum(count, 1)]).ravel()
        return cls(*out, bounds)


def _nothing() -> Model:
    """Scores of 0."""
    rows = [np.zeros(1 << bits, np.int32) for bits in (_WORD_BITS, _STEM_BITS)]
    return Model(np.zeros((1 + _SHARED, _DIM), np.float32), *rows, 0.0, -40.0)


def balance(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut of ``score`` with the best F1; the middle between the two scores it lies between."""
    order = np.argsort(-score, kind="stable")
    s, hit, all_ = score[order], np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (y * weight).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + s[k + 1]) / 2 if k + 1 < len(s) else s[k] - 1e-3)


def untrained(bucket: np.ndarray, seen: np.ndarray, n: tuple[int, int], seed: int = 5) -> Model:
    """The model that fitting starts from. ``seen`` has the texts of each label, of ``n`` in all, in which a bucket stands;
    buckets are in order, those of first letters behind those of words."""
    rng, m = np.random.default_rng(seed), _nothing()
    m.scale, m.shift = 1.0, 0.0
    m.table = np.zeros((len(bucket) + 1 + _SHARED, _DIM), np.float32)
    # Buckets that were never seen keep zeros: an unknown word says nothing.
    words = int(np.searchsorted(bucket, 1 << _WORD_BITS))
    m.word_rows[bucket[:words]] = np.arange(1, words + 1)
    m.stem_rows[bucket[words:] - (1 << _WORD_BITS)] = np.arange(words + 1, len(bucket) + 1)
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    support = seen[0] + seen[1]
    m.table[1 : len(bucket) + 1, 0] = np.clip(odds * support / (support + 3), -3, 3) / 3
    m.table[1 : len(bucket) + 1, 1:] = rng.normal(0, 0.02, (len(bucket), _DIM - 1))
    filters, bias, out, base = shared(m.table)
    for w, c in zip(filters, bias):
        w[:] = rng.normal(0, 0.1, w.shape)
        w[0, 0] = np.abs(rng.normal(0.8, 0.2, _FILTERS))
        c[:] = -0.2
    out[:] = np.abs(rng.normal(0.5, 0.1, out.shape))
    base[0] = -1.0
    return m


def step(m: Model, squares: np.ndarray, moves: np.ndarray, b: Buckets, y: np.ndarray) -> None:
    """One step of gradients over some labelled texts; the table, ``squares`` and ``moves`` (steps that moved a row) change."""
    spans = b.bounds.reshape(-1, 2)
    filters, _, out, base = shared(m.table)
    found = m.responses(b)
    top = [np.array([s + c[s:e].argmax(0) for s, e in spans]) for c in found]
    peak = np.hstack([np.take_along_axis(c, t, 0) for c, t in zip(found, top)])
    active = np.maximum(peak, 0)
    p = 1 / (1 + np.exp(-np.clip(active @ out + base[0], -30, 30)))
    d = ((p - y) / len(y)).astype(np.float32)
    back = d[:, None] * out * (peak > 0)
    g_shared = np.zeros((_SHARED, _DIM), np.float32)
    g_filters, g_bias, g_out, g_base = shared(g_shared)
    at_rows, g_rows = [], []
    for k, width in enumerate(WIDTHS):
        g = back[:, k * _FILTERS : (k + 1) * _FILTERS]
        for j in range(width):
            at = top[k] + j
            g_filters[k][j] = np.einsum("df,dfe->ef", g, m.table[b.words[at]] + m.table[b.stems[at]])
            at_rows += [b.words[at].ravel(), b.stems[at].ravel()]
            g_rows += [(g[:, :, None] * filters[k][j].T[None]).reshape(-1, _DIM)] * 2
        g_bias[k][:] = g.sum(0)
    g_out[:] = active.T @ d
    g_base[0] = d.sum()
    at_rows, g_rows = np.concatenate(at_rows), np.concatenate(g_rows)
    moved = (at_rows > 0) & g_rows.any(1)
    rows, where = np.unique(at_rows[moved], return_inverse=True)
    total = np.zeros((len(rows), _DIM), np.float32)
    np.add.at(total, where, g_rows[moved])
    for at, g in ((rows, total), (slice(-_SHARED, None), g_shared)):
        squares[at] += g**2
        m.table[at] -= 0.05 * g / np.sqrt(squares[at])
        moves[at] += 1


def is_held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``o, y, lang, words, stems, held``: label, buckets and whether it is held back from fitting, of each labelled id that
    is not held out, in an order by hash. Of rows that share an id the one with the smallest text."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~is_held_out())
    known = known.groupBy("doc_id").agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("_y"))
    rows = docs.select("doc_id", "text", "lang").filter(F.col("doc_id").isNotNull() & ~is_held_out())
    rows = rows.join(known, "doc_id").groupBy("doc_id", "_y").agg(F.min(F.struct("text", "lang")).alias("d"))
    rows = rows.select(F.xxhash64("doc_id").alias("o"), F.col("_y").alias("y"), "d.lang", "d.text")
    rows = rows.mapInArrow(_hashed_rows, "o long, y int, lang string, words binary, stems binary")
    return rows.withColumn("held", F.pmod("o", F.lit(5)) == 0).sortWithinPartitions("o", "words", "stems", "y", "lang")


def _hashed_rows(batches):
    for batch in batches:
        for lo, hi, words in slices(batch.column(3)):
            own = [[x[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])] for x in hashed(words)]
            kept = [batch.column(k).slice(lo, hi - lo) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.binary()) for x in own)], names=["o", "y", "lang", "words", "stems"])


def _buckets_of(batch, name: str) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint32) for v in batch.column(name)]


def _laid(batch, m: Model) -> Iterator[tuple[int, int, Buckets]]:
    """Row ranges of a batch, of bounded size, and their buckets."""
    words, stems = _buckets_of(batch, "words"), _buckets_of(batch, "stems")
    count = np.array([len(w) for w in words], dtype=np.int64)
    ends, lo = np.cumsum(count), 0
    while lo < len(count):
        most = (ends[lo - 1] if lo else 0) + _STEP_WORDS
        hi = max(lo + 1, min(lo + _DOCS, int(np.searchsorted(ends, most, "right"))))
        yield lo, hi, Buckets.laid(m.word_rows[np.concatenate(words[lo:hi])], m.stem_rows[np.concatenate(stems[lo:hi])], count[lo:hi])
        lo = hi


def _counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the texts in order, and the number of texts of each label with each of them."""

    def run(batches):
        seen = np.zeros((2, (1 << _WORD_BITS) + (1 << _STEM_BITS)), np.int64)
        for batch in batches:
            for y, words, stems in zip(batch.column("y").to_pylist(), _buckets_of(batch, "words"), _buckets_of(batch, "stems")):
                seen[y, np.unique(words)] += 1
                seen[y, np.unique(stems) + (1 << _WORD_BITS)] += 1
        at = np.flatnonzero(seen.any(0))
        for lo in range(0, len(at), _CHUNK):
            k = at[lo : lo + _CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), *(pa.array(n[k], pa.int64()) for n in seen)], names=["k", "clean", "toxic"])

    found = rows.select("y", "words", "stems").mapInArrow(run, "k long, clean long, toxic long").groupBy("k")
    found = found.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    k, *seen = (c.to_numpy() for c in found.columns)
    order = np.argsort(k)
    return k[order], np.array(seen)[:, order]


#: Rows of one Arrow batch of counts or parameters.
_CHUNK = 20_000


def _pass(rows: DataFrame, m: Model, squares: np.ndarray) -> None:
    """One pass over all ``rows``: every task goes on from the same table over its rows. A row of the table becomes the
    mean of the tasks that moved it, by the number of their moves; ``m`` and ``squares`` change."""
    sent = rows.sparkSession.sparkContext.broadcast((m, squares))
    state = [f"s{i}" for i in range(2 * _DIM)]

    def run(batches):
        start, sums = sent.value[0], sent.value[1].copy()
        own = Model(start.table.copy(), start.word_rows, start.stem_rows)
        moves = np.zeros(len(sums), np.int64)
        for batch in batches:
            y = batch.column("y").to_numpy()
            for lo, hi, b in _laid(batch, own):
                step(own, sums, moves, b, y[lo:hi])
        at = np.flatnonzero(moves)
        for lo in range(0, len(at), _CHUNK):
            k = at[lo : lo + _CHUNK]
            n = moves[k]
            whole = np.rint(np.hstack([own.table[k], sums[k]]).astype(np.float64) * n[:, None] * _UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n), *(pa.array(np.ascontiguousarray(c)) for c in whole.T)], names=["k", "n", *state])

    schema = ", ".join(f"{c} long" for c in ["k", "n", *state])
    moved = rows.select("y", "words", "stems").mapInArrow(run, schema).groupBy("k").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in state))
    found = moved.select("k", *((F.col(c) / (F.col("n") * F.lit(_UNIT))).cast("float").alias(c) for c in state)).toArrow()
    at, *columns = (c.to_numpy() for c in found.columns)
    for i, c in enumerate(columns):
        (m.table if i < _DIM else squares)[at, i % _DIM] = c
    sent.destroy()


def _calibrated(m: Model, rows: DataFrame) -> Model:
    """``m`` with its calibration and thresholds by language, from the log-odds of all ``rows``, rounded to the grid."""
    each = rows.groupBy("lang").agg(F.sum("y").alias("y"), F.count("*").alias("n")).filter("lang <> '' and least(y, n - y) >= 20")
    enough = {r.lang for r in each.select("lang").collect()}
    sent = rows.sparkSession.sparkContext.broadcast((m, enough))

    def run(batches):
        own, enough = sent.value
        for batch in batches:
            z = np.concatenate([own.logits(b) for _, _, b in _laid(batch, own)])
            at = np.rint(np.clip(z, -_FARTHEST, _FARTHEST) * _GRID).astype(np.int32)
            lang = [x if x in enough else None for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), batch.column("y"), pa.array(at)], names=["lang", "y", "z"])

    found = rows.select("y", "lang", "words", "stems").mapInArrow(run, "lang string, y int, z int").groupBy("lang", "z")
    found = found.agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("z", "lang").toArrow()
    sent.destroy()
    lang = np.array([x or "" for x in found.column("lang").to_pylist()])
    z, weight = found.column("z").to_numpy() / _GRID, found.column("n").to_numpy().astype(np.float64)
    y = found.column("y").to_numpy() / weight
    cut = balance(z, y, weight)
    # One slope, fitted by a few Newton steps around the cut, keeps the scores apart from 0 and 1.
    a = 1.0
    toxic, clean = (y * weight).sum(), ((1 - y) * weight).sum()
    soft = y * (toxic + 1) / (toxic + 2) + (1 - y) / (clean + 2)
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(a * (z - cut), -30, 30)))
        a -= float((weight * (p - soft) * (z - cut)).sum() / ((weight * p * (1 - p) * (z - cut) ** 2).sum() + 1e-3))
        a = min(max(a, 0.1), 4.0)
    m.scale, m.shift = a, float(np.log(THRESHOLD / (1 - THRESHOLD)) - a * cut)
    score = 1 / (1 + np.exp(-np.clip(m.scale * z + m.shift, -40, 40)))
    for name in sorted(enough):
        own = lang == name
        m.thresholds[name] = balance(score[own], y[own], weight[own])
    return m


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", epochs: int = _EPOCHS) -> Model:
    """A calibrated model of all labelled documents that are not held out; a fifth of them is held back for the calibration."""
    rows = stored(_labelled(docs, labels, label), "labelled")
    count = {(r.y, r.held): r["count"] for r in rows.groupBy("y", "held").count().collect()}
    total = [count.get((y, True), 0) + count.get((y, False), 0) for y in (0, 1)]
    if not all(total):
        return _nothing()
    own = back = rows
    if len(count) == 4:
        own, back, total = rows.filter("not held"), rows.filter("held"), [count[y, False] for y in (0, 1)]
    own = own.coalesce(min(_TASKS, 1 + sum(total) // _ROWS_EACH))
    m = untrained(*_counted(own), tuple(total))
    squares = np.full(m.table.shape, 1e-4, np.float32)
    for _ in range(epochs):
        _pass(own, m, squares)
        release(docs.sparkSession)
    return _calibrated(m, back)


def scored(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and the double ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for lo, hi, words in slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sent.value.scores(words), pa.float64())], names=names)

    names = [f"_c{i}" for i in range(len(columns))] + ["score"]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(text_col).alias("_text"))
    out = rows.drop("_text").withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(run, out).select(*(F.col(n).alias(c) for c, n in zip(columns, names)), "score")


def threshold_of(model: Model, lang_col: str = "lang"):
    """The threshold of a row by its language."""
    if not model.thresholds:
        return F.lit(THRESHOLD)
    pairs = [F.lit(x) for kv in sorted(model.thresholds.items()) for x in kv]
    return F.coalesce(F.create_map(*pairs)[F.col(lang_col)], F.lit(THRESHOLD))


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` (score of 0.3 or more), ``threshold`` and ``rejected`` by language."""
    model = model or fit(docs, labels)
    return scored(docs, model, ["doc_id", "lang"]).select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        threshold_of(model).alias("threshold"),
        (F.col("score") >= threshold_of(model)).alias("rejected"),
    )


def accepted(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` without those whose score reaches the threshold of their language."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        model = sent.value
        for batch in batches:
            for lo, hi, words in slices(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                cut = [model.thresholds.get(x, THRESHOLD) for x in part.column(lang).to_pylist()]
                yield part.filter(pa.array(model.scores(words) < np.array(cut)))

    return docs.mapInArrow(run, docs.schema)
