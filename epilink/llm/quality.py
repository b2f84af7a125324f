"""Quality of documents by co-training two classifiers.

One view is the content of a text: hashed words and pairs of words, and shares of symbols,
capitals, digits and repeated words. The other is what is known about its page: language, source, length, number
and length of lines, number of repeated lines. Each view has a logistic classifier, in numpy. In every round both views
score all unlabelled documents; each labels those it is surest of, by the quantiles of its scores over the whole corpus
and in the proportion of the labels, and these join the training rows of the other view. Both are then calibrated
on labelled rows held back, and their calibrated log-odds are averaged, weighted by how well each does there.

Rows are fitted on the driver, as features without their texts, so their number is bounded (see :class:`Sample`): labelled
rows by a hash, and in each round, of all documents that lie beyond a quantile, as many by a hash for each view. All else
covers every document over its whole text.

Defined cases: null or empty texts and null metadata have features of their own and get a score;
labels that contradict count as the larger; without labels of both kinds all scores are 0.5; rows without an id are scored
and never learnt from; of rows that share an id one text, by its hash, is learnt from; repeated rows get equal scores;
empty tables give empty tables; other columns of the table do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilink.llm.tables import stored
from epilink.llm.words import Words, mix, slices

_BITS = 14
_SHAPES = 8
THRESHOLD = 0.5


@dataclass(frozen=True)
class Sample:
    """Bounds of the rows that are fitted on: labelled ones, and those that a view labels for the other in one round."""

    labelled: int = 3000
    #: Rounds, the share of all unlabelled documents a view is sure enough of to label, and how many of them it labels.
    rounds: int = 3
    surest: float = 0.05
    each: int = 200


@dataclass
class Rows:
    """Sparse features of some rows: row, column and value of each, sorted by row."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    n: int

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], minlength=self.n)

    def back(self, d: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, self.value * d[self.row], minlength=size)

    def take(self, rows: np.ndarray) -> Rows:
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        keep = place[self.row] >= 0
        return Rows(place[self.row[keep]], self.column[keep], self.value[keep], len(rows))


def content(words: Words) -> Rows:
    """The content view: hashed words and pairs as shares of the text, and shapes in steps."""
    n = len(words.first) - 1
    count = np.diff(words.first)
    text = np.repeat(np.arange(n), count)
    h = words.hashes()
    pairs = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) if len(h) > 1 else h[:0]
    inner = text[:-1] == text[1:] if len(h) > 1 else np.zeros(0, bool)
    each = np.concatenate([h, pairs[inner]])
    row = np.concatenate([text, text[:-1][inner]]) if len(h) > 1 else text
    column = (each >> np.uint64(64 - _BITS)).astype(np.int64)
    key, times = np.unique(row.astype(np.int64) << _BITS | column, return_counts=True)
    row, column = (key >> _BITS).astype(np.int32), (key & ((1 << _BITS) - 1)).astype(np.int32)
    value = (np.sqrt(times) / np.sqrt(np.maximum(count, 1))[row]).astype(np.float32)

    raw, at = words.raw, words.texts

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(np.diff(at), 1)

    _, firsts = np.unique(mix(h ^ (text.astype(np.uint64) << np.uint64(40))), return_index=True)
    distinct = np.bincount(text[firsts], minlength=n)
    symbols = per_text(((raw < 48) & (raw > 32) & (raw != 44) & (raw != 46)) | ((raw > 57) & (raw < 65)) | ((raw > 90) & (raw < 97)) | ((raw > 122) & (raw < 128)))
    shapes = [
        symbols,
        per_text((raw >= 65) & (raw <= 90)),
        per_text((raw >= 48) & (raw <= 57)),
        per_text(raw == 10),
        distinct / np.maximum(count, 1),
        np.log1p(count) / 12,
        np.bincount(text, words.ends - words.starts, minlength=n) / np.maximum(count, 1) / 20,
        per_text(raw >= 128),
    ]
    return _joined(Rows(row, column, value, n), shapes, 1 << _BITS)


#: Steps into which a share is cut, denser near 0.
_STEPS = np.array([0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.12, 0.18, 0.25, 0.33, 0.42, 0.52, 0.63, 0.75, 0.88])


def _joined(rows: Rows, shapes: list[np.ndarray], base: int) -> Rows:
    for k, s in enumerate(shapes):
        step = np.searchsorted(_STEPS, s)
        at = (base + k * (len(_STEPS) + 1) + step).astype(np.int32)
        own = np.arange(rows.n, dtype=np.int32)
        rows = Rows(np.concatenate([rows.row, own]), np.concatenate([rows.column, at]), np.concatenate([rows.value, np.ones(rows.n, np.float32)]), rows.n)
    return rows


CONTENT_SIZE = (1 << _BITS) + _SHAPES * (len(_STEPS) + 1)
_NAMES = 1 << 12
PAGE_SIZE = _NAMES + 5 * (len(_STEPS) + 1)


def page(lang: list, source: list, n_chars: list, lines: list[tuple[int, int, int]]) -> Rows:
    """The page view; ``lines`` has the number of lines, of distinct lines and the longest one's length."""
    from zlib import crc32

    n = len(lang)
    row = np.repeat(np.arange(n), 2)
    column = np.array([crc32(f"{k}={v}".encode()) % _NAMES for a, b in zip(lang, source) for k, v in (("lang", a), ("source", b))], dtype=np.int64)
    size = np.array([x or 0 for x in n_chars], dtype=np.float64)
    number = np.array(lines, dtype=np.float64).reshape(n, 3)
    shapes = [
        np.log1p(np.maximum(size, 0)) / 14,
        np.log1p(number[:, 0]) / 9,
        1 - number[:, 1] / np.maximum(number[:, 0], 1),
        np.log1p(number[:, 2]) / 12,
        np.log1p(size / np.maximum(number[:, 0], 1)) / 12,
    ]
    return _joined(Rows(row, column, np.ones(2 * n), n), shapes, _NAMES)


@dataclass
class View:
    weights: np.ndarray
    base: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, rows: Rows) -> np.ndarray:
        return rows.dot(self.weights) + self.base

    def odds(self, rows: Rows) -> np.ndarray:
        return self.scale * self.logit(rows) + self.shift


def _fit(rows: Rows, y: np.ndarray, start: View, steps: int = 30, decay: float = 1e-4) -> View:
    """Logistic regression by full gradients with a step for each weight, from a former view."""
    size = len(start.weights)
    v, square = View(start.weights.copy(), start.base), np.full(size, 1e-8)
    base_square = 1e-8
    for _ in range(steps):
        d = (1 / (1 + np.exp(-np.clip(v.logit(rows), -30, 30))) - y) / len(y)
        g = rows.back(d, size) + decay * v.weights
        square += g**2
        v.weights -= 0.3 * g / np.sqrt(square)
        base_square += d.sum() ** 2
        v.base -= 0.3 * d.sum() / base_square**0.5
    return v


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a = np.array([1.0, 0.0])
    x = np.column_stack([z, np.ones(len(z))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        a -= np.clip(np.linalg.solve(h, x.T @ (p - y) + 1e-2 * (a - [1, 0])), -1, 1)
    return float(max(a[0], 0.05)), float(a[1])


@dataclass
class Model:
    content: View
    page: View
    share: float = 0.5

    def score(self, text: Rows, meta: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, content and page score."""
        a, b = self.content.odds(text), self.page.odds(meta)
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (self.share * a + (1 - self.share) * b, a, b))


#: Log-odds from which a view is sure of a label at all.
_SURE = 1.0


class CoTraining:
    """Two views that are fitted on labelled rows, and on rows that they label for each other."""

    def __init__(self, text: Rows, meta: Rows, y: np.ndarray, seed: int = 2) -> None:
        order = np.random.default_rng(seed).permutation(len(y))
        held, fit = order[: len(order) // 4], order[len(order) // 4 :]
        if min(len(np.unique(y[held])), len(np.unique(y[fit]))) < 2:
            held = fit = order
        self.held = (text.take(held), meta.take(held), y[held])
        self.share = float((y[fit] == 1).mean())
        self.rows = [[text.take(fit)], [meta.take(fit)]]
        self.labels = [[y[fit].astype(np.float64)], [y[fit].astype(np.float64)]]
        self.views = [View(np.zeros(CONTENT_SIZE)), View(np.zeros(PAGE_SIZE))]
        self.learn()

    def learn(self) -> None:
        self.views = [_fit(_stacked(self.rows[k]), np.concatenate(self.labels[k]), self.views[k]) for k in (0, 1)]

    def taught(self, view: int, rows: Rows, labels: np.ndarray) -> None:
        """Add rows that the other view has labelled to the training rows of ``view``."""
        self.rows[view].append(rows)
        self.labels[view].append(labels.astype(np.float64))

    def model(self) -> Model:
        """Both views, calibrated and weighted by what they tell of the rows held back."""
        gain, y = [], self.held[2]
        for v, rows in zip(self.views, self.held):
            z = v.logit(rows)
            v.scale, v.shift = _platt(z, y)
            p = np.clip(1 / (1 + np.exp(-(v.scale * z + v.shift))), 1e-6, 1 - 1e-6)
            rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
            loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
            gain.append(max(1e-3, -(rate * np.log(rate) + (1 - rate) * np.log(1 - rate)) - loss))
        return Model(*self.views, share=gain[0] / sum(gain))


def _stacked(parts: list[Rows]) -> Rows:
    begin = np.concatenate([[0], np.cumsum([r.n for r in parts])])
    return Rows(*(np.concatenate(x) for x in zip(*((r.row + lo, r.column, r.value) for lo, r in zip(begin, parts)))), int(begin[-1]))


_LINES = ("size(split(coalesce(text, ''), '\\n'))", "size(array_distinct(split(coalesce(text, ''), '\\n')))", "aggregate(split(coalesce(text, ''), '\\n'), 0, (a, l) -> greatest(a, length(l)))")


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"), *(F.expr(x).alias(f"l{i}") for i, x in enumerate(_LINES)))


def _views(part: pa.RecordBatch, words: Words) -> tuple[Rows, Rows]:
    c = [part.column(i).to_pylist() for i in range(2, 8)]
    return content(words), page(c[0], c[1], c[2], list(zip(*c[3:])))


_FEATURES = "c0 binary, v0 binary, c1 binary, v1 binary"


def _features(docs: DataFrame, few: DataFrame, carried: list[str]) -> tuple[list[list], Rows, Rows]:
    """Values of ``carried`` (columns of ``few``) and features in both views of one row of each id in ``few``, a bounded table."""

    def run(batches):
        for batch in batches:
            for lo, hi, words in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                packed = []
                for rows in _views(part, words):
                    order = np.argsort(rows.row, kind="stable")
                    at = np.searchsorted(rows.row[order], np.arange(rows.n + 1))
                    for data in (rows.column[order].astype(np.int32), rows.value[order].astype(np.float32)):
                        packed.append(pa.array([data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[8:], *packed], names=[*carried, *(f.split()[0] for f in _FEATURES.split(", "))])

    prepared = _prepared(docs)
    one = prepared.join(F.broadcast(few), "doc_id").groupBy("doc_id", *carried).agg(F.min_by(F.struct(*prepared.columns[1:]), F.xxhash64("text")).alias("d"))
    one = one.select("doc_id", *[f"d.{c}" for c in prepared.columns[1:]], *carried).orderBy("doc_id", *carried)
    schema = ", ".join([*(f"{c} {t}" for c, t in one.select(*carried).dtypes), _FEATURES])
    found = one.mapInArrow(run, schema).toArrow()
    views = []
    for k in (0, 1):
        columns, values = ([np.frombuffer(x.as_buffer(), t) for x in found.column(f"{n}{k}")] for n, t in (("c", np.int32), ("v", np.float32)))
        row = np.repeat(np.arange(found.num_rows), [len(c) for c in columns])
        views.append(Rows(row, np.concatenate([*columns, np.zeros(0, np.int32)]), np.concatenate([*values, np.zeros(0, np.float32)]), found.num_rows))
    return [found.column(c).to_pylist() for c in carried], *views


def _logits(docs: DataFrame, views: list[View]) -> DataFrame:
    """``doc_id, z0, z1``: log-odds of every document in both views."""
    sent = docs.sparkSession.sparkContext.broadcast(views)
    rows = _prepared(docs)

    def run(batches):
        for batch in batches:
            for lo, hi, words in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                z = [pa.array(v.logit(x)) for v, x in zip(sent.value, _views(part, words))]
                yield pa.RecordBatch.from_arrays([part.column(0), *z], names=["doc_id", "z0", "z1"])

    return rows.mapInArrow(run, rows.select("doc_id", F.lit(0.0).alias("z0"), F.lit(0.0).alias("z1")).schema)


def _surest(scores: DataFrame, share: float, sample: Sample, turn: int) -> DataFrame:
    """``doc_id, view, label`` of rows that the other view labels for ``view``; at most ``sample.each`` for each view."""
    asked = [float(sample.surest * (1 - share)), float(1 - sample.surest * share)]
    cuts = scores.agg(*[F.percentile_approx(f"z{k}", asked, 10_000) for k in (0, 1)]).first()
    picked = []
    for k, cut in enumerate(cuts):
        low, high = cut or (0.0, 0.0)
        z = F.col(f"z{k}")
        for label, sure, n in ((1, (z >= high) & (z > _SURE), share), (0, (z <= low) & (z < -_SURE), 1 - share)):
            own = scores.filter(sure).orderBy(F.xxhash64(F.lit(turn), F.col("doc_id")), "doc_id").limit(round(sample.each * n))
            picked.append(own.select("doc_id", F.lit(1 - k).alias("view"), F.lit(label).alias("label")))
    return reduce(DataFrame.unionAll, picked)


def fit(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> Model:
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    own = docs.filter("doc_id is not null").select("doc_id").distinct()
    picked = own.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample.labelled)
    (y,), text, meta = _features(docs, picked, ["label"])
    y = np.array(y, dtype=np.int64)
    if len(np.unique(y)) < 2:
        return Model(View(np.zeros(CONTENT_SIZE)), View(np.zeros(PAGE_SIZE)))
    both = CoTraining(text, meta, y)
    taken = known.select("doc_id")
    for turn in range(sample.rounds):
        scores = _logits(docs, both.views).filter("doc_id is not null").join(taken, "doc_id", "left_anti")
        few = stored(_surest(stored(scores, "logits"), both.share, sample, turn), "labelled")
        (views, marks), text, meta = _features(docs, few, ["view", "label"])
        if not views:
            break
        views, marks = np.array(views), np.array(marks)
        for k, rows in enumerate((text, meta)):
            mine = np.flatnonzero(views == k)
            both.taught(k, rows.take(mine), marks[mine])
        taken = taken.union(few.select("doc_id")).distinct()
        both.learn()
    return both.model()


def quality(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, score, content_score, page_score`` and ``kept`` (score of 0.5 or more) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model or fit(docs, labels))
    rows = _prepared(docs)
    names = ("score", "content_score", "page_score")
    schema = rows.select("doc_id", *(F.lit(0.0).alias(n) for n in names)).schema

    def run(batches):
        for batch in batches:
            for lo, hi, words in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, sent.value.score(*_views(part, words)))], names=["doc_id", *names])

    return rows.mapInArrow(run, schema).withColumn("kept", F.col("score") >= THRESHOLD)
