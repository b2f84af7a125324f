"""Secrets in texts: fixed patterns, and a character network over everything else that could be one.

The fixed patterns find assignments to telling names, access keys and long hexadecimal runs. Candidates are runs of six
or more characters: the first one behind a telling word, whatever it holds but blanks, quotes and brackets; and runs of key
characters with lower case, upper case and a digit, or from 16 characters on with a digit and a letter or with lower case
often followed by upper case. A convolutional network over the characters of a candidate and those around it, in numpy, scores
it. It is trained on labelled findings, by default
the candidates of all texts labelled by the fixed patterns, whose telling names are
masked for half of them so that the form of a secret is learnt, too. The threshold is the highest at which a wanted share of the labelled
secrets held back from training is found, but one half at least; secrets that are no candidates count as not found.

Defined cases: a null text counts as empty and has no findings; texts are scanned over their
whole length; without candidates of both kinds to learn from nothing is added to the fixed
patterns; repeated rows are scanned alike; empty tables give empty tables.
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

from .tables import stored

# The patterns of the base findings.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")

TELLING = re.compile(r"(?ai:pass(?:word|wd|code|phrase)?|pwd|secret|token|key|credential|login|auth)s?(?![A-Za-z])")
_TELLING = ("pass", "pwd", "secret", "token", "key", "credential", "login", "auth")
#: What may be a secret behind a telling word.
BEHIND = re.compile(r"""[^\s"'`<>()\[\]{},;:=][^\s"'`<>()\[\]{},;:]{5,}""")
LONG = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: A run of key characters from its first digit on, and what may stand in front of that.
FROM_DIGIT = re.compile(r"[0-9][A-Za-z0-9+/_.=-]*+")
_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_.=-")
_LOWER, _UPPER, _CHANGE = re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[a-z][A-Z]")
#: Changes from lower to upper case by which a long run without a digit is no name of several words.
_CHANGES = 3
_BLANK = str.maketrans(dict.fromkeys("\n\t\r", " "))

#: Characters of a candidate that are looked at in one window (longer ones are seen in several), and of its surroundings.
INNER, AROUND = 48, 16
_LENGTH = INNER + 2 * AROUND
_DIM, _WIDTHS, _FILTERS = 8, (3, 5), 12
#: Share of labelled secrets that the threshold must let through.
RECALL = 0.98
#: Passes over the labelled candidates.
EPOCHS = 6


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the fixed patterns, by start and kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2])))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of what could be a secret, by start; what overlaps is one candidate."""
    found = []
    for m in FROM_DIGIT.finditer(text):
        start = m.start()
        while start and text[start - 1] in _HEAD:
            start -= 1
        if m.end() - start >= 6:
            lower, upper = _LOWER.search(text, start, m.end()), _UPPER.search(text, start, m.end())
            if lower and upper or m.end() - start >= 16 and (lower or upper):
                found.append((start, m.end()))
    found += [m.span() for m in LONG.finditer(text) if len(_CHANGE.findall(m[0])) >= _CHANGES]
    done, plain = 0, text.lower()
    for m in TELLING.finditer(text) if any(w in plain for w in _TELLING) else ():
        # A word within the run behind another one tells nothing new.
        if m.end() >= done and (near := BEHIND.search(text, m.end(), m.end() + AROUND + 6)):
            run = BEHIND.match(text, near.start())
            done = run.end()
            end = run.start() + len(run[0].rstrip(".!?"))
            if end - run.start() >= 6:
                found.append((run.start(), end))
    start = end = -1
    for lo, hi in sorted(found):
        if lo < end:
            end = max(end, hi)
            continue
        if end > 0:
            yield start, end
        start, end = lo, hi
    if end > 0:
        yield start, end


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Character codes of a candidate and its surroundings; a long candidate is cut into overlapping windows."""
    out = []
    for at in range(start, max(start + 1, end - INNER // 2), INNER // 2):
        stop = min(end, at + INNER)
        codes = np.zeros((2, _LENGTH), dtype=np.int64)
        for place, lo, hi, inside in ((0, max(0, at - AROUND), at, 0), (AROUND, at, stop, 1), (AROUND + stop - at, stop, stop + AROUND, 0)):
            piece = text[lo:hi].translate(_BLANK)
            shift = AROUND - len(piece) if place == 0 else 0
            for k, c in enumerate(piece):
                codes[0, place + shift + k] = min(ord(c), 127)
                codes[1, place + shift + k] = inside
        out.append(codes)
        if stop == end:
            break
    return out


@dataclass
class Network:
    """Character and place embeddings, filters by width, hidden and output weights, threshold."""

    parts: list[np.ndarray]
    threshold: float = 2.0

    def forward(self, x: np.ndarray) -> tuple:
        chars, place, *filters, out, base = self.parts
        e = chars[x[:, 0]] + place[x[:, 1]]
        wide = np.concatenate([e, np.zeros((len(e), max(_WIDTHS), _DIM), e.dtype)], 1)
        responses = [sum(wide[:, j : j + _LENGTH] @ w[j] for j in range(len(w))) for w in filters]
        top = [r.argmax(1) for r in responses]
        mean = [np.maximum(r, 0).mean(1) for r in responses]
        peak = [np.take_along_axis(r, t[:, None], 1)[:, 0] for r, t in zip(responses, top)]
        active = np.hstack([np.maximum(np.hstack(peak), 0), *mean])
        return wide, responses, top, peak, active, active @ out + base[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([1 / (1 + np.exp(-np.clip(self.forward(x[lo : lo + 512])[-1], -30, 30))) for lo in range(0, len(x), 512)]) if len(x) else np.zeros(0)


def untrained(seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)
    n = len(_WIDTHS) * _FILTERS * 2
    parts = [rng.normal(0, 0.3, (128, _DIM)), rng.normal(0, 0.3, (2, _DIM)), *(rng.normal(0, 0.3, (w, _DIM, _FILTERS)) for w in _WIDTHS), rng.normal(0, 0.2, n), np.zeros(1)]
    return Network([p.astype(np.float32) for p in parts])


def step(net: Network, squares: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
    """One step of gradients over some labelled windows; ``net`` and ``squares`` change."""
    wide, responses, top, peak, active, z = net.forward(x)
    d = (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
    out = net.parts[-2]
    grads = [np.zeros_like(p) for p in net.parts]
    grads[-2], grads[-1] = active.T @ d, np.array([d.sum()])
    back_e = np.zeros_like(wide)
    for k, w in enumerate(_WIDTHS):
        lo = k * _FILTERS
        late = len(_WIDTHS) * _FILTERS + lo
        g = d[:, None, None] * out[late : late + _FILTERS] * (responses[k] > 0) / _LENGTH
        first = d[:, None] * out[lo : lo + _FILTERS] * (peak[k] > 0)
        np.put_along_axis(g, top[k][:, None], np.take_along_axis(g, top[k][:, None], 1) + first[:, None], 1)
        for j in range(w):
            grads[2 + k][j] = np.einsum("nld,nlf->df", wide[:, j : j + _LENGTH], g)
            back_e[:, j : j + _LENGTH] += g @ net.parts[2 + k][j].T
    np.add.at(grads[0], x[:, 0], back_e[:, :_LENGTH])
    np.add.at(grads[1], x[:, 1], back_e[:, :_LENGTH])
    for p, q, s in zip(net.parts, grads, squares):
        s += q**2
        p -= 0.05 * q / np.sqrt(s)


def spare_share(recall: float, missed: float) -> float:
    """Share of the candidates that are secrets which the threshold may let go."""
    return max(0.0, (1 - recall - missed) / (1 - missed))


def train(x: np.ndarray, y: np.ndarray, recall: float = RECALL, epochs: int = EPOCHS, seed: int = 3, missed: float = 0.0) -> Network:
    """A network of labelled windows ``x`` in memory; a quarter is held back to set the threshold.

    ``missed`` is the share of labelled secrets that are no candidates; those that are have to make up for them.
    """
    net, rng = untrained(seed), np.random.default_rng(seed)
    held = rng.permutation(len(y)) % 4 == 0
    if len(np.unique(y[~held])) < 2 or not (y[held] == 1).any():
        return net
    squares = [np.full(p.shape, 1e-3, np.float32) for p in net.parts]
    fit = np.flatnonzero(~held)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            step(net, squares, x[rows], y[rows], np.ones(len(rows)))
    known = np.sort(net.score(x[held & (y == 1)]))
    net.threshold = float(max(known[int(spare_share(recall, missed) * len(known))], 0.5))
    return net


def labelled(text: str, mask: bool) -> list[tuple[list[np.ndarray], int]]:
    """Windows of the candidates of a text, labelled by the fixed patterns; with ``mask`` without the telling names before them.

    A finding of the fixed patterns that no candidate overlaps has the label 2 and no windows.
    """
    base, found = base_findings(text), list(candidates(text))
    out = [([], 2) for b in base if not any(b[0] < end and start < b[1] for start, end in found)]
    for start, end in found:
        y = int(any(b[0] < end and start < b[1] for b in base))
        shown = text[: max(0, start - AROUND)] + " " * min(start, AROUND) + text[start:] if mask else text
        out.append((windows(shown, start, end), y))
    return out


def _windows_of(batch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(-1, 2, _LENGTH).astype(np.int64)


def _pass(rows: DataFrame, net: Network, squares: list[np.ndarray], weight: tuple[float, float]) -> tuple[list, list]:
    """One pass over all ``rows``: every task goes on from the same network over its rows; their means by the number of rows.

    A network is a few thousand numbers, so that one of each task is little for the driver.
    """
    shapes = [p.shape for p in net.parts]
    sent = rows.sparkSession.sparkContext.broadcast((net.parts, squares))

    def run(batches):
        own, sums, n = Network([p.copy() for p in sent.value[0]]), [s.copy() for s in sent.value[1]], 0
        for batch in batches:
            x, y = _windows_of(batch), batch.column("y").to_numpy()
            for lo in range(0, len(y), 64):
                step(own, sums, x[lo : lo + 64], y[lo : lo + 64], np.where(y[lo : lo + 64] == 1, weight[1], weight[0]))
            n += len(y)
        if n:
            state = np.concatenate([p.ravel() for p in own.parts + sums]).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([state], pa.binary())], names=["n", "state"])

    done = sorted((r.n, bytes(r.state)) for r in rows.select("x", "y").mapInArrow(run, "n long, state binary").collect())
    total = sum(n for n, _ in done)
    mean = sum(np.frombuffer(state, np.float32).astype(np.float64) * (n / total) for n, state in done).astype(np.float32)
    cut = np.split(mean, np.cumsum([int(np.prod(s)) for s in shapes * 2])[:-1])
    arrays = [a.reshape(s).copy() for a, s in zip(cut, shapes * 2)]
    sent.destroy()
    return arrays[: len(shapes)], arrays[len(shapes) :]


def _scores(rows: DataFrame, net: Network) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(net.score(_windows_of(batch)).astype(np.float64), pa.float64())], names=["score"])

    return rows.select("x").mapInArrow(run, "score double")


def fit(docs: DataFrame, text_col: str = "text", recall: float = RECALL, epochs: int = EPOCHS) -> Network:
    """A network trained on all candidates of all texts; a quarter of them, by a hash, is held back to set the threshold.

    Repeats of a text are learnt once. Both labels weigh alike in all. Passes go over the candidates where they lie.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, (w, y) in enumerate(labelled(text or "", h % 2 == 0)):
                    rows.append((h, k, y, w[0].astype(np.uint8).tobytes() if w else b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["h", "k", "y", "x"]
            )

    found = docs.select(F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t")).mapInArrow(run, "h long, k int, y int, x binary").distinct()
    found = found.withColumn("o", F.xxhash64("h", "k")).withColumn("held", F.pmod("o", F.lit(4)) == 0)
    # In an order that says nothing about the rows and is the same in each run.
    found = stored(found.sortWithinPartitions("o", "h", "k", "y", "x"), "labelled")
    count = {(r.y, r.held): r["count"] for r in found.groupBy("y", "held").count().collect()}
    secrets = {y: count.get((y, True), 0) + count.get((y, False), 0) for y in (1, 2)}
    missed = secrets[2] / max(1, sum(secrets.values()))
    n = [count.get((y, False), 0) for y in (0, 1)]
    net, known = untrained(), count.get((1, True), 0)
    if not all(n) or not known:
        return net
    squares = [np.full(p.shape, 1e-3, np.float32) for p in net.parts]
    own = found.filter(~F.col("held") & (F.col("y") < 2))
    for _ in range(epochs):
        net.parts, squares = _pass(own, net, squares, tuple(sum(n) / (2 * k) for k in n))
    at = int(spare_share(recall, missed if missed < 1 else 0.0) * known)
    scores = _scores(found.filter(F.col("held") & (F.col("y") == 1)), net)
    net.threshold = max(scores.orderBy("score").limit(at + 1).agg(F.max("score")).first()[0], 0.5)
    return net


def findings(net: Network, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
    """Base findings and those the network adds, which overlap none of the base, for each text."""
    out, open_, x = [], [], []
    for i, text in enumerate(texts):
        text = text or ""
        base = base_findings(text)
        out.append(base)
        for start, end in candidates(text):
            if not any(b[0] < end and start < b[1] for b in base):
                w = windows(text, start, end)
                open_.append((i, start, end, len(w)))
                x += w
    if x:
        score = net.score(np.array(x))
        at = 0
        for i, start, end, n in open_:
            if score[at : at + n].max() >= net.threshold:
                out[i].append((start, end, "model"))
            at += n
    return [sorted(f, key=lambda f: (f[0], KINDS.index(f[2]))) for f in out]


def scan(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model`` of every row; ``spans`` lists kind:start:end."""
    sent = docs.sparkSession.sparkContext.broadcast(net or fit(docs, text_col))
    schema = docs.select(F.col(id_col).alias("doc_id")).withColumns(
        {c: F.lit(0).cast("long") for c in ("n_assign", "n_access", "n_hex")} | {"base_sha256": F.lit(""), "spans": F.lit(""), "n_model": F.lit(0).cast("long")}
    ).schema

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = findings(sent.value, part.column(1).to_pylist())
                counts = {k: pa.array([sum(f[2] == k for f in x) for x in found], pa.int64()) for k in KINDS}
                spelled = [[f"{k}:{s}:{e}" for s, e, k in x] for x in found]
                base = [",".join(p for p, f in zip(t, x) if f[2] != "model") for t, x in zip(spelled, found)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *(counts[k] for k in KINDS[:3]),
                        pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                        pa.array([",".join(t) for t in spelled], pa.string()),
                        counts["model"],
                    ],
                    names=schema.names,
                )

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """``text`` with each finding replaced by its kind in brackets; overlapping findings are joined."""
    if text is None:
        return None
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])
