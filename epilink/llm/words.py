"""Words of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a run of ASCII letters (lower-cased), digits and bytes above 0x7F, which is
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. No word crosses a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 18

_PRIME = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_PRIME, -1, 1 << 64)
_random = np.random.default_rng(20240501)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_VALUE = _VALUE[_LOWER]
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", _PRIME), ("down", _INVERSE)):
            p = np.full(max(n, SLICE_BYTES) + 1, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of some texts: byte ranges in ``raw``, hashes, and the first word of each text."""

    raw: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _sums: np.ndarray

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``longest`` bytes."""
        ends = self.ends if longest is None else np.minimum(self.ends, self.starts + longest)
        _, down = _power(len(self.raw))
        h = (self._sums[ends] - self._sums[self.starts]) * down[self.starts]
        return mix(h + (ends - self.starts).astype(np.uint64))

    def spellings(self) -> tuple[bytes, np.ndarray]:
        """All lower-cased words, a blank between those of one text, and where each text lies in it."""
        keep = np.zeros(len(self.raw), dtype=bool)
        flat = np.full(len(self.raw), 32, dtype=np.uint8)
        inside = _IS_WORD[self.raw]
        keep[inside] = True
        flat[inside] = _LOWER[self.raw[inside]]
        last = np.zeros(len(self.ends), dtype=bool)
        last[self.first[1:][np.diff(self.first) > 0] - 1] = True
        keep[self.ends[~last]] = True
        at = np.concatenate([[0], np.cumsum(keep)])[self.texts]
        return flat[keep].tobytes(), at

    def word(self, i: int) -> bytes:
        return _LOWER[self.raw[self.starts[i] : self.ends[i]]].tobytes()


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts that lie at ``offsets`` (n + 1 of them) in the bytes ``raw``."""
    n = len(raw)
    inside = _IS_WORD[raw]
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:n])
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    up, _ = _power(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUE[raw] * up[:n], out=sums[1:])
    return Words(raw, offsets, starts, ends, np.searchsorted(starts, offsets), sums)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Row range and words of slices of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, words_of(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words of one text; of all its words if there are fewer."""
    if len(h) == 0:
        return h
    out = np.zeros(max(1, len(h) - width + 1), dtype=np.uint64)
    for k in range(min(width, len(h))):
        out = (out * np.uint64(_PRIME)) + h[k : k + len(out)]
    return mix(out)
