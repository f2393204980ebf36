"""Words of whole texts as numpy arrays over Arrow buffers, in slices of bounded size.

A word is a run of digits, ASCII letters and code points from U+0080 on; letters A-Z count as
lower case. Its hash is a polynomial over its bytes modulo 2**64, taken from running sums, so
the cost does not depend on the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the finaliser of splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))[_LOWER]
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 8 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def power(way: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the hash's base (``up``) or of its inverse (``down``)."""
    return _power(way, _BASE if way == "up" else pow(_BASE, -1, 1 << 64) & _MASK, n)


def run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, the same wherever the run stands."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power("up", len(values)), dtype=np.uint64, out=sums[1:])
    back = power("down", len(values) + 1)
    return mix((sums[end] - sums[start]) * back[start])


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans [first, first + size), one after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


@dataclass
class Words:
    """Words of some texts: byte range in ``data``, text number and hash of each."""
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    def per_text(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.texts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``k`` words inside one text."""
        if len(self.hash) < k:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        first = np.flatnonzero(self.doc[: len(self.doc) - k + 1] == self.doc[k - 1:])
        return first, run_hash(self.hash, first, first + k) + np.uint64(k)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the ranges of its rows; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return (data[offsets[0]: offsets[-1]], offsets - offsets[0]) if len(offsets) else (data, np.zeros(1, dtype=np.int64))


def words_of(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # no word crosses rows
    begins[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, start, end, doc, run_hash(_BYTE[data], start, end))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, some ``size`` bytes of text at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
