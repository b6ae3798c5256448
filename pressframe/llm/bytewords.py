"""Words of Arrow text batches as numpy arrays: no Python object per word.

A batch is cut into slices of about 128 kB (a longer document is a slice of its own), so
memory follows the slice and not the batch: a pass holds some ten numbers for each byte of it.  Words get 64-bit polynomial hashes over a
random byte table; windows of any length follow from one running sum.
"""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 17
#: Longest table of powers that a worker keeps; it is 8 bytes a power.
KEPT_POWERS = 1 << 20
_BASE = 6364136223846793005
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= KEPT_POWERS:
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lowered_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def not_space() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    return table


def letters_and_digits() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def binary_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow binary column without nulls."""
    import pyarrow as pa

    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(column, limit: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets from 0) of runs of rows with about ``limit`` bytes."""
    data, offsets = binary_parts(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


class Words:
    """Words of the texts in one slice: byte ``start``/``end``, ``doc`` (row in the slice), ``hash``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, lower: bool = True, hashed: bool = True):
        self.low = lowered_table()[data] if lower else data
        self.n_docs = len(offsets) - 1
        inside = word_bytes[self.low]
        before = np.empty(len(inside) + 1, bool)
        before[0] = before[-1] = False
        before[1:] = inside
        first = offsets[:-1][offsets[:-1] < len(inside)]
        starts = inside.copy()
        starts &= ~before[:-1]
        starts[first] = inside[first]
        after = np.empty(len(inside), bool)
        after[:-1] = inside[1:]
        after[-1:] = False
        last = offsets[1:][offsets[1:] > 0] - 1
        ends = inside & ~after
        ends[last] = inside[last]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs)
        self.hash = span_hashes(self.low, self.start, self.end) if hashed else None

    def shingles(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``q`` consecutive words of one text."""
        n = len(self.hash) - q + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[q - 1:])
        return at, run_hashes(self.hash, at, q)


def running(data: np.ndarray) -> np.ndarray:
    """Running sum from which :func:`span_hashes` takes the hash of any stretch of bytes."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    sums = running(data) if sums is None else sums
    length = (end - start).astype(np.uint64)
    return mix((sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start] + length * np.uint64(0x9E3779B97F4A7C15))


def run_hashes(words: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    h = words[at]
    for j in range(1, q):
        h = h * np.uint64(0xD1342543DE82EF95) + words[at + j]
    return mix(h + np.uint64(q))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
