"""Words of whole texts as NumPy arrays, for the operators that run in Arrow batches.

A word is a longest run of bytes outside [\\x20\\x09-\\x0D]. A batch is handled in
slices of a few MB of text, so memory follows the slice and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _odd(seed: int, n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class WordHash:
    """A polynomial hash of words over the ring of 64-bit integers.

    Equal words get equal hashes wherever they stand. ``seed`` picks the byte
    values and the base, so two instances hash independently.
    """

    def __init__(self, seed: int):
        self.table = _odd(seed, 256)
        base = int(_odd(seed + 1, 1)[0]) & ~7 | 5
        self.base = np.uint64(base)
        self.inverse = np.uint64(pow(base, -1, 2**64))
        self.powers = self._powers(self.base, SLICE_BYTES)
        self.inverses = self._powers(self.inverse, SLICE_BYTES)

    @staticmethod
    def _powers(x: np.uint64, n: int) -> np.ndarray:
        out = np.full(n + 1, x, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            self.powers = self._powers(self.base, 2 * len(data))
            self.inverses = self._powers(self.inverse, 2 * len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.powers[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverses[starts])


class Slice:
    """Some rows of a batch: their bytes end to end, and where their words are."""

    def __init__(self, rows: slice, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data, self.offsets = rows, data, offsets
        inside = IS_WORD[data]
        before = np.empty(len(data), dtype=bool)
        after = np.empty(len(data), dtype=bool)
        if len(data):
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[0] = after[-1] = False
            edges = offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(data))]
            before[edges] = False
            after[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: Row r of the slice has the words bounds[r] to bounds[r + 1].
        self.bounds = np.searchsorted(self.starts, offsets)


def slices(texts: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a string array in slices of about ``most`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        part = data[offsets[row]:offsets[stop]]
        yield Slice(slice(row, stop), LOWER[part] if lower else part, offsets[row:stop + 1] - offsets[row])
        row = stop


def sequences(hashes: np.ndarray, k: int, bounds: np.ndarray, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k`` consecutive words within a row, and their new bounds.

    A row with 1 to k - 1 words gets one hash, of its whole sequence; one
    without words gets none.
    """
    factors = _odd(seed, k)
    total = len(hashes) - k + 1
    counts = np.diff(bounds)
    full = np.maximum(counts - k + 1, 0)
    short = (counts > 0) & (counts < k)
    new = np.concatenate(([0], np.cumsum(full + short)))
    out = np.empty(new[-1], dtype=np.uint64)
    if total > 0:
        acc = hashes[:total] * factors[0]
        for j in range(1, k):
            acc += hashes[j:j + total] * factors[j]
        whole = np.repeat(full > 0, full + short)
        first = np.repeat(bounds[:-1] - new[:-1], full + short) + np.arange(new[-1])
        out[whole] = mix(acc[first[whole]])
    for r in np.flatnonzero(short):
        some = hashes[bounds[r]:bounds[r + 1]]
        out[new[r]] = mix((some * factors[:len(some)]).sum(dtype=np.uint64) + np.uint64(len(some)))
    return out, new
