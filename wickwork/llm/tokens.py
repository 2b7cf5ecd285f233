"""Words and their hashes over Arrow text columns, a bounded slice of bytes at a time.

A text column is read as UTF-8 bytes. Work is done on slices of whole texts of about
`SLICE_BYTES` (one longer text makes a slice of its own), so memory follows the slice
and not the batch. Null texts are empty texts here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_MASK = (1 << 64) - 1


def byte_table(word_bytes, lower: bool) -> np.ndarray:
    """Random 64-bit value of each byte of a word, 0 for bytes between words."""
    values = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    keep = np.zeros(256, bool)
    keep[list(word_bytes)] = True
    return np.where(keep, values, np.uint64(0))


#: Words parted by blanks: [^\x20\x09-\x0D]+
BLANK_PARTED = [b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D]
#: ASCII letters and digits, and every character beyond ASCII.
ALPHANUMERIC = [b for b in range(256) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b > 0x7F]

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, made once per worker and grown on demand."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of parts of a sequence; equal parts have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = _Powers.of(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair."""
        sums = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(_BASE))

    def runs(self, k: int) -> np.ndarray:
        """Hash of every k neighbours."""
        n = max(0, len(self.sums) - k)
        sums = (self.sums[k: k + n] - self.sums[:n]) * self.down[:n]
        sums += np.uint64((k * _BASE) & _MASK)
        return mix(sums)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(values).of(starts, ends)


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in these bytes) of each slice."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        own = offsets[row: end + 1]
        yield row, end, data[own[0]: own[-1]], own - own[0]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Starts, ends and hashes of all words, and where the words of each row begin."""
    values = table[data]
    inside = values != 0
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(inside)]] = False  # a word never goes on in the next row
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[(last >= 0) & (np.diff(offsets) > 0)]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, span_hashes(values, starts, ends), np.searchsorted(starts, offsets)


def minimizers(keys: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` neighbours of `keys`: the index of its smallest, the first of equals.

    Keys are compared on their upper bits; the lower ones give way to the index.
    """
    runs = len(keys) - width + 1
    if runs <= 0:
        return np.empty(0, np.int64)
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    best = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[: len(best) - span], best[span:])
        span *= 2
    rest = width - span
    return (np.minimum(best[:runs], best[rest: rest + runs]) & low).astype(np.int64)
