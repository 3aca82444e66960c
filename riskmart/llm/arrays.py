"""Vectorised text handling over Arrow batches with numpy.

Texts of a batch lie in one byte buffer; words and their hashes are found for all of them
at once. Hashes are polynomials modulo 2**64 whose prefix sums give the hash of any
stretch in two lookups; a mixing step spreads them over all bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes of text that are worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(lengths, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per text the number of words before it (n + 1)."""
    full = ~_BLANK[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = full[:-1], full[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[firsts] = False
    after[firsts[1:] - 1] = False
    starts = np.flatnonzero(full & ~before)
    ends = np.flatnonzero(full & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


class _Kept(dict):
    """What a process has worked out. It does not travel: functions that refer to it find it empty."""

    def __reduce__(self):
        return _Kept, ()


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = _Kept()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; the longest so far are kept."""
    if n not in _POWERS:
        _POWERS.clear()
        _POWERS[n] = _fresh_powers(n)
    return _POWERS[n]


def _fresh_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, U64), np.full(n, pow(BASE, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


class Stretches:
    """Hashes of stretches of a symbol sequence."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        up, self.down = _powers(1 << max(21, int(n + 1).bit_length()))
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(symbols.astype(U64) * up[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def fixed(self, length: int) -> np.ndarray:
        """For every start that has ``length`` symbols."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, U64)
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = h + U64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64))
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed(Stretches(data.astype(U64) + U64(1)).of(starts, ends))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as sorted maximal spans; spans that touch are joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], ends[last]
