"""Word and shingle hashes of whole texts, vectorised over Arrow buffers.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``. Texts are hashed in
pieces of about ``PIECE_BYTES``, so memory is bounded by that or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
# Rows of a batch that are held as Python objects at a time.
SLICE_ROWS = 512

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# All ASCII characters but letters and digits.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = [not chr(b).isalnum() for b in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``SLICE_ROWS`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers for a seed."""
    steps = np.arange(1, count + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)
    return mix(steps) | _U(1)


_BYTE = constants(256, 11)
_BASE = _U(0xD6E8FEB86659FD93)
_INVERSE = _U(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < length:
        size = max(length, PIECE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers = tables[0], tables[1]
    return _powers


def text_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(column))
        own = offsets[row : end + 1]
        yield row, data[own[0] : own[-1]], own - own[0]
        row = end


def span_digests(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each span of bytes."""
    up, down = _power_tables(len(data) + 1)
    digests = []
    for table in (_BYTE, constants(256, 13)):
        rolled = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[: len(data)], out=rolled[1:])
        own = (rolled[stops] - rolled[starts]) * down[starts]
        digests.append(mix(own + (stops - starts).astype(np.uint64)))
    return digests[0], digests[1]


class Words:
    """The words of a piece: ``starts``, ``ends`` (byte positions), ``hashes``; ``first[d]`` to
    ``first[d + 1]`` are the words of its document d."""

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE
    ):
        word = ~separators[data]
        n = len(data)
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = offsets[:-1][offsets[:-1] < n]
        begins[inner] = word[inner]
        finishes = word.copy()
        finishes[:-1] &= ~word[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        finishes[last] = word[last]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        up, self._down = _power_tables(n + 1)
        self._rolled = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[:n], out=self._rolled[1:])
        own = (self._rolled[self.ends] - self._rolled[self.starts]) * self._down[self.starts]
        self.hashes = mix(own + (self.ends - self.starts).astype(np.uint64))
        self.first = np.searchsorted(self.starts, offsets)

    def prefix_hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of the words at positions ``at``."""
        starts = self.starts[at]
        own = (self._rolled[starts + size] - self._rolled[starts]) * self._down[starts]
        return mix(own + _U(size))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first) of all windows of ``size`` words inside a document."""
        counts = np.maximum(np.diff(self.first) - size + 1, 0)
        first = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], counts)
        total = np.zeros(len(at), np.uint64)
        for j, c in enumerate(constants(size, 23)):
            total += self.hashes[at + j] * c
        return mix(total), first

    def shingle_sets(self, size: int) -> Iterator[np.ndarray]:
        """Per document the sorted distinct shingles of ``size`` words; with fewer words the
        whole sequence is the one shingle, without words the set is empty."""
        hashes, first = self.windows(size)
        factors = constants(size, 23)
        for d in range(len(self.first) - 1):
            a, b = self.first[d], self.first[d + 1]
            if b - a >= size:
                yield np.unique(hashes[first[d] : first[d + 1]])
            elif b > a:
                own = (self.hashes[a:b] * factors[: b - a]).sum(keepdims=True)
                yield mix(own + _U(b - a))
            else:
                yield np.zeros(0, np.uint64)
