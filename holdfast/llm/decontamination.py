"""Benchmark passages in documents: q-gram lemma filtering, then banded alignment.

Texts are compared as UTF-8 bytes, with the capitals A-Z and U+00C0 to U+00DE in lower case
and white space as spaces. A
passage of m bytes within e edits shares at least m - q + 1 - q e of its q-grams with the
benchmark item, all near one diagonal. Shared q-grams are counted in overlapping bands of
diagonals, twice as wide as a match can stray; a band that reaches the bound is aligned
inside that band only, and kept if it meets the edit budget.

Benchmark items are indexed in blocks of bounded size, and every document is held against
each block where it lies: documents are neither shuffled nor paired with items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.sources.staging import stage

_U = np.uint64
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[9, 10, 11, 12, 13]] = 32
_LEFT, _RIGHT = words.constants(2, 53)
_BITS = 22


@dataclass(frozen=True)
class LeakSpec:
    """``percent`` of an item's bytes may be edited, fewer where the lemma would else be empty.
    Items of fewer than ``q`` bytes would be found everywhere and are not searched for."""

    q: int = 12
    percent: int = 5
    block_bytes: int = 4 << 20


def plain(data: np.ndarray) -> np.ndarray:
    """Bytes as they are compared; no byte is added or removed."""
    found = _PLAIN[data]
    # The capitals from U+00C0 on are C3 80 to C3 9E, but for the multiplication sign.
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    own = data[second]
    found[second[(own >= 0x80) & (own <= 0x9E) & (own != 0x97)]] += 32
    return found


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q bytes at each position: two overlapping or touching 8-byte words."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    view = lambda at: np.ndarray((n,), "<u8", buffer=data, offset=at, strides=(1,))
    return view(0) * _LEFT + view(q - 8) * _RIGHT


@dataclass(frozen=True)
class ItemIndex:
    """A block of items with the places of their q-grams."""

    ids: list
    texts: list
    edits: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray


def index_items(items: list[tuple[int, str]], spec: LeakSpec) -> ItemIndex:
    ids, texts = [], []
    for item, text in items:
        own = plain(np.frombuffer(text.strip().encode(), np.uint8))
        if len(own) >= spec.q:
            ids.append(item), texts.append(own)
    sizes = np.array([len(t) for t in texts], np.int64)
    # The largest budget for which the bound is one q-gram at least.
    edits = np.minimum(sizes * spec.percent // 100, np.maximum(sizes - spec.q, 0) // spec.q)
    bounds = sizes - spec.q + 1 - spec.q * edits
    grams = np.concatenate([_grams(t, spec.q) for t in texts] or [np.zeros(0, np.uint64)])
    counts = sizes - spec.q + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
    order = np.argsort(grams, kind="stable")
    distinct, first = np.unique(grams[order], return_index=True)
    return ItemIndex(ids, texts, edits, bounds, distinct, np.append(first, len(grams)), owner[order], at[order])


def align(text: np.ndarray, item: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best occurrence of ``item`` whose diagonal (place in text
    less place in item) stays between ``low`` and ``high``; None beyond the budget."""
    window = bytes(text[max(low, 0) : high + len(item)])
    at = window.find(bytes(item))
    if at >= 0:
        return max(low, 0) + at, max(low, 0) + at + len(item), 0
    width = high - low + 1
    padded = np.full(width + len(item), -1, np.int16)
    a, b = max(low, 0), min(high + len(item), len(text))
    padded[a - low : b - low] = text[a:b]
    # A cell holds edits * step + diagonal of the start, so ties prefer the leftmost start.
    step = np.int64(1) << 32
    cells = np.arange(width, dtype=np.int64)
    ramp = np.arange(width, dtype=np.int64) * step
    for i, letter in enumerate(item):
        moved = cells + step * (padded[i : i + width] != letter)
        moved[:-1] = np.minimum(moved[:-1], cells[1:] + step)
        cells = np.minimum.accumulate(moved - ramp) + ramp
    best = int(np.argmin(cells))
    edits, start = divmod(int(cells[best]), int(step))
    if edits > budget:
        return None
    return max(low + start, 0), min(low + best + len(item), len(text)), edits


class LeakFinder:
    def __init__(self, index: ItemIndex, spec: LeakSpec):
        self.index, self.spec = index, spec
        self.marked = np.zeros(1 << _BITS, bool)
        self.marked[(index.grams >> _U(64 - _BITS)).astype(np.int64)] = True

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, lowest, highest diagonal) of bands that reach the bound, with
        diagonals counted from the document's start; neighbouring bands are joined."""
        index, q = self.index, self.spec.q
        grams = _grams(data, q)
        hits = np.flatnonzero(self.marked[(grams >> _U(64 - _BITS)).astype(np.int64)])
        if not len(hits):
            return
        at = np.minimum(np.searchsorted(index.grams, grams[hits]), len(index.grams) - 1)
        same = index.grams[at] == grams[hits]
        hits, at = hits[same], at[same]
        owner = np.searchsorted(offsets, hits, "right") - 1
        inside = hits + q <= offsets[owner + 1]
        hits, at, owner = hits[inside], at[inside], owner[inside]
        counts = index.first[at + 1] - index.first[at]
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(index.first[at], counts)
        item = index.item[place]
        owner = np.repeat(owner, counts)
        diagonal = np.repeat(hits, counts) - offsets[owner] - index.at[place]
        width = 2 * index.edits[item] + 1
        band = diagonal // width
        # Band k reaches from k to k + 2 widths, so each q-gram lies in two bands.
        keys = np.stack([np.tile(owner, 2), np.tile(item, 2), np.concatenate([band - 1, band])])
        keys = keys[:, np.lexsort(keys[::-1])]
        new = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)) if keys.shape[1] else [])
        found = np.diff(np.append(new, keys.shape[1]))
        keys = keys[:, new]
        enough = found >= index.bounds[keys[1]]
        held: list[int] | None = None
        for doc, which, k in keys[:, enough].T.tolist():
            w = 2 * int(index.edits[which]) + 1
            low, high = k * w, (k + 2) * w - 1
            if held and held[:2] == [doc, which] and low <= held[3] + 1:
                held[3] = high
                continue
            if held:
                yield tuple(held)
            held = [doc, which, low, high]
        if held:
            yield tuple(held)

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, start, end, edits) of the passages of a piece."""
        data = plain(data)
        for doc, which, low, high in self.candidates(data, offsets):
            budget = int(self.index.edits[which])
            text = data[offsets[doc] : offsets[doc + 1]]
            found = align(text, self.index.texts[which], low - budget, high + budget, budget)
            if found:
                yield doc, which, *found


def _finder(index: ItemIndex, spec: LeakSpec):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = LeakFinder(index, spec)
        for batch in batches:
            for row, data, offsets in words.text_pieces(batch.column(1)):
                found = list(finder.leaks(data, offsets))
                owner = pa.array([row + f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(owner),
                        pa.array([index.ids[f[1]] for f in found], pa.int64()),
                        *[pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4)],
                    ],
                    [batch.schema.names[0], "item_id", "start", "end", "edits"],
                )

    return find


def _blocks(benchmark: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about ``most`` bytes, one block in the driver at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text.encode())
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


SCHEMA = "item_id long, start long, end long, edits long"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, spec: LeakSpec = LeakSpec(), key: str = "doc_id"
) -> DataFrame:
    """One row per passage of a document that holds a benchmark item within its edit budget.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.
    ``start`` and ``end`` are bytes of the document's text. White space around an item is
    ignored. Null and empty texts hold nothing. Equal items are reported one by one, and
    each row of a repeated document by itself. Occurrences of one item whose diagonals lie
    in neighbouring bands count as one passage, given by the best of them. With another ``key``
    that column of ``docs`` stands in place of doc_id.
    """
    docs = docs.select(F.col("doc_id").cast("long") if key == "doc_id" else F.col(key), "text")
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {SCHEMA}"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, spec.block_bytes):
        index = index_items(block, spec)
        if index.ids:
            found = found.unionByName(stage(docs.mapInArrow(_finder(index, spec), schema), "leaks"))
    return found
