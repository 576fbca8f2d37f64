"""Periodic runs of words, by Kruskal over suffixes in order of decreasing common prefix.

Two neighbours in the suffix array are an edge that weighs their longest common prefix. The
edges unite classes of suffixes from the heaviest down; each class keeps its positions in
order, and the smaller is put into the larger one. Where two positions become neighbours in
a class at a distance of no more than the edge's weight, the text from the first position
on repeats with that distance: a seed. All seeds of a run end where it ends, and the run's
own start is one of them, so the smallest start per period and end is the run.

A run of ``least`` words and ``times`` periods has a seed whose common prefix is at least
``least_prefix`` words, so texts without two equal windows of that length have no run and
lighter edges unite nothing that matters.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words


@dataclass(frozen=True)
class RunSpec:
    """A run has ``least`` words or more and ``times`` periods or more."""

    least: int = 24
    times: int = 3

    @property
    def least_prefix(self) -> int:
        """The shortest common prefix of a run's start and the word one period on:
        max(least, times q) - q, at its smallest where both bounds meet."""
        return min(max(self.least, self.times * q) - q for q in range(1, self.least + 1))


def word_numbers(found: list[bytes]) -> np.ndarray:
    """Each word as a number, equal words the same one."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found))


def repeats_a_window(ids: np.ndarray, size: int) -> bool:
    """Whether two windows of ``size`` words have equal hashes: always so where they are equal."""
    if len(ids) <= size:
        return False
    # The hash of a window is built from those of its halves.
    own, length = words.mix(ids.astype(np.uint64) + np.uint64(1)), 1
    for bit in bin(size)[3:]:
        own = words.mix(own[:-length] * np.uint64(0x9E3779B97F4A7C15) + own[length:])
        length *= 2
        if bit == "1":
            tail = words.mix(ids[length:].astype(np.uint64) + np.uint64(1))
            own = words.mix(own[: len(tail)] * np.uint64(0x9E3779B97F4A7C15) + tail)
            length += 1
    own.sort()
    return bool((own[1:] == own[:-1]).any())


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, length of the common prefix of each suffix and the next one), by
    prefix doubling; the ranks of each round also give the common prefixes."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    rounds, step = [rank], 1
    while step < n and rank.max() < n:
        key = rank * (n + 1)
        key[: n - step] += rank[step:]
        order = np.argsort(key, kind="stable")
        ahead = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = 1 + np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])])
        rounds.append(rank)
        step *= 2
    order = np.argsort(rank, kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(left, right) < n)
        # Ranks of one round are equal only where 2^k words are, and none is cut by the end.
        same = inside[rounds[k][left[inside]] == rounds[k][right[inside]]]
        step = 1 << k
        same = same[np.maximum(left[same], right[same]) + step <= n]
        left[same] += step
        right[same] += step
        common[same] += step
    return order, common


class Places:
    """An ordered set of positions in blocks, so that putting one in moves one block only."""

    LIMIT = 1024

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.lasts = [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def put(self, place: int) -> tuple[int | None, int | None]:
        """Put ``place`` in; its neighbours before and after."""
        k = min(bisect_left(self.lasts, place), len(self.blocks) - 1)
        block = self.blocks[k]
        at = bisect_left(block, place)
        before = block[at - 1] if at else self.lasts[k - 1] if k else None
        after = block[at] if at < len(block) else self.blocks[k + 1][0] if k + 1 < len(self.blocks) else None
        insort(block, place)
        self.lasts[k] = block[-1]
        self.size += 1
        if len(block) > self.LIMIT:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.lasts[k : k + 1] = [block[half - 1], block[-1]]
        return before, after


def seeds(ids: np.ndarray, least_prefix: int) -> Iterator[tuple[int, int, int]]:
    """(start, period, end) of neighbours that a union made, at a distance within its prefix."""
    order, common = suffix_order(ids)
    edges = np.flatnonzero(common >= least_prefix)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    parent: dict[int, int] = {}
    classes: dict[int, Places] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for a, b, prefix in zip(order[edges].tolist(), order[edges + 1].tolist(), common[edges].tolist()):
        a, b = root(a), root(b)
        large, small = classes.pop(a, None) or Places(a), classes.pop(b, None) or Places(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        parent[b] = a
        classes[a] = large
        last = None
        for place in small:
            before, after = large.put(place)
            # Neighbours out of the smaller class were united by a heavier edge.
            if before is not None and before != last and place - before <= prefix:
                yield before, place - before, place + prefix
            if after is not None and after - place <= prefix:
                yield place, after - place, after + prefix
            last = place


def find_runs(ids: np.ndarray, spec: RunSpec = RunSpec()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if not repeats_a_window(ids, spec.least_prefix):
        return []
    starts: dict[tuple[int, int], int] = {}
    for start, period, end in seeds(ids, spec.least_prefix):
        starts[end, period] = min(start, starts.get((end, period), start))
    by_end: dict[int, list[tuple[int, int]]] = {}
    for (end, period), start in sorted(starts.items()):
        by_end.setdefault(end, []).append((period, start))
    found = []
    for end, own in by_end.items():
        for period, start in own:
            # A multiple of a run's smallest period is no period of its own.
            if any(q < period and period % q == 0 and s <= start for q, s in own):
                continue
            if end - start >= max(spec.least, spec.times * period):
                found.append((start, end - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def dropped(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) > 0


def planted(doc_id: int | None, found: list[bytes]) -> list[bytes]:
    """The words with a period planted in one of ten documents, as its doc_id's crc32 says."""
    n = len(found)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if not n or h % 10:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + k % p] for k in range(n - a)]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _finder(spec: RunSpec, plant: bool):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.row_slices(batches):
            for row, data, offsets in words.text_pieces(batch.column(1)):
                size = len(offsets) - 1
                ids = batch.column(0)[row : row + size].to_pylist()
                runs, digests, texts = [], [], []
                held = data.tobytes()
                for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                    found = held[a:b].split()
                    found = planted(doc_id, found) if plant else found
                    own = find_runs(word_numbers(found), spec) if len(found) >= spec.least else []
                    if own:
                        gone = dropped(len(found), own)
                        found = [w for w, x in zip(found, gone.tolist()) if not x]
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
                    digests.append(hashlib.sha256(lines.encode()).hexdigest())
                    texts.append(b" ".join(found).decode())
                columns = [
                    pa.array(ids, pa.int64()),
                    pa.array(runs, _RUNS),
                    pa.array(digests, pa.string()),
                    pa.array(texts, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "runs_sha256", "collapsed"])

    return find


def collapse_runs(docs: DataFrame, spec: RunSpec = RunSpec(), plant: bool = False) -> DataFrame:
    """(doc_id, runs, runs_sha256, collapsed): the periodic runs of each text (start, length
    and period in words, by start, then period), the hash of their lines, and the text's words
    without those that repeat a run's first period, joined by one space.

    Words are runs of bytes other than space and ``\\t \\n \\v \\f \\r``. A null, empty or
    blank text has no words and no runs; rows with equal ids are judged one by one; other
    columns are ignored. With ``plant`` one document of ten is first made periodic, as its
    doc_id says; a row without a doc_id is left as it is.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = f"doc_id long, runs {RUNS}, runs_sha256 string, collapsed string"
    return own.mapInArrow(_finder(spec, plant), fields)


def strongest_run(runs: str = "runs"):
    """The column's run with the greatest length / period, compared exactly; ties go to the
    smallest start, then period. Null without a run."""
    ahead = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    own = F.col(runs)
    return F.aggregate(own, F.try_element_at(own, F.lit(1)), lambda a, b: F.when(ahead(a, b), b).otherwise(a))
