"""Jaccard join of shingle sets by parity sketches.

A sketch of a set XORs a hash of each shingle into one of its cells, so a cell tells the
parity of all that fell into it, and two sketches differ in no more cells than the sets differ in
shingles (their symmetric difference). It is used twice:

1. In coarse cells of 64 bits. Sets in one size band can differ in ``most_difference``
   shingles at most, so of their filled cells, taken in any common order, the first
   ``most_difference + 1`` have one in common: sets are joined on those. Bands overlap by
   what the similarity allows in size.
2. In cells of one bit, about as many as the set has shingles. Sets that share a coarse cell
   stay candidates only while the Hamming distance of these bits, a lower bound of the
   symmetric difference, is within the bound of their two sizes.

Connected candidates form families, inside which full sets are compared. Equal sets are one
node throughout. Cells that very many sets share, as common passages make them, come last in
the common order: a set whose other cells are enough does not use them. So they cost nothing
but to the sets that consist of them, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.llm.blocks import linked_components
from holdfast.sources.staging import stage

_U = np.uint64


@dataclass(frozen=True)
class ParitySpec:
    """Similarity is at least ``percent`` of 100. Size bands grow by ``growth`` of 100 and have
    ``spare`` of 100 cells for each that must be filled. A cell shared by more than ``common``
    sets comes last in the order; ``block`` members of a group are compared at a time, and a
    set counts as one more member for each ``heavy`` of its shingles."""

    shingle: int = 5
    percent: int = 80
    growth: int = 150
    spare: int = 125
    common: int = 256
    block: int = 256
    heavy: int = 16384

    def most_difference(self, a, b):
        """The largest symmetric difference of sets of sizes a and b that are similar."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)


@cache
def band_starts(spec: ParitySpec) -> np.ndarray:
    """The least size of each band."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * spec.growth // 100))
    return np.array(starts)


def views(size: int, spec: ParitySpec) -> Iterator[tuple[int, int, int]]:
    """(band, cells needed, cells) in which a set of ``size`` meets its partners: a pair meets
    in the band of its smaller set."""
    starts = band_starts(spec)
    band = int(np.searchsorted(starts, size, "right")) - 1
    while band >= 0:
        largest = int(starts[band + 1]) - 1
        partner = 100 * largest // spec.percent
        if partner < size:
            return
        needed = spec.most_difference(largest, partner) + 1
        if needed > 1:
            yield band, needed, needed * spec.spare // 100 + 1
        band -= 1


def coarse_cells(shingles: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, content) of the filled cells; a content is the XOR of its shingles' hashes."""
    place = (words.mix(shingles) % _U(cells)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    filled, first = np.unique(place[order], return_index=True)
    return filled, np.bitwise_xor.reduceat(shingles[order], first)


def join_keys(shingles: np.ndarray, spec: ParitySpec) -> Iterator[tuple[int, int, np.ndarray]]:
    """Per view (view, keys that are not needed, keys).

    Where the filled cells are too few, empty ones could be all that two such sets share.
    Those sets also meet in a second view of the band, with each shingle in a cell of its own.
    """
    for band, needed, cells in views(len(shingles), spec):
        place, content = coarse_cells(shingles, cells)
        salt = words.constants(2, 1000 + band)
        yield 2 * band, max(len(place) - needed, 0), words.mix(content ^ words.mix(place.astype(_U) + salt[0]))
        if len(place) < needed:
            yield 2 * band + 1, len(shingles) - needed, words.mix(shingles ^ salt[1])


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits of a set, packed to 64-bit words; their number is the power of two from
    the set's size on."""
    bits = 64
    while bits < len(shingles):
        bits *= 2
    odd = np.bincount((words.mix(shingles + _U(1)) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(_U)


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """The sketch of the same set with ``width`` words: bits that fall together are XORed."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, width), axis=0)


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(words.mix(words.mix(shingles).sum(keepdims=True) ^ _U(len(shingles))).view(np.int64)[0])


def _sets(batch: pa.RecordBatch, column: int, spec: ParitySpec) -> Iterator[tuple[int, list[np.ndarray]]]:
    for row, data, offsets in words.text_pieces(batch.column(column)):
        yield row, list(words.Words(data, offsets, lower=True).shingle_sets(spec.shingle))


def _signer(spec: ParitySpec):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.row_slices(batches):
            for row, sets in _sets(batch, 1, spec):
                columns = [
                    batch.column(0)[row : row + len(sets)],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([bit_sketch(s).tobytes() for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "node", "bits"])

    return sign


def _keyer(spec: ParitySpec):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.row_slices(batches):
            for _, sets in _sets(batch, 0, spec):
                own = [(node_of(s), v, extra, keys) for s in sets if len(s) for v, extra, keys in join_keys(s, spec)]
                nodes, view, extra, keys = list(zip(*own)) or [()] * 4
                offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                flat = np.concatenate(keys) if keys else np.zeros(0, _U)
                columns = [
                    pa.array(nodes, pa.int64()),
                    pa.array(view, pa.int32()),
                    pa.array(extra, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "view", "extra", "keys"])

    return key


def _carrier(spec: ParitySpec):
    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.row_slices(batches):
            for _, sets in _sets(batch, 0, spec):
                sets = [s for s in sets if len(s)]
                columns = [
                    pa.array([node_of(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "held"])

    return carry


def near_bits(table: pa.Table, spec: ParitySpec) -> Callable:
    """``similar`` by sizes and the Hamming distance of the bit sketches."""
    sizes = table.column("n").to_numpy()
    sketches = [np.frombuffer(b, _U) for b in table.column("bits").to_pylist()]
    width = min(map(len, sketches))
    bits = np.stack([folded(s, width) for s in sketches])

    def similar(x: int, ys: np.ndarray) -> np.ndarray:
        low, high = np.minimum(sizes[x], sizes[ys]), np.maximum(sizes[x], sizes[ys])
        fit = 100 * low >= spec.percent * high
        apart = np.bitwise_count(bits[ys[fit]] ^ bits[x]).sum(axis=1, dtype=np.int64)
        fit[fit] = apart <= spec.most_difference(sizes[x], sizes[ys[fit]])
        return fit

    return similar


def near_sets(table: pa.Table, spec: ParitySpec) -> Callable:
    """``similar`` by the bit sketches, then exactly by the full sets."""
    maybe = near_bits(table, spec)
    sets = [np.frombuffer(b, _U) for b in table.column("held").to_pylist()]

    def similar(x: int, ys: np.ndarray) -> np.ndarray:
        fit = maybe(x, ys)
        for k in np.flatnonzero(fit).tolist():
            small, large = sorted((sets[x], sets[ys[k]]), key=len)
            at = np.searchsorted(large, small)
            shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            fit[k] = 100 * shared >= spec.percent * (len(small) + len(large) - shared)
        return fit

    return similar


def joined_groups(docs: DataFrame, spec: ParitySpec) -> DataFrame:
    """(group, id, size): nodes that share a key, each set of such nodes once."""
    keys = docs.select("text").mapInArrow(_keyer(spec), "id long, view int, extra int, keys array<long>")
    rows = keys.select("id", "view", "extra", F.explode("keys").alias("key")).repartition("key")
    by_key = Window.partitionBy("key")
    # Equal sets give equal rows, of which one stays.
    once = rows.withColumn("same", F.lag("id").over(by_key.orderBy("id"))).where("same IS NULL OR same <> id")
    shared = stage(
        once.select(
            "key",
            "id",
            "view",
            "extra",
            F.count(F.lit(1)).over(by_key).alias("size"),
            F.bit_xor(F.xxhash64("id")).over(by_key).alias("all"),
            F.bit_xor(F.xxhash64("id", F.lit(1))).over(by_key).alias("all2"),
        ).where("size > 1"),
        "shared",
    )
    # A set uses common cells only where the others are too few.
    common = shared.where(F.col("size") > spec.common)
    short = common.groupBy("id", "view").agg(F.count(F.lit(1)).alias("n"), F.first("extra").alias("most"))
    short = short.where("n > most").select("id", "view")
    used = common.join(short, ["id", "view"]).select("key", "id")
    sizes = used.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    used = used.join(sizes, "key").select(F.col("key").alias("group"), "id", "size")
    rare = shared.where(F.col("size") <= spec.common)
    rare = rare.select(F.xxhash64("all", "all2", "size").alias("group"), "id", "size").distinct()
    return rare.union(used.select("group", "id", "size"))


def similar_components(docs: DataFrame, spec: ParitySpec = ParitySpec()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text).

    ``n_shingles`` is the size of the text's shingle set, ``component_id`` the smallest
    doc_id reachable through links, the row's own included. A null or blank text has no
    shingles and no links. Rows with the same doc_id are judged each by its own text; a
    null doc_id is never the smallest, and a component of such rows only has a null one.
    Other columns are ignored. Sets are told apart by 64-bit hashes of their shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = "doc_id long, n_shingles long, node long, bits binary"
    signed = stage(docs.mapInArrow(_signer(spec), fields), "signed")
    own = signed.where("node IS NOT NULL")
    nodes = own.groupBy("node").agg(F.min("doc_id").alias("first"))

    # Candidates by their sketches.
    groups = stage(joined_groups(docs.where("doc_id IS NOT NULL"), spec), "groups")
    sketches = own.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "bits")
    sketches = sketches.join(groups.select("id").distinct(), "id").dropDuplicates(["id"])
    sketches = stage(sketches, "sketches")
    families = linked_components(groups, sketches, lambda t: near_bits(t, spec), spec.block)
    families = stage(families, "families")

    # Links by the full sets, read from each node's first document.
    weighed = families.join(sketches.select(F.col("id").alias("node"), "n"), "node")
    sizes = weighed.groupBy("component").agg(
        F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") / spec.heavy)).alias("size")
    )
    members = families.join(sizes, "component").select(
        F.col("component").alias("group"), F.col("node").alias("id"), "size"
    )
    wanted = families.join(nodes, "node").select(F.col("first").alias("doc_id")).distinct()
    # Written first, so that Spark knows its size before it would shuffle the texts.
    held = docs.join(stage(wanted, "wanted"), "doc_id").select("text").mapInArrow(_carrier(spec), "id long, held binary")
    held = held.groupBy("id").agg(F.first("held").alias("held")).join(sketches, "id")
    linked = linked_components(members, stage(held, "sets"), lambda t: near_sets(t, spec), spec.block)
    linked = stage(linked, "linked")

    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    found = signed.join(named, "node", "left")
    whole = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", whole.alias("component_id"))
