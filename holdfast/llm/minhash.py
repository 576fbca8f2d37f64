"""Near-duplicate groups: MinHash bands, sequential Bayesian pruning, exact verification.

1. Every text becomes the set of its word shingles; equal sets collapse to a class, whose
   representative is its smallest doc_id. Copies are never expanded into pairs.
2. Representatives that share a band of their MinHash signature are candidates. Signatures
   are compared in batches; after each batch a pair is dropped once the posterior
   probability that its similarity reaches the threshold falls below ``miss``.
3. Surviving candidates form families. Inside a family the full sets of all pairs not yet
   known to be connected are compared exactly.
4. Connected components of the confirmed links are the groups.

Crowded bands and large families are compared in blocks (:mod:`holdfast.llm.blocks`): first
inside random blocks, then only what is not connected yet, so a family of copies costs in
proportion to its size and no task holds more than a few blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.llm.blocks import linked_components
from holdfast.sources.staging import stage


@dataclass(frozen=True)
class NearDupSpec:
    """Similarity is at least ``percent`` of 100. A pair exactly at 80 % shares no band with
    probability (1 - .8^5)^36 = 6e-7, and is dropped by the comparison of signatures with
    probability ``miss`` per batch at most."""

    shingle: int = 5
    percent: int = 80
    bands: int = 36
    rows: int = 5
    batches: int = 5
    miss: float = 1e-7
    block: int = 256


def least_matches(spec: NearDupSpec) -> list[int]:
    """After each batch, the fewest equal values a pair may have.

    With a uniform prior the posterior of the similarity after k matches in n is
    Beta(k + 1, n - k + 1); its tail above t equals P(Binomial(n + 1, t) <= k).
    """
    t = spec.percent / 100
    bounds = []
    for batch in range(1, spec.batches + 1):
        n = spec.bands * spec.rows * batch // spec.batches
        tail, k = 0.0, 0
        while k <= n:
            tail += math.comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k)
            if tail >= spec.miss:
                break
            k += 1
        bounds.append(k)
    return bounds


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a non-empty set."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[None, at : at + 2048] * multipliers[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _digest(held: bytes) -> bytes:
    return hashlib.blake2b(held, digest_size=16).digest()


def _signer(spec: NearDupSpec) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = words.constants(spec.bands * spec.rows, 5)
        salts = words.constants(spec.bands, 7)
        factors = words.constants(spec.rows, 9)
        for batch in batches:
            for row, data, offsets in words.text_pieces(batch.column(1)):
                sizes, digests, keys, values = [], [], [], []
                for own in words.Words(data, offsets, lower=True).shingle_sets(spec.shingle):
                    sizes.append(len(own))
                    if not len(own):
                        digests.append(None), keys.append(None), values.append(None)
                        continue
                    least = words.mix(signature(own, multipliers))
                    banded = (least.reshape(spec.bands, spec.rows) * factors).sum(axis=1)
                    digests.append(_digest(own.tobytes()))
                    keys.append(words.mix(banded + salts).view(np.int64))
                    values.append((least >> np.uint64(48)).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[row : row + len(sizes)].cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(values, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "digest", "keys", "sig"],
                )

    return sign


def _shingler(spec: NearDupSpec) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in words.text_pieces(batch.column(1)):
                sets = words.Words(data, offsets, lower=True).shingle_sets(spec.shingle)
                held = [own.tobytes() for own in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[row : row + len(held)],
                        pa.array([_digest(own) for own in held], pa.binary()),
                        pa.array(held, pa.binary()),
                    ],
                    ["id", "digest", "held"],
                )

    return cut


def near_signatures(table: pa.Table, spec: NearDupSpec) -> Callable:
    """``similar`` by batches of signature values: a pair goes as soon as a batch rules it out."""
    width = spec.bands * spec.rows
    edges = [width * k // spec.batches for k in range(spec.batches + 1)]
    bounds = least_matches(spec)
    sigs = np.stack([np.frombuffer(s, "<u2") for s in table.column("sig").to_pylist()])

    def similar(x: int, ys: np.ndarray) -> np.ndarray:
        left, matches = np.arange(len(ys)), np.zeros(len(ys), np.int32)
        for (a, b), least in zip(zip(edges, edges[1:]), bounds):
            matches += (sigs[ys[left], a:b] == sigs[x, a:b]).sum(axis=1, dtype=np.int32)
            keep = matches >= least
            left, matches = left[keep], matches[keep]
            if not len(left):
                break
        fit = np.zeros(len(ys), bool)
        fit[left] = True
        return fit

    return similar


def near_sets(table: pa.Table, spec: NearDupSpec) -> Callable:
    """``similar`` by the signatures, then exactly by the full sets."""
    maybe = near_signatures(table, spec)
    sets = [np.frombuffer(s, np.uint64) for s in table.column("held").to_pylist()]

    def similar(x: int, ys: np.ndarray) -> np.ndarray:
        fit = maybe(x, ys)
        for k in np.flatnonzero(fit).tolist():
            small, large = sorted((sets[x], sets[ys[k]]), key=len)
            fit[k] = False
            if 100 * len(small) >= spec.percent * len(large):
                at = np.searchsorted(large, small)
                shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                fit[k] = 100 * shared >= spec.percent * (len(small) + len(large) - shared)
        return fit

    return similar


def near_duplicates(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, class_id) for each row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id with the same shingle set, ``component_id`` the
    smallest reachable through links. A null or blank text has no shingles and no links: it
    is its own component. Rows with the same doc_id are one document: they share a
    component when their sets are linked and are kept or dropped together. A null doc_id
    belongs to the class of its set, links nothing by itself, and is kept only where no
    other row has its set. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(
        docs.mapInArrow(
            _signer(spec), "doc_id long, n_shingles long, digest binary, keys array<long>, sig binary"
        ),
        "signatures",
    )
    classes = stage(
        signed.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("sig").alias("sig")),
        "classes",
    )
    sigs = classes.where("id IS NOT NULL").select("id", "digest", "sig")
    banded = classes.where("id IS NOT NULL").select("id", F.explode("keys").alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # Written once: few bands are shared, and each pass over them would shuffle all bands again.
    crowded = stage(banded.join(sizes, "key").withColumnRenamed("key", "group"), "crowded")
    candidates = sigs.select("id", "sig")
    # The bands overlap, so their blocks need not.
    families = linked_components(
        crowded, candidates, lambda t: near_signatures(t, spec), spec.block, overlap=False
    )
    families = stage(families, "families")

    sizes = families.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = families.join(sizes, "component").select(
        F.col("component").alias("group"), F.col("node").alias("id"), "size"
    )
    members = stage(members, "members")
    # Written first, so that Spark knows its size before it would shuffle the texts.
    texts = docs.join(stage(families.select(F.col("node").alias("doc_id")), "wanted"), "doc_id")
    held = texts.mapInArrow(_shingler(spec), "id long, digest binary, held binary")
    held = held.groupBy("id", "digest").agg(F.first("held").alias("held"))
    held = stage(held.join(sigs, ["id", "digest"]).drop("digest"), "sets")
    components = stage(
        linked_components(members, held, lambda t: near_sets(t, spec), spec.block), "components"
    )

    known = classes.select("digest", F.col("id").alias("class_id")).join(
        components.withColumnsRenamed({"node": "class_id", "component": "linked"}), "class_id", "left"
    )
    found = signed.select("doc_id", "n_shingles", "digest").join(known, "digest", "left")
    whole = F.coalesce("linked", "class_id", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        whole.alias("component_id"),
        F.col("doc_id").eqNullSafe(whole).alias("kept"),
        F.coalesce("class_id", "doc_id").alias("class_id"),
    )
