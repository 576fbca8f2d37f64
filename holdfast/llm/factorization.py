"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words in lower case (A-Z) between ASCII separators, and the first
four, five and six bytes of longer words; each is a 64-bit hash, present or not. The score
is the logistic of

    bias + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms the model knows, so it learns pairs, such as an insult beside the mention of
a group, that no sum of single weights can express.

The model is fitted on a bounded sample of labelled rows (``MachineSpec``); executors turn
the sample's whole texts into term hashes. Scoring reads every text once without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.llm.compression import usable_labels
from holdfast.sources.staging import stage

PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class MachineSpec:
    """At most ``rows`` texts of each class, of at most ``longest`` characters, are learned
    from; ``terms`` is the number of terms kept, by their chi-square with the label. The
    driver holds no more than the kept terms of the sample's texts."""

    rows: int = 6000
    longest: int = 200_000
    terms: int = 1024
    least_texts: int = 4
    factors: int = 4
    epochs: int = 30
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-3


def piece_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, owner) of a piece: hashes of all words and prefixes with their documents."""
    found = words.Words(data, offsets, lower=True, separators=words.PUNCTUATION)
    owner = np.searchsorted(found.first, np.arange(len(found.hashes)), "right") - 1
    salts = words.constants(len(PREFIXES), 41)
    hashes, owners = [found.hashes], [owner]
    for size, salt in zip(PREFIXES, salts):
        long = np.flatnonzero(found.ends - found.starts > size)
        hashes.append(words.mix(found.prefix_hashes(long, size) ^ salt))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def positions(terms: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the known hashes in the sorted terms, and which hashes are known."""
    if not len(terms):
        return np.zeros(0, int), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    hit = terms[at] == hashes
    return at[hit], hit


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in words.text_pieces(batch.column(2)):
            hashes, owner = _distinct(*piece_terms(data, offsets))
            docs = len(offsets) - 1
            bounds = np.searchsorted(owner, np.arange(docs + 1))
            held = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[row : row + docs], batch.column(1)[row : row + docs], held],
                ["id", "label", "held"],
            )


def _known_lists(terms: np.ndarray):
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [positions(terms, np.array(h, np.int64).view(np.uint64))[0] for h in batch.column(2).to_pylist()]
            lists = pa.array(held, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists], ["id", "label", "known"])

    return known


@dataclass(frozen=True)
class Machine:
    """Sorted ``terms`` with a weight and a factor vector each, and the bias."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def logits(self, at: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
        """Of documents given as pairs (position of a known term, document)."""
        linear = np.bincount(owner, self.weights[at], docs)
        pairs = np.zeros(docs)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            pairs += np.bincount(owner, v, docs) ** 2 - np.bincount(owner, v * v, docs)
        return self.bias + linear + 0.5 * pairs


def _chosen_terms(lists: DataFrame, texts: int, ones: int, spec: MachineSpec) -> np.ndarray:
    """The sorted terms with the highest chi-square of presence and label in the sample."""
    share = ones / texts
    terms = lists.select("label", F.explode("held").alias("term")).groupBy("term")
    counts = terms.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
    gap = F.col("ones") - F.col("n") * share
    spread = F.col("n") * share * (1 - share) * (1 - F.col("n") / (texts + 1))
    best = counts.where(F.col("n") >= spec.least_texts).orderBy(F.desc(gap * gap / spread), "term")
    rows = best.limit(spec.terms).select("term").collect()
    return np.sort(np.array([r.term for r in rows], np.int64).view(np.uint64))


def train_machine(
    terms: np.ndarray, known: list[np.ndarray], y: np.ndarray, weight: np.ndarray, spec: MachineSpec
) -> Machine:
    """Mini-batch Adam on the weighted logistic loss of texts given as positions of their
    terms; the order of rows is a fixed shuffle."""
    draw = np.random.default_rng(17)
    size, k = len(terms), spec.factors
    share = float((weight * y).sum() / weight.sum())
    # Row 0 of the factor table holds the weights.
    table = np.vstack([np.zeros(size), draw.normal(0, 0.01, (k, size))])
    bias = math.log(share / (1 - share))
    first, second, step = np.zeros_like(table), np.zeros_like(table), 0
    for _ in range(spec.epochs):
        order = draw.permutation(len(y))
        for a in range(0, len(y), spec.batch):
            rows = order[a : a + spec.batch]
            at = np.concatenate([known[r] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(known[r]) for r in rows])
            values = table[:, at]
            sums = np.stack([np.bincount(owner, v, len(rows)) for v in values])
            squares = np.stack([np.bincount(owner, v * v, len(rows)) for v in values[1:]])
            z = bias + sums[0] + 0.5 * (sums[1:] ** 2 - squares).sum(axis=0)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            own = error[owner]
            slopes = [np.bincount(at, own, size)]
            slopes += [np.bincount(at, own * (sums[f][owner] - values[f]), size) for f in range(1, k + 1)]
            gradient = np.stack(slopes) + spec.decay * table
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient * gradient
            scaled = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            table -= spec.rate * scaled
            bias -= spec.rate * float(error.sum())
    return Machine(terms, table[0], np.ascontiguousarray(table[1:].T), bias)


def fit_machine(docs: DataFrame, labels: DataFrame, label: str, spec: MachineSpec = MachineSpec()) -> Machine:
    """A machine from the labelled rows that are not held out.

    Without labelled texts of both classes the score is the same for all texts: the share of
    label 1 (one half without any label).
    """
    usable = usable_labels(labels, label)
    total = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    order = F.xxhash64(F.lit("sample"), "id")
    parts = [usable.where(F.col("label") == v).orderBy(order, "id").limit(spec.rows) for v in (0, 1)]
    texts = docs.select("doc_id", "text").where(F.length("text") <= spec.longest)
    found = texts.join(F.broadcast(parts[0].union(parts[1])), F.col("doc_id") == F.col("id"))
    found = found.select(F.col("id").cast("long"), F.col("label").cast("int"), "text")
    lists = found.mapInArrow(_term_lists, "id long, label int, held array<long>")
    lists = stage(lists.groupBy("id", "label").agg(F.min("held").alias("held")), "terms")
    texts, ones = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < texts:
        share = (ones + 0.5) / (texts + 1)
        empty = np.zeros(0)
        return Machine(empty.astype(np.uint64), empty, np.zeros((0, spec.factors)), math.log(share / (1 - share)))
    terms = _chosen_terms(lists, texts, ones, spec)
    known = lists.mapInArrow(_known_lists(terms), "id long, label int, known array<int>")
    rows = sorted(known.collect(), key=lambda r: r.id)
    y = np.array([r.label for r in rows], float)
    # A class capped at ``rows`` weighs what it does among the labels.
    ratio = {v: total[v] / (y == v).sum() for v in (0, 1)}
    weight = np.where(y == 1, ratio[1], ratio[0])
    lists = [np.array(r.known, np.int64) for r in rows]
    return train_machine(terms, lists, y, weight / weight.mean(), spec)


def _scorer(machine: Machine):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A bitmap over the upper 22 bits turns most unknown terms away before the search.
        marked = np.zeros(1 << 22, bool)
        marked[(machine.terms >> np.uint64(42)).astype(np.int64)] = True
        for batch in batches:
            logits = np.full(batch.num_rows, machine.bias)
            for row, data, offsets in words.text_pieces(batch.column("text")):
                hashes, owner = piece_terms(data, offsets)
                near = marked[(hashes >> np.uint64(42)).astype(np.int64)]
                hashes, owner = _distinct(hashes[near], owner[near])
                at, hit = positions(machine.terms, hashes)
                docs = len(offsets) - 1
                logits[row : row + docs] = machine.logits(at, owner[hit], docs)
            own = pa.array(1 / (1 + np.exp(-np.clip(logits, -700, 700))))
            at = batch.schema.get_field_index("score")
            columns = [own if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return score


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more like label 1); a column of that name is
    replaced. Null, empty and unknown texts get the score of no terms; every row is scored."""
    docs = docs.withColumn("score", F.lit(0.0))
    return docs.mapInArrow(_scorer(machine), docs.schema)
