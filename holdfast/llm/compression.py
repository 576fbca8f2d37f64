"""Quality scores from compression: which labelled class's dictionary fits a text better.

One zstandard dictionary is trained on good texts and one on bad texts. A text is
compressed whole with each; the difference of the two sizes, divided by the larger, goes
through a logistic curve fitted on labelled texts that neither dictionary has seen.

Learning uses a bounded sample of the labelled rows (``CompressionSpec``), the first in the
order of a hash of doc_id. Scoring reads every text once and needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words


@dataclass(frozen=True)
class CompressionSpec:
    """``dictionary_rows`` texts of each class train the dictionaries, in segments of
    ``segment`` bytes; ``curve_rows`` other texts fit the curve. Texts of more than
    ``longest`` characters are not learned from."""

    dictionary_rows: int = 400
    curve_rows: int = 2000
    longest: int = 200_000
    dictionary_bytes: int = 65_536
    segment: int = 2048
    level: int = 3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    level: int

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        made = []
        for content in (self.good, self.bad):
            own = None
            if content:
                own = zstandard.ZstdCompressionDict(content)
                own.precompute_compress(level=self.level)
            made.append(
                zstandard.ZstdCompressor(
                    level=self.level,
                    dict_data=own,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )
        return tuple(made)


def differences(texts: list[bytes], model: CompressionModel, compressors: tuple | None = None) -> np.ndarray:
    """(bad size - good size) / larger size for each text."""
    good, bad = compressors or model.compressors()
    found = np.empty(len(texts))
    for i, text in enumerate(texts):
        a, b = len(good.compress(text)), len(bad.compress(text))
        found[i] = (b - a) / max(a, b)
    return found


def is_held_out(key) -> F.Column:
    """Whether a row is kept out of learning: crc32 of its id as text is divisible by 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def usable_labels(labels: DataFrame, label: str) -> DataFrame:
    """(id, label): the 0/1 labels that learning may use; of several for an id the largest."""
    usable = labels.where(F.col(label).isin(0, 1) & ~is_held_out("doc_id"))
    return usable.groupBy(F.col("doc_id").alias("id")).agg(F.max(label).alias("label"))


def labelled_sample(docs: DataFrame, usable: DataFrame, rows: int, longest: int) -> list:
    """(id, text, label) of at most ``rows`` labelled documents of each class."""
    order = F.xxhash64(F.lit("sample"), "id")
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).orderBy(order, "id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select("doc_id", "text").where(F.length("text") <= longest)
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    found = found.groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return found.orderBy(order, "id").collect()


def _dictionary(texts: list[bytes], spec: CompressionSpec) -> bytes:
    """A trained dictionary; where there is too little to train one, the texts themselves."""
    pieces = [t[k : k + spec.segment] for t in texts for k in range(0, len(t), spec.segment)]
    pieces = [p for p in pieces if len(p) >= 8]
    try:
        return zstandard.train_dictionary(spec.dictionary_bytes, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-spec.dictionary_bytes :]


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a small ridge."""
    centre, spread = float(x.mean()), float(x.std()) or 1.0
    design = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    weights = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ weights))
        slope = design.T @ (weight * (y - p)) - 1e-3 * weights
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / spread), float(weights[1] - weights[0] * centre / spread)


def fit_compression(docs: DataFrame, labels: DataFrame, label: str, spec=CompressionSpec()) -> CompressionModel:
    """Dictionaries and curve from the labelled rows that are not held out.

    Without labelled texts of both classes the score is the same for all texts: the share of
    label 1 (one half without any label).
    """
    usable = usable_labels(labels, label)
    rows = labelled_sample(docs, usable, spec.dictionary_rows + spec.curve_rows, spec.longest)
    by_class = {v: [r.text.encode() for r in rows if r.label == v] for v in (0, 1)}
    if not (by_class[0] and by_class[1]):
        share = (len(by_class[1]) + 0.5) / (len(rows) + 1)
        return CompressionModel(b"", b"", 0.0, math.log(share / (1 - share)), spec.level)
    # A small class lends at most half of its texts to the dictionary.
    cut = {v: min(spec.dictionary_rows, (len(t) + 1) // 2) for v, t in by_class.items()}
    good, bad = (_dictionary(by_class[v][: cut[v]], spec) for v in (1, 0))
    plain = CompressionModel(good, bad, 1.0, 0.0, spec.level)
    rest = {v: t[cut[v] :] or t for v, t in by_class.items()}
    # The sample holds as many rows of each class; each class weighs what it does in the labels.
    total = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    x = differences(rest[0] + rest[1], plain)
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    weight = np.repeat([total[v] / len(rest[v]) for v in (0, 1)], [len(rest[0]), len(rest[1])])
    slope, intercept = fit_curve(x, y, weight * len(x) / weight.sum())
    return CompressionModel(good, bad, slope, intercept, spec.level)


def _scorer(model: CompressionModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in words.row_slices(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            z = model.slope * differences(texts, model, compressors) + model.intercept
            own = pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())
            at = batch.schema.get_field_index("score")
            columns = [own if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return score


def score_quality(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more like label 1); a column of that name is
    replaced. Null texts score as empty ones; every row is scored, equal texts alike."""
    docs = docs.withColumn("score", F.lit(0.0))
    return docs.mapInArrow(_scorer(model), docs.schema)
