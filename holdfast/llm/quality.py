"""Quality rules: counts per text, and a cascade of rules in the best order.

``base_counts`` measures whole texts, vectorised. ``order_rules`` runs every rule on a
bounded sample, takes its mean cost and the share it rejects, and orders the rules by
rejection per cost. ``cascade`` runs them in that order and stops at a document's first
rejection. The verdict does not depend on the order, only the work does.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_document(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes in each document."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _seen_before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether an equal one stands before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return twice, later


def counts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``COUNTS`` per document of a piece."""
    found = words.Words(data, offsets)
    docs = len(offsets) - 1
    starts_char = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int8)
    inside[found.starts] += 1
    np.subtract.at(inside, found.ends, 1)
    in_word = np.cumsum(inside[:-1]).astype(bool)

    breaks = np.flatnonzero(data == 10)
    begins = np.union1d(offsets[:-1], breaks + 1)
    owner = np.searchsorted(offsets, begins, "right") - 1
    # A break may be a document's last byte: the line behind it is empty and has no word.
    ends = np.append(begins[1:], len(data))
    ends = np.where(np.isin(ends - 1, breaks) & (ends > begins), ends - 1, ends)
    full = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, begins)
    begins, ends, owner = begins[full], ends[full], owner[full]
    digest = words.span_digests(data, begins, ends)[0]
    _, later = _seen_before(words.mix(digest ^ words.mix(owner.astype(np.uint64))))

    hashes, first = found.windows(WINDOW)
    window_owner = np.repeat(np.arange(docs), np.diff(first))
    twice, _ = _seen_before(words.mix(hashes ^ words.mix(window_owner.astype(np.uint64))))
    at = np.flatnonzero(twice)
    at = at - first[window_owner[at]] + found.first[window_owner[at]]
    cover = np.zeros(len(found.hashes) + 1, np.int64)
    cover[at] += 1
    np.subtract.at(cover, at + WINDOW, 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return np.column_stack(
        [
            np.diff(found.first),
            _per_document(starts_char & in_word, offsets),
            _per_document(_SYMBOL[data], offsets),
            np.bincount(owner[later], minlength=docs),
            covered[found.first[1:]] - covered[found.first[:-1]],
        ]
    )


@dataclass(frozen=True)
class Document:
    """A text in UTF-8 with its base counts."""

    text: bytes
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


@dataclass(frozen=True)
class QualityRule:
    """``rejects`` says whether a document is to go; it must be a pure function of it."""

    name: str
    rejects: Callable[[Document], bool]


_UPPER, _LETTER = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])


def _odd_word_length(d: Document) -> bool:
    return d.word_chars < 2 * d.n_words or d.word_chars > 12 * d.n_words


def _symbols(d: Document) -> bool:
    return 10 * d.n_symbols > 3 * d.n_words


def _shouting(d: Document) -> bool:
    size = len(d.text)
    upper = size - len(d.text.translate(None, _UPPER))
    return 2 * upper > size - len(d.text.translate(None, _LETTER))


def _repeated_lines(d: Document) -> bool:
    return d.n_dup_lines > 0 and 3 * d.n_dup_lines > d.text.count(b"\n") + 1


def _exclamations(d: Document) -> bool:
    return 10 * d.text.count(b"!") > 3 * d.n_words


RULES = (
    QualityRule("odd_word_length", _odd_word_length),
    QualityRule("symbols", _symbols),
    QualityRule("shouting", _shouting),
    QualityRule("repeated_lines", _repeated_lines),
    QualityRule("exclamations", _exclamations),
)


@dataclass(frozen=True)
class RuleEstimate:
    name: str
    cost: float
    rejected: float


def _documents(texts: pa.Array) -> Iterator[Document]:
    for _, data, offsets in words.text_pieces(texts):
        rows = counts_of(data, offsets).tolist()
        whole = data.tobytes()
        for a, b, row in zip(offsets.tolist(), offsets[1:].tolist(), rows):
            yield Document(whole[a:b], *row)


def order_rules(docs: DataFrame, rules: Sequence[QualityRule], sample_rows: int = 500) -> list[RuleEstimate]:
    """Estimates in the order to run in, from the first ``sample_rows`` documents in the order
    of a hash of doc_id. On an empty table the given order stays."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64(F.lit("rules"), "doc_id"), "doc_id").limit(sample_rows)
    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    sample = list(_documents(pa.array([r.text for r in texts.collect()], pa.string())))
    if not sample:
        return [RuleEstimate(r.name, 0.0, 0.0) for r in rules]
    found = []
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(rule.rejects(d) for d in sample)
        cost = max(time.perf_counter() - began, 1e-9) / len(sample)
        found.append(RuleEstimate(rule.name, cost, rejected / len(sample)))
    return sorted(found, key=lambda e: (-e.rejected / e.cost, e.name))


def _judge(rules: Sequence[QualityRule], base: Callable[[Document], bool]):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, failed, rejected = [], [], []
            for d in _documents(batch.column(1)):
                rows.append([getattr(d, c) for c in COUNTS])
                failed.append(base(d))
                first = None if failed[-1] else next((r.name for r in rules if r.rejects(d)), None)
                rejected.append(first)
            counts = np.array(rows, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    *[pa.array(counts[:, k]) for k in range(len(COUNTS))],
                    pa.array(failed, pa.bool_()),
                    pa.array(rejected, pa.string()),
                ],
                ["doc_id", *COUNTS, "base_failed", "rejected_by"],
            )

    return judge


def fails_base(d: Document) -> bool:
    return d.n_words < 20 or 100 * d.n_repeat_words > 30 * d.n_words


def cascade(
    docs: DataFrame,
    rules: Sequence[QualityRule] = RULES,
    base: Callable[[Document], bool] = fails_base,
    sample_rows: int = 500,
) -> DataFrame:
    """(doc_id, counts, base_failed, rejected_by, kept) for each row of ``docs``.

    Documents that fail ``base`` are not kept and no rule sees them. ``rejected_by`` is the
    first rule, in the order used, that rejects the document. A null or empty text has only
    zero counts. Rows are judged one by one, repeated ones alike; other columns are ignored.
    """
    by_name = {r.name: r for r in rules}
    ordered = [by_name[e.name] for e in order_rules(docs, rules, sample_rows)]
    counts = ", ".join(f"{c} long" for c in COUNTS)
    judged = docs.select("doc_id", "text").mapInArrow(
        _judge(ordered, base), f"doc_id long, {counts}, base_failed boolean, rejected_by string"
    )
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
