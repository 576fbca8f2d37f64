from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from holdfast.llm import factorization


def rows_of(n=900):
    """Toxic where an insult meets a group's name; each alone is clean."""
    draw = random.Random(8)
    plain = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = []
    for k in range(n):
        own = [draw.choice(plain) for _ in range(30)]
        kind = k % 4
        if kind in (1, 3):
            own.insert(draw.randrange(30), "Vermin!")
        if kind in (2, 3):
            own.insert(draw.randrange(30), "marzians")
        rows.append((k, " ".join(own), int(kind == 3)))
    return rows


@pytest.fixture
def tables(spark, docs):
    labels = spark.createDataFrame([(k, 1, t) for k, _, t in rows_of()] + [(None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    return docs([(k, t) for k, t, _ in rows_of()] + [(9000, None), (9001, ""), (9002, "q" * 300_000), (None, "a")]), labels


def test_pairs_that_no_sum_of_weights_expresses(tables):
    frame, labels = tables
    machine = factorization.fit_machine(frame, labels, "toxic", factorization.MachineSpec(epochs=60))
    rows = factorization.score_toxicity(frame, machine).collect()
    assert len(rows) == 904 and all(0 <= r.score <= 1 for r in rows)
    truth = {k: t for k, _, t in rows_of()}
    held = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    null, empty = (next(r.score for r in rows if r.doc_id == k) for k in (9000, 9001))
    assert null == empty < 0.5


def test_logits_equal_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    machine = factorization.Machine(np.arange(9, dtype=np.uint64), draw.normal(size=9), draw.normal(size=(9, 3)), 0.3)
    held = [[0, 4, 8], [], [2]]
    got = machine.logits(np.concatenate(held).astype(int), np.repeat(np.arange(3), [3, 0, 1]), 3)
    for terms, z in zip(held, got):
        want = 0.3 + sum(machine.weights[t] for t in terms)
        want += sum(machine.factors[a] @ machine.factors[b] for a in terms for b in terms if a < b)
        assert np.isclose(z, want)


def test_one_class_and_empty_tables(tables):
    frame, labels = tables
    machine = factorization.fit_machine(frame, labels.where("toxic = 0"), "toxic")
    scores = {r.score for r in factorization.score_toxicity(frame, machine).collect()}
    assert len(scores) == 1 and scores.pop() < 0.01
    machine = factorization.fit_machine(frame.limit(0), labels, "toxic")
    assert factorization.score_toxicity(frame.limit(0), machine).count() == 0


def test_a_class_of_over_4000_labels_is_learned_from_up_to_6000(spark, docs, monkeypatch):
    seen = {}

    def caught(terms, known, y, weight, spec):
        seen.update(zeros=int((y == 0).sum()), ones=int((y == 1).sum()))
        return factorization.Machine(terms, np.zeros(len(terms)), np.zeros((len(terms), spec.factors)), 0.0)

    monkeypatch.setattr(factorization, "train_machine", caught)
    labels = spark.range(9000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 9 = 0 AS int) AS toxic")
    frame = docs([(0, "plain words")]).select("doc_id", "text").union(
        spark.range(1, 9000).selectExpr("id", "concat('plain words ', id % 50)")
    )
    factorization.fit_machine(frame, labels, "toxic")
    assert seen["zeros"] == 6000 and 0 < seen["ones"] < 1000
