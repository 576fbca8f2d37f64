from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from holdfast.llm import quality, words

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    own = WORD.findall(text or "")
    grams = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    covered = {i + k for i in range(len(own) - 7) for k in range(8) if grams[tuple(own[i : i + 8])] > 1}
    lines = Counter(line for line in (text or "").split("\n") if WORD.search(line))
    return [
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""),
        sum(n - 1 for n in lines.values()), len(covered),
    ]


def texts():
    draw = random.Random(6)
    found = ["", None, "\n", "\n\n a\n a\na\n", "x", "a b c d e f g h i a b c d e f g h", "é ü|<>\n", "a\n" * 50]
    for _ in range(150):
        found.append("".join(draw.choice("ab \n#é\t|") for _ in range(draw.randrange(200))))
    return found + ["w " * 100_000]


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_counts_equal_brute_force(monkeypatch, size):
    monkeypatch.setattr(words, "PIECE_BYTES", size)
    got = []
    for _, data, offsets in words.text_pieces(pa.array(texts(), pa.string())):
        got += quality.counts_of(data, offsets).tolist()
    assert got == [brute(t) for t in texts()]


def test_cascade_verdicts_do_not_depend_on_order(docs):
    rows = list(enumerate(texts())) + [(None, "n " * 30), (3, "again")]
    frame = docs(rows)
    found = quality.cascade(frame)
    backwards = quality.cascade(frame, list(reversed(quality.RULES)), sample_rows=1)
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_words)
    got, other = sorted(found.collect(), key=key), sorted(backwards.collect(), key=key)
    assert [r.kept for r in got] == [r.kept for r in other] and len(got) == len(rows)
    for r in got:
        assert r.kept == (not r.base_failed and r.rejected_by is None)
        assert not (r.base_failed and r.rejected_by)


def test_rules_run_in_order_of_rejection_per_cost(docs):
    def slow(d):
        sum(range(3000))
        return True

    rules = [quality.QualityRule("slow", slow), quality.QualityRule("never", lambda d: False), quality.QualityRule("fast", lambda d: True)]
    ordered = quality.order_rules(docs([(k, f"text {k}") for k in range(50)]), rules)
    assert [e.name for e in ordered] == ["fast", "slow", "never"]
    assert [e.rejected for e in ordered] == [1.0, 1.0, 0.0]


def test_a_rejected_document_reaches_no_later_rule(docs):
    def fails(d):
        raise AssertionError("reached")

    rules = [quality.QualityRule("first", lambda d: True), quality.QualityRule("later", fails)]
    judge = quality._judge(rules, lambda d: False)
    batch = pa.record_batch({"doc_id": pa.array([1]), "text": pa.array(["a b"])})
    assert next(judge(iter([batch]))).column("rejected_by").to_pylist() == ["first"]


def test_empty_table(docs):
    assert quality.cascade(docs([])).collect() == []
