from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest

from holdfast.llm import runs
from holdfast.llm.queries import QUERIES


def brute(w, least=24, times=3):
    """All runs by trying every period and start."""
    n, found = len(w), {}
    for q in range(n // times, 0, -1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found[i, j + q] = q
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def sample(draw):
    letters = draw.choice((1, 2, 3, 50))
    w = [draw.randrange(letters) for _ in range(draw.randrange(0, 160))]
    for _ in range(draw.randrange(4)):
        block = [draw.randrange(letters) for _ in range(draw.randrange(1, 14))]
        at = draw.randrange(len(w) + 1)
        w[at:at] = (block * draw.randrange(2, 9))[: draw.randrange(1, 90)]
    return w


def test_runs_equal_brute_force():
    found = 0
    for seed in range(600):
        w = sample(random.Random(seed))
        want = brute(w)
        assert runs.find_runs(np.array(w, np.int64)) == want, seed
        found += len(want)
    assert found > 300
    for seed in range(200):
        w = sample(random.Random(seed))
        spec = runs.RunSpec(least=4, times=2)
        assert runs.find_runs(np.array(w, np.int64), spec) == brute(w, 4, 2), seed


def test_suffixes_equal_their_definition():
    for seed in range(100):
        w = sample(random.Random(seed))[:80] or [1]
        order, common = runs.suffix_order(np.array(w, np.int64))
        tails = sorted((w[i:], i) for i in range(len(w)))
        assert order.tolist() == [i for _, i in tails]
        for (a, _), (b, _), c in zip(tails, tails[1:], common.tolist()):
            assert a[:c] == b[:c] and (c == len(a) or c == len(b) or a[c] != b[c])


def test_only_windows_that_repeat_are_looked_at():
    for size in (1, 5, 16, 23):
        for seed in range(60):
            w = np.array(sample(random.Random(seed)), np.int64)
            grams = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
            assert runs.repeats_a_window(w, size) == (len(set(grams)) < len(grams))


def test_places_in_many_blocks(monkeypatch):
    monkeypatch.setattr(runs.Places, "LIMIT", 4)
    draw = random.Random(3)
    order = draw.sample(range(1000), 300)
    places, known = runs.Places(order[0]), [order[0]]
    for p in order[1:]:
        before, after = places.put(p)
        assert before == max((k for k in known if k < p), default=None)
        assert after == min((k for k in known if k > p), default=None)
        known.append(p)
    assert list(places) == sorted(known)


def test_a_long_text_of_one_word():
    assert runs.find_runs(np.zeros(60_000, np.int64)) == [(0, 60_000, 1)]


def statement(doc_id, text):
    """The query's row from its definition."""
    w = (text or "").encode().split()
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    own = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(found), *own, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.fixture
def folder(docs, tmp_path):
    draw = random.Random(7)
    rows = [(None, "a b " * 40), (1, None), (2, ""), (3, " \n\t "), (3, "x " * 30), (2**62, "é ü ü " * 20)]
    for k in range(10, 300):
        rows.append((k, draw.choice((" ", "\n", " \t")).join(f"w{x}" for x in sample(draw))))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_the_query_equals_brute_force(spark, folder):
    path, rows = folder
    found = QUERIES["op13_periodic_runs"](spark, path)
    assert found.columns[:2] == ["doc_id", "n_runs"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted((statement(*r) for r in rows), key=key)


def test_texts_are_collapsed_and_empty_tables_pass(docs):
    (row,) = runs.collapse_runs(docs([(1, "begin " + "a b c " * 9 + "end")])).collect()
    assert row.collapsed == "begin a b c end" and [tuple(r) for r in row.runs] == [(1, 27, 3)]
    assert runs.collapse_runs(docs([])).count() == 0
