from __future__ import annotations

import random

import pytest

from holdfast.llm import minhash
from holdfast.llm.components import connected


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = max(len(w) - size + 1, bool(w))
        sets[i] = {tuple(w[k : k + size]) for k in range(n)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed, groups=12, copies=14):
    draw = random.Random(seed)
    rows, i = [], 0
    for g in range(groups):
        base = [f"w{draw.randrange(4000)}" for _ in range(draw.randrange(1, 160))]
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randrange(0, 6)):
                own[draw.randrange(len(own))] = f"w{draw.randrange(4000)}"
            rows.append((i, " ".join(own)))
            i += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent, block", [(3, 85, 256), (5, 80, 4)])
def test_groups_equal_brute_force(docs, size, percent, block):
    rows = corpus(size) + [(9001, ""), (9002, None), (9003, "  \n"), (9004, "solo"), (9005, "SOLO")]
    spec = minhash.NearDupSpec(shingle=size, percent=percent, block=block)
    found = minhash.near_duplicates(docs(rows), spec).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    assert len(found) == len(rows)
    assert got == brute(rows, size, percent)


def test_repeated_rows_null_ids_and_empty_table(docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, "q r s t u")]
    found = minhash.near_duplicates(docs(rows)).collect()
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in found if r.component_id is not None)
    assert got == [(-1, 5, False), (5, 5, True), (5, 5, True), (7, 5, False)]
    assert [r.kept for r in found if r.component_id is None] == [True]
    assert minhash.near_duplicates(docs([])).collect() == []


def test_the_bound_drops_a_pair_at_the_threshold_with_small_probability():
    spec = minhash.NearDupSpec()
    bounds = minhash.least_matches(spec)
    assert bounds == sorted(bounds) and bounds[-1] < 0.8 * spec.bands * spec.rows
    assert minhash.least_matches(minhash.NearDupSpec(miss=0.01))[0] > bounds[0]


def test_components_of_paths_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(201, 200), (200, 202), (202, 201)]
    links += [(300, 300), (None, 4), (5, None)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in connected(frame).collect()}
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {k: 200 for k in (200, 201, 202)}
    assert got == want


def test_bands_are_shuffled_once(spark, monkeypatch):
    plans = []
    linked = minhash.linked_components

    def watched(members, *rest, **options):
        plans.append(members._jdf.queryExecution().executedPlan().toString())
        return linked(members, *rest, **options)

    monkeypatch.setattr(minhash, "linked_components", watched)
    docs = spark.createDataFrame([(k, "a b c d e f g") for k in range(3)], "doc_id long, text string")
    minhash.near_duplicates(docs).collect()
    assert len(plans) == 2 and not any("Exchange" in plan for plan in plans)
