from __future__ import annotations

import random

import numpy as np
import pytest

from holdfast.llm import parity, words
from holdfast.llm.blocks import linked_components, links_of
from holdfast.llm.parity import ParitySpec, similar_components
from holdfast.llm.queries import QUERIES

SPEC = ParitySpec()


def shingles(text, size=5):
    w = (text or "").encode().split()
    w = [x.lower() for x in w]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1)))


def brute(rows, size=5, percent=80):
    """The query's rows from its definition, all pairs of different sets compared."""
    sets = [shingles(t, size) for _, t in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    label = {s: k for k, s in enumerate(distinct)}
    for x, a in enumerate(distinct):
        for b in distinct[x + 1 :]:
            if label[a] != label[b] and 100 * len(a & b) >= percent * len(a | b):
                old, new = label[b], label[a]
                label = {s: new if g == old else g for s, g in label.items()}
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[label[s]] = min(i, least.get(label[s], i))
    return [(i, len(s), least.get(label[s]) if s else i) for (i, _), s in zip(rows, sets)]


def say(draw, n, pool=4000):
    return " ".join(f"w{draw.randrange(pool)}" for _ in range(n))


def edited(draw, text, edits):
    w = text.split()
    for _ in range(edits):
        at = draw.randrange(len(w))
        w[at : at + draw.randrange(2)] = [f"e{draw.randrange(10**6)}"] * draw.randrange(2)
    return " ".join(w)


def corpus(draw):
    passage = say(draw, 60)
    rows = [(None, None), (1, None), (2, ""), (3, " \n "), (4, "One"), (5, "one"), (6, "one two"), (6, "One  two")]
    texts = []
    for _ in range(40):
        base = say(draw, draw.choice((3, 8, 11, 14, 20, 40, 90, 300)))
        texts += [base] + [edited(draw, base, draw.randrange(max(2, len(base) // 60))) for _ in range(draw.randrange(5))]
    # A common passage in otherwise different documents, and some that are little else.
    texts += [say(draw, 60) + " " + passage + " " + say(draw, 60) for _ in range(40)]
    texts += [passage + " " + say(draw, draw.randrange(14)) for _ in range(15)]
    # A family of near copies and a chain whose ends are not similar.
    base = say(draw, 200)
    texts += [edited(draw, base, 3) for _ in range(60)]
    link = base
    for _ in range(12):
        link = edited(draw, link, 4)
        texts.append(link)
    texts += texts[5:12] + [texts[0].upper()]
    rows += [(10 + 3 * k, t) for k, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, say(draw, 30)), (2**61, say(draw, 9000, 10**6))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("spec", [SPEC, ParitySpec(common=3, block=4, heavy=64), ParitySpec(spare=100, growth=300)])
def test_components_equal_brute_force(docs, spec):
    for seed in (1, 2):
        rows = corpus(random.Random(seed))
        found = similar_components(docs(rows), spec)
        assert found.columns == ["doc_id", "n_shingles", "component_id"]
        key = lambda r: tuple(map(str, r))
        want = brute(rows)
        assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
        assert len({r[2] for r in want}) < len(rows) - 90


def test_another_similarity(docs):
    rows = corpus(random.Random(3))
    found = similar_components(docs(rows), ParitySpec(shingle=3, percent=60, block=16))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute(rows, 3, 60), key=key)


def sets_of(draw, size, percent):
    """Two random sets exactly as similar as the bound allows, or a little more."""
    best = None
    for other in range(size, 100 * size // percent + 1):
        common = -(-percent * (size + other) // (100 + percent))
        if common <= size and (best is None or draw.random() < 0.3):
            best = other, common
    other, common = best
    pool = np.unique(np.array([draw.getrandbits(64) for _ in range(size + other - common)], np.uint64))
    return pool[:0:1] if len(pool) < 2 else (np.sort(pool[:size]), np.sort(np.concatenate([pool[:common], pool[size:]])))


@pytest.mark.parametrize("spec", [SPEC, ParitySpec(spare=100), ParitySpec(percent=60, growth=200)])
def test_similar_sets_share_a_needed_key_whatever_is_common(spec):
    """Also where any of the keys are called common, so that a set only uses them where the
    others are too few."""
    draw = random.Random(9)
    tried = 0
    for _ in range(1500):
        a, b = sets_of(draw, draw.randrange(2, 130), spec.percent)
        shared = len(np.intersect1d(a, b))
        if np.array_equal(a, b) or 100 * shared < spec.percent * (len(a) + len(b) - shared):
            continue
        tried += 1
        limit = np.uint64(int(draw.choice((0.0, 0.2, 0.7)) * 2**64))
        used = []
        for s in (a, b):
            own = set()
            for view, extra, keys in parity.join_keys(s, spec):
                common = words.mix(keys) < limit
                own |= {(view, k) for k in keys[~common].tolist()}
                if common.sum() > extra:
                    own |= {(view, k) for k in keys[common].tolist()}
            used.append(own)
        assert used[0] & used[1]
    assert tried > 500


def test_hamming_distance_is_a_lower_bound():
    draw = random.Random(5)
    for _ in range(200):
        a, b = sets_of(draw, draw.randrange(2, 400), 80)
        x, y = parity.bit_sketch(a), parity.bit_sketch(b)
        width = min(len(x), len(y))
        apart = np.bitwise_count(parity.folded(x, width) ^ parity.folded(y, width)).sum()
        assert apart <= len(np.setxor1d(a, b)) <= SPEC.most_difference(len(a), len(b))
    lone = np.array([7, 9], np.uint64)
    assert np.bitwise_count(parity.bit_sketch(lone)).sum() <= 2


def test_sets_of_sizes_too_far_apart_share_no_view():
    for size in range(1, 400):
        mine = {band for band, _, _ in parity.views(size, SPEC)}
        for other in range(size, min(100 * size // 80, 399) + 1):
            if SPEC.most_difference(size, other):
                assert mine & {band for band, _, _ in parity.views(other, SPEC)}
        assert len(mine) <= 2


def test_links_join_each_component_once():
    comp, home = np.array([1, 1, 2, 3, 4]), np.array([True, False, False, True, False])
    tried = []

    def similar(x, ys):
        tried.extend((x, y) for y in ys.tolist())
        return np.ones(len(ys), bool)

    assert list(links_of(comp, home, similar)) == [(0, 2), (0, 3), (0, 4)]
    assert tried == [(0, 2), (0, 3), (0, 4)]
    tried.clear()
    assert list(links_of(comp, home, lambda x, ys: similar(x, ys) & False)) == []
    assert (1, 2) not in tried and (2, 4) not in tried and (1, 3) in tried


def test_blocks_find_all_links_of_large_groups(spark):
    """Numbers in groups of up to 300, linked where they differ by one; blocks of 8."""
    draw = random.Random(2)
    rows = []
    for group, size in enumerate((300, 7, 40, 1)):
        rows += [(group, i, size) for i in draw.sample(range(group * 1000, group * 1000 + 2 * size), size)]
    members = spark.createDataFrame(rows, "group long, id long, size long")
    payload = members.select("id", "id").toDF("id", "value")

    def judge(table):
        values = table.column("value").to_numpy()
        return lambda x, ys: abs(values[ys] - values[x]) == 1

    found = {r.node: r.component for r in linked_components(members, payload, judge, 8).collect()}
    ids = sorted(i for _, i, _ in rows)
    want, start = {}, None
    for before, i in zip([None, *ids], ids):
        start = start if before == i - 1 else i
        want[i] = start
    assert found == {i: c for i, c in want.items() if c != i or i + 1 in want}


def test_the_query_on_a_table(spark, docs, tmp_path):
    rows = corpus(random.Random(8))
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: tuple(map(str, r))
    found = QUERIES["op12_parity_join"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_empty_tables(docs):
    assert similar_components(docs([])).count() == 0
    assert similar_components(docs([(1, None)])).collect()[0] == (1, 0, 1)
