from __future__ import annotations

import re
from collections import Counter

import pytest

from holdfast.llm import sharding


@pytest.mark.parametrize("n, shards, size", [(500, 7, 400), (500, 24, 1 << 20), (5, 24, 10), (1, 1, 10), (0, 3, 10)])
def test_every_row_has_one_place(docs, n, shards, size):
    rows = [(k if k % 50 else None, "é" * (k % 90) if k % 9 else None) for k in range(n)]
    written = sharding.shard_documents(docs(rows), shards, bucket_bytes=size)
    found = written.collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    assert all(r.size == len((r.text or "").encode()) + 8 and r.lang == "en" for r in found)
    counts = Counter(r.shard for r in found)
    assert set(counts) <= set(range(shards))
    assert not n or max(counts.values()) - min([counts[k] for k in range(shards)]) <= 1
    assert sorted((r.shard, r.slot) for r in found) == [(s, k) for s in sorted(counts) for k in range(counts[s])]


def test_equal_rows_are_spread_and_the_order_is_mixed(docs):
    written = sharding.shard_documents(docs([(1, "same")] * 300 + [(k, "x") for k in range(2, 302)]), 6, bucket_bytes=200)
    by_shard = Counter(r.shard for r in written.collect() if r.doc_id == 1)
    assert len(by_shard) == 6 and max(by_shard.values()) < 80
    order = [r.doc_id for r in sorted(written.collect(), key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)


def test_seeds_give_other_orders(docs):
    frame = docs([(k, "t") for k in range(100)])
    orders = []
    for seed in (1, 1, 2):
        rows = sharding.shard_documents(frame, 2, seed).collect()
        orders.append([r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))])
    assert orders[0] == orders[1] != orders[2]


def test_no_shards_is_an_error(docs):
    with pytest.raises(ValueError):
        sharding.shard_documents(docs([]), 0)


def test_the_plan_has_no_python(spark, docs, tmp_path):
    written = sharding.write_shards(docs([(1, "a")]), 2, str(tmp_path / "s"))
    assert not re.search("Python|Pandas|Arrow", written._jdf.queryExecution().executedPlan().toString())
