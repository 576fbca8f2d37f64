from __future__ import annotations

import random

import numpy as np

from holdfast.llm import decontamination as d

SPEC = d.LeakSpec()


def text(draw, n):
    return " ".join("".join(draw.choice("abcdeé") for _ in range(draw.randrange(2, 8))) for _ in range(n))


def distance(item, window):
    """Least edits between ``item`` and any part of ``window``."""
    row = [0] * (len(window) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(window, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(draw, item, edits):
    own = list(item)
    for _ in range(edits):
        at = draw.randrange(len(own))
        kind = draw.randrange(3)
        if kind == 0:
            own[at] = "z"
        elif kind == 1:
            own.insert(at, "z")
        else:
            del own[at]
    return "".join(own)


def setup():
    draw = random.Random(3)
    items = [(k, text(draw, draw.randrange(6, 40))) for k in range(12)] + [(50, None), (51, ""), (52, "short"), (53, "  spaced item text here  ")]
    rows = []
    for k in range(60):
        own = text(draw, draw.randrange(0, 120))
        if k % 2:
            item = items[draw.randrange(12)][1]
            budget = len(item.encode()) * SPEC.percent // 100
            item = edited(draw, item, draw.randrange(0, 2 * budget + 1))
            item = item.upper().replace(" ", "\n") if k % 5 == 0 else item
            at = draw.randrange(len(own) + 1)
            own = own[:at] + item + own[at:]
        rows.append((k, own))
    return rows + [(100, None), (101, ""), (102, text(draw, 20_000) + items[0][1])], items


def test_leaks_equal_brute_force(spark, docs):
    rows, items = setup()
    benchmark = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    found = d.find_leaks(docs(rows), benchmark).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    index = d.index_items([i for i in items if i[1]], SPEC)
    plain = lambda t: bytes(d.plain(np.frombuffer(t.encode(), np.uint8)))
    for which, (item, budget) in enumerate(zip(index.texts, index.edits)):
        for doc, own in rows:
            if not own or len(own) > 10_000:
                continue
            least = distance(bytes(item), plain(own))
            hit = got.get((doc, index.ids[which]))
            assert (hit is not None) == (least <= budget), (doc, index.ids[which], least, budget)
            if hit:
                assert hit.edits == least
                part = plain(own)[hit.start : hit.end]
                assert distance(bytes(item), part) == least
    assert (102, 0) in got and not {r.item_id for r in found} & {50, 51, 52}


def test_blocks_repeated_rows_and_two_passages(spark, docs):
    draw = random.Random(5)
    items = [(k, text(draw, 20)) for k in range(6)] + [(9, None)]
    both = items[0][1] + " " + text(draw, 50) + " " + items[0][1]
    rows = [(1, both), (1, both), (None, items[1][1])]
    benchmark = spark.createDataFrame(items + [(7, items[1][1])], "item_id long, text string")
    small = d.find_leaks(docs(rows), benchmark, d.LeakSpec(block_bytes=1)).collect()
    found = d.find_leaks(docs(rows), benchmark).collect()
    assert sorted(map(str, small)) == sorted(map(str, found))
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 1), (0, 7)] + [(1, 0)] * 4


def test_empty_tables(spark, docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert d.find_leaks(docs([(1, "text")]), empty).collect() == []
    one = spark.createDataFrame([(1, "an item of some length")], "item_id long, text string")
    assert d.find_leaks(docs([]), one).collect() == []
