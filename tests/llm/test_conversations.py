from __future__ import annotations

import hashlib
import itertools
import random
import re
from zlib import crc32

import pytest

from holdfast.llm import conversations
from holdfast.llm.conversations import BLANKS, Repair, repair_conversations, repaired_messages
from holdfast.llm.queries import QUERIES

FORM = re.compile(r"(s?(ua)+)?\Z")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        said = text.strip(BLANKS)
        kind = "blank" if not said else "duplicate" if (role, text) in seen else ""
        if not kind and said[-1] not in ".!?":
            kind = "truncated"
        seen.add((role, text))
        found.append(kind)
    return found


def brute(rows):
    """(cost, audit, repaired lines) by trying all edits, with up to one insertion in a gap."""
    kinds = faults(rows)
    own = []
    for (role, text), kind in zip(rows, kinds):
        ways = [("D", 3, None)]
        if kind not in ("blank", "duplicate"):
            more = kind == "truncated"
            ways += [("K", more, (role, text))] + [("R", 2 + more, (r, text)) for r in ("user", "assistant")]
        own.append(ways)
    gaps = [("", 0, None), *(("I", 2, (r, "")) for r in ("user", "assistant"))]
    best = None
    for picked in itertools.product(*itertools.chain.from_iterable((gaps, w) for w in own), gaps):
        lines = [m for _, _, m in picked if m]
        if not FORM.match("".join(role[:1] or "-" for role, _ in lines)):
            continue
        found = sum(c for _, c, _ in picked), "".join(x for x, _, _ in picked)
        if best is None or found < best[:2]:
            best = (*found, [f"{r}:{t}" for r, t in lines])
    return best


def repair(rows, check_rows=256):
    own = Repair(1, check_rows)
    for k, (role, text) in enumerate(rows):
        own.add(k, role, text)
    own.finish()
    return own


def sample(draw, n):
    roles = ("user", "assistant", "user", "assistant", "system", "tool", "")
    texts = ("Yes.", "No!", "cut", "", " \t", "Why? ", "more", "One.", "Two.", "Three.")
    return [(draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_repairs_equal_brute_force():
    for seed in range(250):
        draw = random.Random(seed)
        rows = sample(draw, draw.randrange(0, 5))
        own, (cost, audit, lines) = repair(rows), brute(rows)
        assert (own.cost, "".join(own.audit)) == (cost, audit), rows
        assert [f"{r}:{t}" for r, t, x in own.out if x != "D"] == lines
        assert own.sha.hexdigest() == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_decisions_taken_on_the_way_change_nothing():
    for seed in range(60):
        draw = random.Random(seed)
        rows = [(r, f"{t}{draw.randrange(3) or ''}") for r, t in sample(draw, 120)]
        whole = repair(rows, 10**9)
        for every in (1, 2, 7, 33):
            own = repair(rows, every)
            assert own.summary() == whole.summary() and own.out == whole.out
        assert "".join(x for _, _, x in whole.out) == "".join(whole.audit)


def test_long_conversations_are_decided_on_the_way():
    own, most = Repair(1), 0
    for k in range(20_000):
        own.add(k, ("user", "assistant", "user")[k % 3], f"Message {k}.")
        own.out.clear()
        most = max(most, len(own.rows))
    own.finish()
    assert most <= 512 and own.cost > 0 and own.audit
    same = Repair(2)
    for k in range(20_000):
        same.add(k, "user", "The same.")
    same.finish()
    assert same.cost == 2 + 3 * 19_999 and same.duplicate == 19_999


def test_a_short_repair_by_hand():
    own = repair([("assistant", "Hello."), ("user", "cut"), ("user", "cut"), ("system", "Late.")])
    # An empty user message before the first row, the cut one stays for 1, its repeat goes, the
    # system's becomes the assistant's answer: 2 + 0 + 1 + 3 + 2.
    assert (own.cost, "".join(own.audit)) == (8, "IKKDR")
    assert (own.blank, own.duplicate, own.truncated, own.illegal) == (0, 1, 1, 2)


def damaged(rows):
    """The contract's damage, row by row."""
    found = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = crc32(place.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        found += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return found


def statement(rows):
    """The query's rows from its definition."""
    left = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        said = [(r[2], r[3]) for r in own]
        kinds = faults(said)
        initials = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = brute(said)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = (kinds.count(k) for k in ("blank", "duplicate", "truncated"))
        yield conv, gaps, *counts, illegal, cost, audit, digest


COLUMNS = "conv_id long, turn long, role string, text string, cost string, audit long, place string"


@pytest.fixture
def folder(spark, tmp_path):
    draw, rows = random.Random(4), []
    for conv in range(70):
        for turn in range(draw.randrange(0, 4)):
            role, text = sample(draw, 1)[0]
            rows.append((conv, draw.choice((turn, turn, 2 * turn, None)), role, draw.choice((text, text, None))))
    rows += [(None, 0, "user", "Hm."), (None, None, None, None), (99, None, None, "é ü."), (99, 3, "user", "é ü.")]
    rows += [r for r in rows if r[0] == 5]
    gone = next(c for c in range(100, 999) if crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Hello."))
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path), rows


def test_the_query_equals_brute_force(spark, folder):
    path, rows = folder
    found = QUERIES["op11_conversation_repair"](spark, path).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, found), key=key) == sorted(statement(rows), key=key)
    assert any(r.audit == "" and r.cost == 0 for r in found)


def test_messages_give_the_repaired_text(spark, folder):
    path, _ = folder
    turns = conversations.damaged(spark.read.parquet(f"{path}/conversations.parquet"))
    lines = {}
    for m in repaired_messages(turns).where("edit <> 'D'").orderBy("conv_id", "place").collect():
        assert m.place == len(lines.setdefault(m.conv_id, []))
        lines[m.conv_id].append(f"{m.role}:{m.text}")
    for r in repair_conversations(turns).collect():
        text = "\n".join(lines.get(r.conv_id, []))
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert repair_conversations(none).count() == 0 and repaired_messages(none).count() == 0
