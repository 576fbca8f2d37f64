"""Exact ranks over whole tables without moving a table into one task.

A position in a total order is found by narrowing on a score state: the thousandth of the
score that holds it, then the millionth. Only where a position falls inside a group of equal
millionths are that group's rows ordered further, by a range sort whose partitions split ties
on the full key. The result is a handful of row keys, and every row is then compared with
those.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import flag, total
from holdfast.operators.scorestate import ScoreState, millionths
from holdfast.schema import KEYS, require_columns
from holdfast.sources.staging import stage

DECILES = 10


@dataclass(frozen=True)
class Cut:
    """The row at ``rank``: its score group and, if the group had to be split, its key."""

    rank: int
    group: int
    key: tuple | None

    def passed(self, lead: Column, tail: Sequence[Column]) -> Column:
        """Condition: a row comes after the cut."""
        if self.key is None:
            return millionths(lead) > F.lit(self.group)
        after = F.lit(False)
        for column, value in reversed(list(zip([lead, *tail], self.key))):
            after = (column > F.lit(value)) | ((column == F.lit(value)) & after)
        return after


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, … in ``order``, which must be a total order.

    A range sort keeps a position per partition in the staged copy; offsets of at most
    one row per partition turn it into a global number.
    """
    placed = stage(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "sorted"
    ).withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within + 1)
        .drop("_part", "_place", "_offset")
    )


def _holders(
    counts: list[tuple[int, int]], ranks: list[int]
) -> dict[int, tuple[int, int, int]]:
    """Per rank the key that holds it, the rows before that key and up to its end."""
    found, before, pending = {}, 0, sorted(set(ranks))
    for key, n in counts:
        while pending and pending[0] <= before + n:
            found[pending.pop(0)] = (key, before, before + n)
        before += n
    return found


def _wanted(state: ScoreState, ranks: Callable[[int], list[int]]) -> list[int]:
    rows = sum(n for _, n in state.coarse())
    return sorted(r for r in ranks(rows) if 1 <= r <= rows)


def locate(
    state: ScoreState, ranks: Callable[[int], list[int]]
) -> dict[int, tuple[int, int, int]]:
    """Per wanted rank, ascending, the millionth that holds it, the rows before that group
    and up to its end."""
    coarse = state.coarse()
    wanted = _wanted(state, ranks)
    if not wanted:
        return {}
    buckets = _holders(coarse, wanted)
    chosen = {key: before for key, before, _ in buckets.values()}
    fine = state.fine(chosen)
    holders = {}
    for key, before in chosen.items():
        inside = [(g, n) for g, n in fine if g // 1000 == key]
        ours = [r - before for r in wanted if buckets[r][0] == key]
        for rank, (g, low, high) in _holders(inside, ours).items():
            holders[rank + before] = (g, low + before, high + before)
    return dict(sorted(holders.items()))


def split_groups(holders: dict[int, tuple[int, int, int]]) -> set[int]:
    """The millionths inside which a rank falls, so that their rows must be ordered."""
    return {g for r, (g, _, high) in holders.items() if r != high}


def find_cuts(
    df: DataFrame,
    lead: Column,
    tail: Sequence[Column],
    ranks: Callable[[int], list[int]],
    state: ScoreState | None = None,
) -> list[Cut]:
    """Rows at the given ranks of ``df`` ordered ascending by ``lead``, then ``tail``.

    ``lead`` is a score between -1 and 1, ``tail`` makes the order total, and ``ranks``
    maps the row count to the wanted ranks. Rows without a score have no rank. ``state`` is
    that of ``df`` by ``lead``, made here where it is not given. At most 2,001 counts and
    1,000 per wanted rank reach the driver.
    """
    state = ScoreState(df, lead) if state is None else state
    holders = locate(state, ranks)
    cuts = {r: Cut(r, g, None) for r, (g, _, high) in holders.items() if r == high}
    tied = sorted({h for r, h in holders.items() if r not in cuts})
    if tied:
        shift, seen = {}, 0
        for g, low, high in tied:
            shift[g] = low - seen
            seen += high - low
        names = [f"k{i}" for i in range(len(tail) + 1)]
        ties = state.rows_of(shift).select(
            *[key.alias(name) for key, name in zip([lead, *tail], names)]
        )
        numbered = number_rows(ties, [F.col(c) for c in names], "at")
        places = {r - shift[holders[r][0]]: r for r in holders if r not in cuts}
        for hit in numbered.where(F.col("at").isin(list(places))).collect():
            rank = places[hit["at"]]
            cuts[rank] = Cut(rank, holders[rank][0], tuple(hit[name] for name in names))
    # A short table holds several ranks in one row.
    return [cuts[rank] for rank in _wanted(state, ranks)]


def decile_ranks(rows: int) -> list[int]:
    """Last rank of deciles 1-9: linearly interpolated, right-closed cut points."""
    return [(rows - 1) * j // DECILES + 1 for j in range(1, DECILES)]


def assign_deciles(
    df: DataFrame,
    score: str,
    name: str,
    keys: Sequence[str] = KEYS,
    fit_on: Column | None = None,
    state: ScoreState | None = None,
) -> DataFrame:
    """Add the risk decile, 10 the riskiest; equal scores are ordered by ``keys``.

    The cut rows are found first, so the table itself only gains an expression. ``fit_on``
    restricts the rows they come from; ``state`` is the score state of those rows, if there
    is one already. A null score has a null decile.
    """
    require_columns(df, [score, *keys], "scored table")
    lead, tail = F.col(score), [F.col(k) for k in keys]
    source = df if fit_on is None else df.where(fit_on)
    cuts = find_cuts(source, lead, tail, decile_ranks, state)
    decile = total([F.lit(1)] + [flag(c.passed(lead, tail)) for c in cuts])
    return df.withColumn(name, F.when(lead.isNotNull(), decile))


def top_rows(df: DataFrame, k: int, lead: Column, tail: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows by ``lead``, then ``tail``, ascending; never one without a score.

    The ``k``-th row is located and the table filtered against it, so pass a table.
    """
    cuts = find_cuts(df, lead, tail, lambda n: [min(n, k)])
    if not cuts:
        return df.where(F.lit(False))
    return df.where(lead.isNotNull() & ~cuts[0].passed(lead, tail))


def decile_profile(scored: DataFrame, score: str, decile: str, target: str) -> DataFrame:
    """Rows, target rate and score range per decile."""
    require_columns(scored, [score, decile, target], "scored table")
    return scored.groupBy(decile).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(target).alias("target_rate"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )
