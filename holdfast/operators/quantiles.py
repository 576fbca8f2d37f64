"""Exact order statistics of many columns at once, by narrowing.

A column's rows are never ordered as a whole, nor turned into one row per column and value.
Each round draws cut values for all open columns from one bounded sample, then counts the rows
below and up to every cut, all columns side by side in a one-row aggregate. The counts are
exact, so they tell between which cuts a wanted rank lies, whatever the sample was; a luckless
sample costs a round and never a wrong value. An interval shrinks about forty-fold a round, and
what is left of at most ``GATHER`` rows is sorted. The driver holds a few cuts a column.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of one aggregate: it has twelve counts for each at most, and Spark compiles the whole
# stage of an aggregate of at most a hundred fields.
COLUMNS = 8
# Rows of an interval that are sorted as they are, and rows drawn from a larger one.
GATHER = 4_096
SAMPLE = 65_536
ACCURACY = 10_000


def one_row(
    df: DataFrame, measures: Mapping[str, Sequence[Column]]
) -> dict[str, list]:
    """Aggregates of a frame by the column they belong to, in one job.

    ``COLUMNS`` columns share one aggregate, which reads those columns alone.
    """
    names = list(measures)
    groups = [names[at : at + COLUMNS] for at in range(0, len(names), COLUMNS)]
    parts = [
        df.agg(F.array(*[F.array(*measures[name]) for name in group]).alias("found")).select(
            F.lit(at).alias("at"), "found"
        )
        for at, group in enumerate(groups)
    ]
    rows = reduce(DataFrame.unionAll, parts).collect() if parts else []
    return {n: values for row in rows for n, values in zip(groups[row["at"]], row["found"])}


class Cut(NamedTuple):
    """A value with the rows below it and the rows up to it; None is beyond all values."""

    value: float | None
    below: int
    upto: int


class Interval(NamedTuple):
    """The rows strictly between two cuts."""

    low: Cut
    high: Cut

    @property
    def rows(self) -> int:
        return self.high.below - self.low.upto

    def holds(self, value: Column) -> Column:
        inside = value.isNotNull()
        if self.low.value is not None:
            inside = inside & (value > self.low.value)
        return inside if self.high.value is None else inside & (value < self.high.value)


def _around(interval: Interval, rank: int) -> list[float]:
    """Shares of an interval's sample between which the wanted rank lies almost surely."""
    drawn = min(interval.rows, SAMPLE)
    share = (rank - interval.low.upto + 0.5) / interval.rows
    spread = 2.0 / ACCURACY
    if drawn < interval.rows:
        spread += 4.0 * math.sqrt(share * (1.0 - share) / drawn)
    return [max(share - spread, 0.0), min(share + spread, 1.0)]


def _cut_shares(interval: Interval, held: list[int]) -> list[float]:
    """Shares at which to cut an interval; neighbouring ranks lie between the same two."""
    shares = set()
    for rank in held:
        low, high = _around(interval, rank)
        if rank - 1 not in held:
            shares.add(low)
        if rank + 1 not in held:
            shares.add(high)
    return sorted(shares)


class _Search:
    """The cuts known of one column and the ranks still looked for."""

    def __init__(self, rows: int, ranks: Iterable[int]):
        self.cuts = [Cut(None, 0, 0), Cut(None, rows, rows)]
        self.found: dict[int, float] = {}
        self.open = sorted({r for r in ranks if 0 <= r < rows})

    def intervals(self) -> dict[Interval, list[int]]:
        """The open ranks by the interval that holds them."""
        held: dict[Interval, list[int]] = {}
        for rank in self.open:
            after = next(i for i, cut in enumerate(self.cuts) if rank < cut.below)
            held.setdefault(Interval(self.cuts[after - 1], self.cuts[after]), []).append(rank)
        return held

    def settle(self, found: Mapping[int, float]) -> None:
        self.found.update(found)
        self.open = [r for r in self.open if r not in self.found]

    def add(self, cuts: Iterable[Cut]) -> None:
        first, *inner, last = self.cuts
        self.cuts = [first, *sorted({*inner, *cuts}, key=lambda c: (c.below, c.upto)), last]
        self.settle({r: c.value for r in self.open for c in self.cuts if c.below <= r < c.upto})


def _probe(
    df: DataFrame,
    asked: list[tuple[str, Interval, list[int]]],
    shares: list[list[float] | None],
    seed: int,
) -> list[list[float]]:
    """Values of each interval at its shares, from a sample, or all of them in order.

    Rows that no interval of an aggregate's columns draws are filtered out below it, as
    aggregates of this kind are not compiled.
    """
    names = list(dict.fromkeys(name for name, _, _ in asked))
    parts = []
    for first in range(0, len(names), COLUMNS):
        group = names[first : first + COLUMNS]
        conditions, probes = [], []
        for at, (name, interval, _) in enumerate(asked):
            if name not in group:
                continue
            value = F.col(name)
            chosen = interval.holds(value)
            if shares[at] is None:
                probe = F.sort_array(F.collect_list(F.when(chosen, value)))
            else:
                chosen = chosen & (F.col("_draw") < SAMPLE / interval.rows)
                probe = F.percentile_approx(F.when(chosen, value), shares[at], ACCURACY)
            conditions.append(chosen)
            probes.append(F.struct(F.lit(at).alias("at"), probe.alias("values")))
        drawn = df.select(*group, F.rand(seed).alias("_draw"))
        wanted = drawn.where(reduce(Column.__or__, conditions))
        parts.append(wanted.agg(F.array(*probes).alias("probed")))
    rows = reduce(DataFrame.unionAll, parts).collect()
    found = {probe["at"]: probe["values"] or [] for row in rows for probe in row["probed"]}
    return [found[at] for at in range(len(asked))]


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Iterable[int]], rows: Mapping[str, int]
) -> dict[str, dict[int, float]]:
    """Values at the given ranks (0 is the smallest) of each column of doubles.

    ``rows`` are the values of each column that are not null. ``df`` is read two times a round,
    only its columns with open ranks, so it should be a table. NaN is the largest value, as in
    Spark's order. Ranks outside a column's rows are left out of the result.
    """
    searches = {name: _Search(rows[name], wanted) for name, wanted in ranks.items()}
    seed = 0
    while opened := {n: s.intervals() for n, s in searches.items() if s.open}:
        seed += 1
        asked = [(n, i, held) for n, found in opened.items() for i, held in found.items()]
        # The shares of a sample asked for, in the order of their results.
        shares = [
            None if i.rows <= GATHER else _cut_shares(i, held)
            for _, i, held in asked
        ]
        probed = _probe(df, asked, shares, seed)

        cuts: dict[str, list[float]] = {}
        for (name, interval, held), shared, values in zip(asked, shares, probed):
            if shared is None:
                searches[name].settle({r: values[r - interval.low.upto] for r in held})
            else:
                found = cuts.setdefault(name, [])
                found += [v for v in dict.fromkeys(values) if v not in found]
        counted = one_row(
            df,
            {
                name: [
                    count
                    for v in found
                    for count in (F.count_if(F.col(name) < v), F.count_if(F.col(name) <= v))
                ]
                for name, found in cuts.items()
            },
        )
        for name, counts in counted.items():
            searches[name].add(
                Cut(v, below, upto) for v, below, upto in zip(cuts[name], counts[::2], counts[1::2])
            )
    return {name: search.found for name, search in searches.items()}


def exact_quantiles(
    df: DataFrame, shares: Iterable[float], rows: Mapping[str, int]
) -> dict[str, list[float | None]]:
    """Quantiles of each column in ``rows``, interpolated between neighbouring values.

    None where a column has no value. ``df`` and ``rows`` are as in :func:`order_statistics`.
    """
    shares = list(shares)
    places = {name: [share * (n - 1) for share in shares] for name, n in rows.items() if n}
    values = order_statistics(
        df,
        {
            name: {edge(place) for place in at for edge in (math.floor, math.ceil)}
            for name, at in places.items()
        },
        rows,
    )

    def between(found: dict[int, float], place: float) -> float:
        low, high = found[math.floor(place)], found[math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {
        name: [between(values[name], place) for place in places[name]] if n else [None] * len(shares)
        for name, n in rows.items()
    }
