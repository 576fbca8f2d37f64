"""The distribution of a score, counted once and read by ranks, metrics and histograms.

A state counts rows and positives per split and millionth of the score, with the smallest and
largest score of each. It has two million rows a split at most, whatever the table's size;
counts combine before their shuffle, and states of parts of a table (months, say) add up to
the state of the whole. What the counts cannot tell, the order of rows inside one millionth,
is answered from one staged copy of the rows of the few millionths that are asked for.
So deciles, metrics and histogram of a table take two passes over it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import clip
from holdfast.sources.staging import stage

MILLION = 1_000_000


def millionths(score: Column) -> Column:
    """Score in whole millionths; values outside -1 to 1 join the outermost group."""
    return F.rint(clip(score, -1.0, 1.0) * 1e6).cast("long")


def count_scores(
    scored: DataFrame, lead: Column, split: Column | None = None, target: Column | None = None
) -> DataFrame:
    """(split, millionth, n, hits, low, high) of the rows with a score."""
    return (
        scored.where(lead.isNotNull())
        .groupBy(
            (F.lit(None).cast("string") if split is None else split).alias("split"),
            millionths(lead).alias("millionth"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.lit(0) if target is None else target), F.lit(0)).alias("hits"),
            F.min(lead.cast("double")).alias("low"),
            F.max(lead.cast("double")).alias("high"),
        )
    )


def merge_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """The counts of a table from those of its parts."""
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("split", "millionth")
        .agg(
            F.sum("n").alias("n"), F.sum("hits").alias("hits"),
            F.min("low").alias("low"), F.max("high").alias("high"),
        )
    )


class ScoreState:
    """Counts of ``scored`` by ``lead``, and the rows of single millionths.

    ``scored`` should be a table, as it is read twice: when the state is made, and when rows
    of tied millionths are first asked for. Reserve all that will be asked for before.
    """

    def __init__(
        self,
        scored: DataFrame,
        lead: Column,
        split: Column | None = None,
        target: Column | None = None,
        counts: DataFrame | None = None,
    ):
        self.scored, self.lead = scored, lead
        found = count_scores(scored, lead, split, target) if counts is None else counts
        self.counts = stage(found, "score-state")
        self._reserved: set[int] = set()
        self._held: set[int] = set()
        self._ties: DataFrame | None = None
        self._coarse: list[tuple[int, int]] | None = None

    def coarse(self) -> list[tuple[int, int]]:
        """(thousandth, rows) in order; 2,001 at most."""
        if self._coarse is None:
            bucket = F.floor(F.col("millionth") / F.lit(1000.0)).alias("k")
            found = self.counts.groupBy(bucket).agg(F.sum("n").alias("n")).collect()
            self._coarse = sorted((r["k"], r["n"]) for r in found)
        return self._coarse

    def fine(self, thousandths: Iterable[int]) -> list[tuple[int, int]]:
        """(millionth, rows) of the given thousandths, in order."""
        inside = F.floor(F.col("millionth") / F.lit(1000.0)).isin(list(thousandths))
        found = self.counts.where(inside).groupBy("millionth").agg(F.sum("n").alias("n")).collect()
        return sorted((r["millionth"], r["n"]) for r in found)

    def bounds(self) -> tuple[float | None, float | None]:
        """Smallest and largest score."""
        return tuple(self.counts.agg(F.min("low"), F.max("high")).first())

    def off_grid(self, splits: Iterable[str] | None = None) -> int:
        """Millionths that hold different scores."""
        counts = self.counts if splits is None else self.counts.where(F.col("split").isin(list(splits)))
        return counts.where("low < high").count()

    def reserve(self, groups: Iterable[int]) -> None:
        """Say that the rows of these millionths will be asked for."""
        self._reserved |= set(groups)

    def rows_of(self, groups: Iterable[int]) -> DataFrame:
        """The rows of the given millionths, from one copy of all that were reserved."""
        groups = sorted(set(groups))
        if self._ties is None or not self._held.issuperset(groups):
            self._held |= self._reserved | set(groups)
            own = self.scored.where(self.lead.isNotNull() & millionths(self.lead).isin(sorted(self._held)))
            self._ties = stage(own, "ties")
        return self._ties.where(millionths(self.lead).isin(groups))
