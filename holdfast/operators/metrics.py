"""Ranking metrics of any scored table, all splits and all cut-offs from its score state.

The state has the rows and positives per split and score. Area under the curve, average
precision, Brier score and base rate follow from it, and so do the hits among the top K up to
the score that holds rank K. Only rows with exactly that score, where K falls inside a group
of ties, are numbered by a range sort. Any K takes the same path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from holdfast.functions.numeric import ratio
from holdfast.operators.ranking import assign_deciles, decile_ranks, locate, number_rows, split_groups
from holdfast.operators.scorestate import ScoreState, millionths
from holdfast.schema import KEYS, SPLIT, TARGET, require_columns

EVALUATED_SPLITS = ("validation", "test")
K_VALUES = (100, 500, 1000)
K_VALUES_LEDGER = (50, 100, 200)


def _curve(counts: DataFrame) -> DataFrame:
    """Per split and score its rows and positives, and both counted from the highest score."""
    falling = (
        Window.partitionBy("split").orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return counts.select("split", "millionth", F.col("low").alias("score"), "n", "hits").withColumns(
        {"seen": F.sum("n").over(falling), "found": F.sum("hits").over(falling)}
    )


def _split_summary(curve: DataFrame, k_values: Sequence[int]) -> DataFrame:
    """One row per split; ``at_k`` is the histogram row that holds rank K, or the last."""
    n, hits = F.col("n"), F.col("hits")
    positives, negatives = F.sum(hits), F.sum(n - hits)
    missed = n - hits
    holder = F.struct("score", "millionth", "n", "hits", "seen", "found")

    def at(k: int) -> Column:
        return F.coalesce(
            F.max_by(holder, F.when(F.col("seen") >= k, F.col("score"))), F.min_by(holder, "score")
        )

    return curve.groupBy("split").agg(
        F.sum(n).alias("rows"),
        (positives / F.sum(n)).alias("target_rate"),
        ratio(
            F.sum(missed * (F.col("found") - hits / 2.0)),
            positives.cast("double") * negatives,
        ).alias("roc_auc"),
        ratio(F.sum(hits * (F.col("found") / F.col("seen"))), positives).alias("pr_auc"),
        (
            F.sum(hits * (F.col("score") - 1.0) * (F.col("score") - 1.0)
                  + missed * F.col("score") * F.col("score"))
            / F.sum(n)
        ).alias("brier_score"),
        *[at(k).alias(f"at_{k}") for k in k_values],
    )


def _hits_inside_ties(state: ScoreState, rows: Callable, wanted: dict[tuple, set[int]]) -> dict:
    """Positives among the first m rows, by key, of each group (split, millionth, rows of it)."""
    if not wanted:
        return {}
    # Groups in the order of the sort below, with the rows that stand before each.
    ordered, before = sorted(wanted, key=lambda g: (g[0], -g[1])), {}
    for i, group in enumerate(ordered):
        before[group] = before[ordered[i - 1]] + ordered[i - 1][2] if i else 0
    chosen, keys = rows(state.rows_of(g for _, g, _ in ordered))
    tie = [(F.col("split") == split) & (F.col("millionth") == g) for split, g, _ in ordered]
    order = [F.asc("split"), F.desc("score"), *[F.asc(key) for key in keys]]
    numbered = number_rows(chosen.where(reduce(lambda a, b: a | b, tie)), order, "place")
    ends = [(g, m) for g in ordered for m in sorted(wanted[g])]
    counted = numbered.agg(
        *[
            F.sum(F.when(F.col("place").between(before[g] + 1, before[g] + m), F.col("target"))).alias(f"h{i}")
            for i, (g, m) in enumerate(ends)
        ]
    ).first()
    return {(g[0], g[1], m): counted[f"h{i}"] for i, (g, m) in enumerate(ends)}


def measured_state(
    scored: DataFrame, score: str, split_column: str = SPLIT, target: str = TARGET
) -> ScoreState:
    """The score state that metrics, deciles and histogram of ``scored`` share."""
    require_columns(scored, [split_column, target, score], "scored table")
    return ScoreState(scored, F.col(score), F.col(split_column), F.col(target))


def summarise_state(
    state: ScoreState, splits: Iterable[str], k_values: Sequence[int]
) -> tuple[list[Row], dict[tuple, set[int]]]:
    """One row per split, and the groups of ties inside which a rank K falls, with the
    numbers of their first rows that the top K take; their rows are reserved."""
    splits = list(splits)
    if mixed := state.off_grid(splits):
        raise ValueError(
            f"scores must be rounded to six decimals: {mixed} millionths hold different scores"
        )
    curve = _curve(state.counts.where(F.col("split").isin(splits)))
    summary = _split_summary(curve, k_values).collect()
    wanted: dict[tuple, set[int]] = {}
    for row in summary:
        for k in k_values:
            at = row[f"at_{k}"]
            if k < at["seen"]:
                group = (row["split"], at["millionth"], at["n"])
                wanted.setdefault(group, set()).add(k - at["seen"] + at["n"])
    state.reserve(g for _, g, _ in wanted)
    return summary, wanted


def evaluate_scores(
    scored: DataFrame,
    score: str,
    model_version: str,
    splits: Iterable[str] = EVALUATED_SPLITS,
    k_values: Iterable[int] = K_VALUES,
    split_column: str = SPLIT,
    target: str = TARGET,
    keys: Sequence[str] = KEYS,
    state: ScoreState | None = None,
) -> DataFrame:
    """One metric row per split that has rows.

    ``score`` must be rounded to six decimals: different scores in one millionth raise
    ``ValueError``. Equal scores are ordered by ``keys`` for the top-K columns; K is capped
    by the rows of the split. A split with one class has null for the measures that class
    leaves undefined. Rows without a score do not count. ``state`` is
    :func:`measured_state` of ``scored``, made here where it is not given.
    """
    k_values = list(dict.fromkeys(k_values))
    require_columns(scored, [split_column, target, score, *keys], "scored table")
    if state is None:
        state = measured_state(scored, score, split_column, target)
    summary, wanted = summarise_state(state, splits, k_values)

    def rows(table: DataFrame) -> tuple[DataFrame, list[str]]:
        named = table.select(
            F.col(split_column).alias("split"),
            millionths(F.col(score)).alias("millionth"),
            F.col(score).alias("score"),
            F.col(target).alias("target"),
            *[F.col(key).alias(f"_{key}") for key in keys],
        )
        return named, [f"_{key}" for key in keys]

    inside = _hits_inside_ties(state, rows, wanted)
    measures = ["rows", "target_rate", "roc_auc", "pr_auc", "brier_score"]
    measured = []
    for row in summary:
        values = [model_version, row["split"], *[row[m] for m in measures]]
        for k in k_values:
            at, hits = row[f"at_{k}"], row[f"at_{k}"]["found"]
            if k < at["seen"]:
                hits += inside[row["split"], at["millionth"], k - at["seen"] + at["n"]] - at["hits"]
            precision = hits / min(k, row["rows"])
            values += [precision, precision / row["target_rate"] if row["target_rate"] else None]
        measured.append(values)
    fields = ["model_version string", "split string", "rows long", *[f"{m} double" for m in measures[1:]]]
    fields += [f"{name}_at_{k} double" for k in k_values for name in ("precision", "lift")]
    return scored.sparkSession.createDataFrame(measured, ", ".join(fields))


def decile_and_measure(
    scores: DataFrame,
    score: str,
    decile: str,
    model_version: str,
    splits: Iterable[str] = EVALUATED_SPLITS,
    k_values: Iterable[int] = K_VALUES,
) -> tuple[DataFrame, DataFrame, ScoreState]:
    """``scores`` with deciles, its metric rows and its score state.

    ``scores`` is a table with the standard keys, split and target. It is read once for the
    state and once for all tied rows that deciles and top K need.
    """
    splits, k_values = list(splits), list(dict.fromkeys(k_values))
    state = measured_state(scores, score)
    state.reserve(split_groups(locate(state, decile_ranks)))
    summarise_state(state, splits, k_values)
    scored = assign_deciles(scores, score, decile, state=state)
    metrics = evaluate_scores(scores, score, model_version, splits, k_values, state=state)
    return scored, metrics, state
