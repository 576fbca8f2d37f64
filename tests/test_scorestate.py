from __future__ import annotations

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import metrics, ranking, reports
from holdfast.operators.scorestate import ScoreState, count_scores, merge_counts

COLUMNS = "customer_id long, snapshot_month string, data_split string, voluntary_attrition_next_90d int, s double"


def scores(spark, n=4000, levels=23, seed=1):
    draw = np.random.default_rng(seed)
    rows = [
        (i, f"2024-{1 + i % 5:02d}", ("train", "validation", "test")[i % 3], int(draw.random() < 0.3),
         None if i % 17 == 0 else float(np.round(draw.integers(0, levels) / levels, 6)))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple(map(str, r)))


def test_the_states_of_months_add_up_to_that_of_the_table(spark):
    table = scores(spark)
    own = F.col("s"), F.col("data_split"), F.col("voluntary_attrition_next_90d")
    parts = [count_scores(table.where(F.col("snapshot_month") == f"2024-{m:02d}"), *own) for m in range(1, 7)]
    assert rows_of(merge_counts(parts)) == rows_of(count_scores(table, *own))
    state = ScoreState(table, *own, counts=merge_counts(parts))
    assert sum(n for _, n in state.coarse()) == table.where("s IS NOT NULL").count()
    assert state.bounds() == tuple(table.agg(F.min("s"), F.max("s")).first())


def test_deciles_metrics_and_histogram_equal_those_made_alone(spark):
    table = scores(spark)
    scored, measured, state = metrics.decile_and_measure(table, "s", "d", "v", k_values=(7, 100, 5000))
    assert rows_of(scored) == rows_of(ranking.assign_deciles(table, "s", "d"))
    assert rows_of(measured) == rows_of(metrics.evaluate_scores(table, "s", "v", k_values=(7, 100, 5000)))
    assert rows_of(reports.score_histogram(table, "s", 7, state)) == rows_of(reports.score_histogram(table, "s", 7))


def test_a_table_is_read_twice_whatever_is_asked(spark, tmp_path):
    """Counts and ties are all that is needed: the table may go after its second pass."""
    path = f"{tmp_path}/scores"
    scores(spark).write.parquet(path)
    table = spark.read.parquet(path)
    wanted = rows_of(metrics.evaluate_scores(table, "s", "v"))
    cuts = ranking.find_cuts(table, F.col("s"), [F.col("customer_id")], ranking.decile_ranks)
    state = metrics.measured_state(table, "s")
    state.reserve(ranking.split_groups(ranking.locate(state, ranking.decile_ranks)))
    metrics.summarise_state(state, metrics.EVALUATED_SPLITS, metrics.K_VALUES)
    state.rows_of([])
    shutil.rmtree(path)
    spark.catalog.clearCache()
    assert rows_of(metrics.evaluate_scores(table, "s", "v", state=state)) == wanted
    found = ranking.find_cuts(table, F.col("s"), [F.col("customer_id")], ranking.decile_ranks, state)
    assert found == cuts and any(c.key for c in cuts)
    assert sum(r["rows"] for r in reports.score_histogram(table, "s", state=state).collect()) == 4000 - 236


def test_rows_that_were_not_reserved_are_still_found(spark):
    table = scores(spark)
    state = ScoreState(table, F.col("s"))
    groups = [g for g, _ in state.fine(k for k, _ in state.coarse())]
    state.reserve(groups[:2])
    assert state.rows_of(groups[:1]).count() == table.where(f"s = {groups[0] / 1e6}").count()
    assert state.rows_of(groups[5:7]).select("s").distinct().count() == 2


def test_unrounded_scores_raise_in_metrics_and_are_binned_exactly(spark):
    draw = np.random.default_rng(2)
    rows = [(i, "2024-01", "test", i % 2, 0.25 + float(draw.random()) * 1e-6) for i in range(400)]
    table = spark.createDataFrame(rows, COLUMNS)
    with pytest.raises(ValueError, match="rounded to six decimals: 2 millionths hold different"):
        metrics.evaluate_scores(table, "s", "v")
    bins = {r["bin"]: r["rows"] for r in reports.score_histogram(table, "s", 10).collect()}
    values = np.array([r[4] for r in rows])
    low, high = values.min(), values.max()
    want = np.bincount(np.minimum(((values - low) / (high - low) * 10).astype(int), 9), minlength=10)
    assert [bins[k] for k in range(10)] == want.tolist()
    # Other splits may hold anything.
    assert metrics.evaluate_scores(table, "s", "v", splits=["validation"]).count() == 0


def test_a_table_without_scores(spark):
    table = scores(spark, 10).withColumn("s", F.lit(None).cast("double"))
    scored, measured, state = metrics.decile_and_measure(table, "s", "d", "v")
    assert {r["d"] for r in scored.collect()} == {None} and measured.count() == 0
    assert state.bounds() == (None, None) and state.coarse() == []
    with pytest.raises(ValueError, match="no value for s"):
        reports.score_histogram(table, "s", state=state)
