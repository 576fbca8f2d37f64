from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import ranking


def frame(spark, scores, seed=0):
    order = np.random.default_rng(seed).permutation(len(scores))
    pdf = pd.DataFrame({"customer_id": order + 1, "snapshot_month": "2024-01", "s": scores})
    return pdf, spark.createDataFrame(pdf).repartition(5)


def expected_deciles(pdf):
    ordered = pdf.sort_values(["customer_id"])
    rank = ordered.s.rank(method="first").astype(int)
    n = len(pdf)
    label = np.maximum(1, ((rank - 1) * 10 + n - 2) // (n - 1)) if n > 1 else rank * 0 + 1
    return dict(zip(ordered.customer_id, label))


@pytest.mark.parametrize("n", [1, 2, 10, 25, 101, 1000])
def test_deciles_with_heavy_ties(spark, n):
    rng = np.random.default_rng(n)
    pdf, df = frame(spark, np.round(rng.integers(0, 7, n) / 7, 6), n)
    got = ranking.assign_deciles(df, "s", "d")
    assert {r["customer_id"]: r["d"] for r in got.collect()} == expected_deciles(pdf)


@pytest.mark.parametrize("n", [10, 100, 250, 1000])
def test_deciles_equal_qcut(spark, n):
    pdf, df = frame(spark, np.round(np.random.default_rng(n).random(n), 6), n)
    ordered = pdf.sort_values("customer_id")
    bins = pd.qcut(ordered.s.rank(method="first"), 10, labels=False) + 1
    got = {r["customer_id"]: r["d"] for r in ranking.assign_deciles(df, "s", "d").collect()}
    assert got == dict(zip(ordered.customer_id, bins))


def test_one_score_holds_a_third_of_the_rows(spark):
    rng = np.random.default_rng(9)
    scores = np.where(rng.random(3000) < 0.34, 0.5, np.round(rng.random(3000), 6))
    pdf, df = frame(spark, scores)
    got = ranking.assign_deciles(df, "s", "d")
    assert {r["customer_id"]: r["d"] for r in got.collect()} == expected_deciles(pdf)


def test_all_scores_equal(spark):
    pdf, df = frame(spark, np.full(40, 0.5))
    counts = ranking.assign_deciles(df, "s", "d").groupBy("d").count().collect()
    assert sorted(r["d"] for r in counts) == list(range(1, 11))
    assert sum(r["count"] for r in counts) == 40


def test_decile_cuts_from_some_rows(spark):
    pdf, df = frame(spark, np.round(np.arange(100) / 100, 6))
    low = ranking.assign_deciles(df, "s", "d", fit_on=F.col("s") < 0.5)
    rows = {r["s"]: r["d"] for r in low.collect()}
    assert rows[0.99] == 10 and rows[0.49] == 10 and rows[0.04] == 1


@pytest.mark.parametrize("k", [1, 37, 200, 500])
def test_top_rows(spark, k):
    rng = np.random.default_rng(k)
    pdf, df = frame(spark, np.round(rng.integers(0, 5, 200) / 5, 6))
    best = pdf.sort_values(["s", "customer_id"], ascending=[False, True]).head(k)
    got = ranking.top_rows(df, k, -F.col("s"), [F.col("customer_id")])
    assert sorted(r["customer_id"] for r in got.collect()) == sorted(best.customer_id)


def test_number_rows(spark):
    pdf, df = frame(spark, np.round(np.random.default_rng(3).integers(0, 9, 777) / 9, 6))
    order = [F.desc("s"), F.asc("customer_id")]
    got = ranking.number_rows(df, order, "at")
    expected = pdf.sort_values(["s", "customer_id"], ascending=[False, True]).customer_id.tolist()
    assert [r["customer_id"] for r in got.orderBy("at").collect()] == expected
    assert [r["at"] for r in got.select("at").orderBy("at").collect()] == list(range(1, 778))


def test_cut_at_the_end_of_a_tie_needs_no_second_pass(spark):
    _, df = frame(spark, np.array([0.1] * 5 + [0.2] * 5))
    cuts = ranking.find_cuts(df, F.col("s"), [F.col("customer_id")], lambda n: [5])
    assert [(c.rank, c.group, c.key) for c in cuts] == [(5, 100_000, None)]


def test_rank_beyond_the_table_gives_no_cut(spark):
    _, df = frame(spark, np.array([0.1, 0.2]))
    assert ranking.find_cuts(df, F.col("s"), [F.col("customer_id")], lambda n: [9]) == []


def test_scores_beyond_six_decimals_and_the_unit_interval(spark):
    rng = np.random.default_rng(11)
    scores = np.concatenate([0.3 + rng.random(200) * 1e-9, rng.normal(0, 3, 200)])
    pdf, df = frame(spark, scores)
    got = ranking.assign_deciles(df, "s", "d")
    assert {r["customer_id"]: r["d"] for r in got.collect()} == expected_deciles(pdf)


def test_decile_profile(spark):
    _, df = frame(spark, np.round(np.arange(20) / 20, 6))
    scored = ranking.assign_deciles(df, "s", "d").withColumn("t", (F.col("s") >= 0.5).cast("int"))
    rows = {r["d"]: r for r in ranking.decile_profile(scored, "s", "d", "t").collect()}
    assert (rows[1]["rows"], rows[1]["target_rate"]) == (2, 0.0)
    assert (rows[10]["min_score"], rows[10]["max_score"], rows[10]["target_rate"]) == (0.9, 0.95, 1.0)


def test_null_scores_have_no_decile_and_no_place(spark):
    pdf, df = frame(spark, np.round(np.random.default_rng(5).integers(0, 9, 90) / 9, 6))
    gaps = df.withColumn("s", F.when(F.col("customer_id") % 3 > 0, F.col("s")))
    got = {r["customer_id"]: r["d"] for r in ranking.assign_deciles(gaps, "s", "d").collect()}
    kept = pdf[pdf.customer_id % 3 > 0].reset_index(drop=True)
    assert got == expected_deciles(kept) | {k: None for k in range(3, 91, 3)}
    top = ranking.top_rows(gaps, 500, -F.col("s"), [F.col("customer_id")])
    assert sorted(r["customer_id"] for r in top.collect()) == sorted(kept.customer_id)
    none = df.withColumn("s", F.lit(None).cast("double"))
    assert ranking.top_rows(none, 5, -F.col("s"), [F.col("customer_id")]).count() == 0
    assert {r["d"] for r in ranking.assign_deciles(none, "s", "d").collect()} == {None}
