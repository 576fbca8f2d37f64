from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from holdfast.operators.metrics import evaluate_scores
from holdfast.schema import SPLIT, TARGET


def table(spark, pdf):
    return spark.createDataFrame(pdf).repartition(4)


def sample(n=900, levels=40, seed=1):
    rng = np.random.default_rng(seed)
    s = np.round(rng.integers(0, levels, n) / levels, 6)
    return pd.DataFrame({
        "customer_id": rng.permutation(n), "snapshot_month": "2024-01", "s": s,
        SPLIT: rng.choice(["train", "validation", "test"], n),
        TARGET: (rng.random(n) < 0.1 + 0.6 * s).astype(int),
    })


def brute(pdf, split, ks):
    q = pdf[pdf[SPLIT] == split].sort_values(["s", "customer_id"], ascending=[False, True])
    y, s = q[TARGET].to_numpy(), q.s.to_numpy()
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    ap = 0.0
    for t in np.unique(s):
        chosen = s >= t
        ap += y[chosen].mean() * y[s == t].sum() / y.sum()
    out = {"rows": len(q), "target_rate": y.mean(), "roc_auc": wins / len(pos) / len(neg),
           "pr_auc": ap, "brier_score": ((s - y) ** 2).mean()}
    for k in ks:
        out[f"precision_at_{k}"] = y[:k].mean()
        out[f"lift_at_{k}"] = y[:k].mean() / y.mean()
    return out


def test_against_definitions(spark):
    pdf, ks = sample(), (7, 50, 100_000)
    rows = evaluate_scores(table(spark, pdf), "s", "m", k_values=ks).collect()
    assert {r["split"] for r in rows} == {"validation", "test"}
    for row in rows:
        for name, value in brute(pdf, row["split"], ks).items():
            assert row[name] == pytest.approx(value, abs=1e-12), name
        assert row["model_version"] == "m"


def test_planted_signal_beats_chance(spark):
    for row in evaluate_scores(table(spark, sample(2000)), "s", "m", k_values=(100,)).collect():
        assert row["roc_auc"] > 0.5 and row["lift_at_100"] > 1


def test_absent_split_is_skipped_and_custom_splits_work(spark):
    pdf = sample().query(f"{SPLIT} != 'test'")
    assert [r["split"] for r in evaluate_scores(table(spark, pdf), "s", "m").collect()] == ["validation"]
    rows = evaluate_scores(table(spark, pdf), "s", "m", splits=("train",), k_values=(3,))
    assert rows.columns[-2:] == ["precision_at_3", "lift_at_3"]
    assert [r["split"] for r in rows.collect()] == ["train"]


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_leaves_undefined_measures_null(spark, label):
    pdf = sample(100)
    pdf[TARGET] = label
    for row in evaluate_scores(table(spark, pdf), "s", "m", k_values=(5,)).collect():
        assert row["roc_auc"] is None and row["precision_at_5"] == label
        assert (row["lift_at_5"] is None) == (label == 0)


def test_ties_across_k_are_ordered_by_key(spark):
    pdf = pd.DataFrame({
        "customer_id": [1, 2, 3, 4, 5], "snapshot_month": "2024-01", "s": [0.9, 0.5, 0.5, 0.5, 0.1],
        SPLIT: "test", TARGET: [1, 0, 1, 1, 0]})
    row = evaluate_scores(table(spark, pdf), "s", "m", k_values=(2, 3)).first()
    assert row["precision_at_2"] == 0.5 and row["precision_at_3"] == pytest.approx(2 / 3)


def test_one_score_holding_most_rows(spark):
    pdf = sample(1500)
    pdf.loc[pdf.index % 3 != 0, "s"] = 0.25
    ks = (10, 100)
    for row in evaluate_scores(table(spark, pdf), "s", "m", k_values=ks).collect():
        for name, value in brute(pdf, row["split"], ks).items():
            assert row[name] == pytest.approx(value, abs=1e-12), name


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="score_x"):
        evaluate_scores(table(spark, sample(10)), "score_x", "m")


def test_any_k_ranks_only_a_group_of_ties(spark):
    pdf = sample(6000)
    pdf.loc[pdf.index % 10 != 0, "s"] = 0.25
    ks = (5, 700, 1500, 5000)
    rows = evaluate_scores(table(spark, pdf), "s", "m", k_values=ks).collect()
    for row in rows:
        for name, value in brute(pdf, row["split"], ks).items():
            assert row[name] == pytest.approx(value, abs=1e-12), name


def test_rows_without_a_score_do_not_count(spark):
    pdf = sample(300)
    gaps = table(spark, pdf).selectExpr("*", "CASE WHEN customer_id % 4 > 0 THEN s END AS gap")
    rows = evaluate_scores(gaps, "gap", "m", k_values=(10,)).collect()
    for row in rows:
        for name, value in brute(pdf[pdf.customer_id % 4 > 0], row["split"], (10,)).items():
            assert row[name] == pytest.approx(value, abs=1e-12), name
