from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from holdfast.operators import rules
from holdfast.schema import SPLIT, TARGET

COLUMNS = {
    "customer_id": 1, "snapshot_month": "2024-01", SPLIT: "train", TARGET: 0,
    "relationship_value_index": 50.0, "value_at_risk_index": 40.0,
    "relationship_health_score": 30.0, "digital_inactivity_flag": 1,
    "engagement_decline_flag": 0, "high_service_friction_flag": 1, "low_satisfaction_flag": 0,
    "credit_stress_score": 25, "process_friction_score": 60.0, "last_digital_activity_days": 90,
    "complaint_count_180d": 7, "relationship_depth_score": 20.0,
}


def table(spark, *changes):
    rows = [{**COLUMNS, "customer_id": i, **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r.values()) for r in rows], list(COLUMNS))


def test_raw_score_by_hand(spark):
    got = table(spark, {}).select(rules.raw_rules_score()).first()[0]
    assert got == pytest.approx(
        0.22 + 0.16 + 0.12 * 0.25 + 0.11 * 0.6 + 0.09 * 0.5 + 0.09 * 0.4 + 0.07 * 1.0
        - 0.12 * 0.3 - 0.08 * 0.2, abs=1e-12)


def test_equal_rows_score_half(spark):
    scored = rules.score_with_rules(table(spark, *[{}] * 12))
    assert {r[rules.RULES_SCORE] for r in scored.collect()} == {0.5}


def test_scores_span_zero_to_one_at_six_decimals(spark):
    scored = rules.score_with_rules(
        table(spark, *[{"last_digital_activity_days": d} for d in range(0, 200, 7)]))
    values = [r[rules.RULES_SCORE] for r in scored.collect()]
    assert min(values) == 0.0 and max(values) == 1.0
    assert all(v == round(v, 6) for v in values)


def test_scale_fitted_on_train_stays_in_range(spark):
    features = table(
        spark, {"last_digital_activity_days": 50}, {"last_digital_activity_days": 100},
        {"last_digital_activity_days": 180, SPLIT: "test"}, {"last_digital_activity_days": 0, SPLIT: "test"})
    scored = rules.score_with_rules(features, fit_on=F.col(SPLIT) == "train")
    got = [r[rules.RULES_SCORE] for r in scored.orderBy("customer_id").collect()]
    assert got == [0.0, 1.0, 1.0, 0.0]


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="complaint_count_180d"):
        rules.score_rules(table(spark, {}).drop("complaint_count_180d"))


def test_run_rules_bundles_scores_and_metrics(spark):
    changes = [{"last_digital_activity_days": i, SPLIT: ("train", "validation", "test")[i % 3],
                TARGET: i % 2} for i in range(60)]
    result = rules.run_rules(table(spark, *changes))
    assert result.scored_table.count() == 60
    assert {r["split"] for r in result.metrics.collect()} == {"validation", "test"}
    assert result.model_version == "rules_baseline_v1"
