from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import features
from holdfast.schema import (
    CATEGORICAL_FEATURES, FEATURE_TABLE_COLUMNS, FEATURES, NUMERIC_FEATURES, PANEL_SCHEMA,
)

BASE = dict(
    customer_id=1, snapshot_month="2024-01", customer_month_index=1, tenure_months=10,
    age_band="30-44", region_type="urban", relationship_segment="core", active_products=2,
    has_savings_product=1, has_credit_product=1, has_digital_wallet=0, savings_balance_index=50.0,
    credit_balance_index=20.0, relationship_value_index=60.0, app_logins_30d=1, web_logins_30d=1,
    digital_transactions_30d=1, last_digital_activity_days=10, digital_engagement_score=30.0,
    digital_engagement_trend_3m=0.0, contact_attempts_90d=0, successful_contacts_90d=0,
    complaint_count_180d=0, average_resolution_days=0.0, process_friction_score=20.0,
    satisfaction_proxy_score=70.0, repayment_behaviour_score=80.0, days_past_due_band="current",
    recent_credit_application_flag=0, voluntary_attrition_next_90d=0,
)


def rows(spark, *changes):
    data = [tuple({**BASE, "customer_id": i, **c}[n] for n in PANEL_SCHEMA.fieldNames())
            for i, c in enumerate(changes)]
    return spark.createDataFrame(data, PANEL_SCHEMA)


def months(spark, n):
    return rows(spark, *[{"snapshot_month": f"{2000 + i // 12}-{i % 12 + 1:02d}"} for i in range(n)])


def test_column_lists():
    assert (len(NUMERIC_FEATURES), len(CATEGORICAL_FEATURES), len(FEATURES)) == (31, 4, 35)
    assert len(FEATURE_TABLE_COLUMNS) == 39


def test_flag_thresholds(spark):
    cases = [
        ("last_digital_activity_days", "digital_inactivity_flag", [44, 45, 46, None], [0, 1, 1, 0]),
        ("digital_engagement_trend_3m", "engagement_decline_flag", [-9.99, -10.0, -10.01, None], [0, 1, 1, 0]),
        ("process_friction_score", "high_service_friction_flag", [59.99, 60.0, 60.01, None], [0, 1, 1, 0]),
        ("satisfaction_proxy_score", "low_satisfaction_flag", [45.01, 45.0, 44.99, None], [0, 1, 1, 0]),
    ]
    for column, name, values, expected in cases:
        frame = features.derive_features(rows(spark, *[{column: v} for v in values]))
        assert [r[name] for r in frame.orderBy("customer_id").collect()] == expected


def test_credit_stress_points(spark):
    bands = ["no_credit_product", "current", "1-30", "31-60", "61+", "unheard of", None]
    frame = features.derive_features(rows(spark, *[{"days_past_due_band": b} for b in bands]))
    got = [r["credit_stress_score"] for r in frame.orderBy("customer_id").collect()]
    assert got == [0, 5, 25, 55, 85, 0, 0]


def test_scores_by_hand(spark):
    row = features.derive_features(rows(spark, {})).first()
    depth = np.round(12 * 2 + 0.25 * 10 + 0.2 * 60.0, 2)
    health = np.round(0.3 * depth + 0.25 * 30 + 0.25 * 70 + 0.2 * 80 - 0.3 * 20 - 0.15 * 5, 2)
    assert row["relationship_depth_score"] == depth == 38.5
    assert row["relationship_health_score"] == health
    assert row["value_at_risk_index"] == np.round(60.0 * (100 - health) / 100, 2)


def test_null_inputs_stay_null(spark):
    row = features.derive_features(rows(spark, {"relationship_value_index": None})).first()
    assert row["relationship_depth_score"] is None and row["value_at_risk_index"] is None


@pytest.mark.parametrize("n", [4, 10, 12, 20, 24])
def test_split_sizes(spark, n):
    split = features.add_temporal_split(months(spark, n))
    counts = {r["data_split"]: r["count"] for r in split.groupBy("data_split").count().collect()}
    train = max(1, math.floor(n * 0.7))
    until = min(max(train + 1, math.floor(n * 0.85)), n - 1)
    assert counts == {"train": train, "validation": until - train, "test": n - until}
    span = {r[0]: (r[1], r[2]) for r in split.groupBy("data_split").agg(
        F.min("snapshot_month"), F.max("snapshot_month")).collect()}
    assert span["train"][1] < span["validation"][0] <= span["validation"][1] < span["test"][0]


def test_three_months_raise(spark):
    with pytest.raises(ValueError, match="at least four"):
        features.add_temporal_split(months(spark, 3))


def test_given_months_need_no_job(spark):
    listed = [f"2000-{i:02d}" for i in range(1, 11)]
    a = features.add_temporal_split(months(spark, 10), listed)
    b = features.add_temporal_split(months(spark, 10))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_feature_table_layout_and_summary(spark):
    table = features.build_feature_table(months(spark, 10))
    assert table.columns == FEATURE_TABLE_COLUMNS
    row = features.summarise_features(table).first()
    assert (row["rows"], row["columns"], row["features"], row["missing_values"]) == (10, 39, 35, 0)
    assert (row["train_rows"], row["validation_rows"], row["test_rows"]) == (7, 1, 2)


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match=r"\['age_band'\]"):
        features.build_feature_table(months(spark, 10).drop("age_band"))


def test_target_rate_by_split(spark):
    frame = months(spark, 10).withColumn(
        "voluntary_attrition_next_90d", (F.col("customer_id") % 2).cast("int"))
    got = {r["data_split"]: (r["target_rate"], r["rows"])
           for r in features.target_rate_by_split(features.build_feature_table(frame)).collect()}
    assert got == {"train": (3 / 7, 7), "validation": (1.0, 1), "test": (0.5, 2)}


def test_numeric_profile_matches_describe(spark):
    frame = rows(spark, *[{"tenure_months": v, "savings_balance_index": v * 1.25} for v in (1, 2, 3, 5, 8, 13)])
    names = ["tenure_months", "savings_balance_index"]
    expected = frame.select(*names).toPandas().describe()
    for row in features.numeric_profile(frame, names).collect():
        column = expected[row["column_name"]]
        got = [row[k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(column.tolist())
