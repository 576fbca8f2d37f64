from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import policy
from holdfast.schema import SPLIT, TARGET

NAMES = ["digital_inactivity_flag", "engagement_decline_flag", "high_service_friction_flag",
         "low_satisfaction_flag", "credit_stress_score", "relationship_health_score",
         "value_at_risk_index"]
CASES = [
    ((0, 0, 0, 0, 0, 46.0, 39.0), "high_model_risk", "portfolio_priority", "relationship_check_in"),
    ((1, 0, 0, 0, 0, 46.0, 39.0), "digital_inactivity", "portfolio_priority", "digital_reactivation_nudge"),
    ((0, 1, 0, 0, 0, 45.0, 39.0), "declining_engagement", "weak_relationship_health", "digital_reactivation_nudge"),
    ((0, 0, 1, 1, 85, 46.0, 39.0), "service_friction", "low_satisfaction", "service_recovery_case"),
    ((0, 0, 0, 1, 0, 46.0, 40.0), "low_satisfaction", "high_value_at_risk", "service_recovery_case"),
    ((1, 0, 0, 0, 55, 46.0, 39.0), "digital_inactivity", "credit_stress", "financial_wellbeing_check"),
    ((0, 0, 0, 0, 25, 46.0, 40.0), "high_value_at_risk", "portfolio_priority", "relationship_call"),
    ((1, 1, 1, 1, 85, 10.0, 90.0), "digital_inactivity", "declining_engagement", "service_recovery_case"),
    ((0, 0, 0, 0, 0, 30.0, 50.0), "weak_relationship_health", "high_value_at_risk", "relationship_call"),
]


@pytest.mark.parametrize("values, first, second, action", CASES)
def test_reasons_and_actions(spark, values, first, second, action):
    frame = spark.createDataFrame([values], NAMES)
    codes = policy.reason_codes()
    assert tuple(frame.select(*codes, policy.recommended_action()).first()) == (first, second, action)


def inputs(spark, n=120, seed=2):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "customer_id": np.repeat(np.arange(1, n + 1), 2),
        "snapshot_month": np.tile(["2024-05", "2024-06"], n),
        SPLIT: "test", TARGET: rng.integers(0, 2, 2 * n),
        policy.MODEL_V1_SCORE: np.round(rng.integers(0, 12, 2 * n) / 12, 6),
        policy.MODEL_V1_DECILE: rng.integers(1, 11, 2 * n),
        "relationship_value_index": 50.0, "value_at_risk_index": rng.integers(0, 90, 2 * n) / 1.0,
        "relationship_health_score": rng.integers(0, 90, 2 * n) / 1.0,
        "digital_inactivity_flag": rng.integers(0, 2, 2 * n),
        "engagement_decline_flag": rng.integers(0, 2, 2 * n),
        "high_service_friction_flag": rng.integers(0, 2, 2 * n),
        "low_satisfaction_flag": rng.integers(0, 2, 2 * n),
        "credit_stress_score": rng.choice([0, 5, 25, 55, 85], 2 * n),
    })
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_intervention_list_structure(spark):
    pdf, table = inputs(spark)
    result = policy.create_intervention_list(table, table, 40)
    got = result.intervention_list.toPandas().sort_values("policy_rank")
    latest = pdf[pdf.snapshot_month == "2024-06"]
    best = latest.sort_values(
        [policy.MODEL_V1_SCORE, "value_at_risk_index", "customer_id"], ascending=[False, False, True])
    assert tuple(got.columns) == policy.LIST_COLUMNS and len(policy.LIST_COLUMNS) == 23
    assert got.customer_id.tolist() == best.customer_id.head(40).tolist()
    assert got.policy_rank.tolist() == list(range(1, 41))
    assert set(got.snapshot_month) == {"2024-06"} == {result.snapshot_month}
    assert (got.assigned_group == "treatment").sum() == 32
    assert got[["reason_code_1", "reason_code_2"]].notna().all().all()
    assert set(got.intervention_capacity) == {40} and set(got.control_share) == {0.2}


def test_capacity_above_the_population_takes_everyone(spark):
    _, table = inputs(spark)
    listed = policy.create_intervention_list(table, table, "compact").intervention_list
    assert listed.count() == 120
    assert listed.where("assigned_group = 'treatment'").count() == 96


def test_profile_capacities():
    assert policy.profile_capacity("deep") == 1000 and policy.profile_capacity("compact") == 250
    with pytest.raises(ValueError, match="unknown profile"):
        policy.profile_capacity("huge")


@pytest.mark.parametrize("share", [0.0, 1.0, -0.1])
def test_share_must_be_inside_the_unit_interval(spark, share):
    _, table = inputs(spark)
    with pytest.raises(ValueError, match="treatment_share"):
        policy.assign_groups(table, 240, share)


def test_assignment_is_the_same_on_any_partitioning(spark):
    _, table = inputs(spark)
    latest = table.where("snapshot_month = '2024-06'")

    def groups(df, **kw):
        return {r[0]: r[1] for r in policy.assign_groups(df, 120, **kw)
                .select("customer_id", "assigned_group").collect()}

    base = groups(latest)
    assert base == groups(latest.repartition(1)) == groups(latest.repartition(7))
    assert sum(g == "treatment" for g in base.values()) == 96
    assert base != groups(latest, seed=7)


def test_features_are_joined_once_with_scores_kept(spark):
    _, table = inputs(spark)
    scores, traits = policy.policy_candidates(table, table.drop("value_at_risk_index"), "2024-06")
    joined = policy.join_candidates(scores, traits.where("customer_id <= 60"))
    assert joined.count() == 120 and len(set(joined.columns)) == len(joined.columns)
    assert joined.where(F.col("digital_inactivity_flag").isNull()).count() == 60


@pytest.mark.parametrize("capacity", [1, 40, 120, 500])
def test_lists_of_any_length_select_the_first_rows(spark, capacity):
    _, table = inputs(spark)
    latest = table.where("snapshot_month = '2024-06'")
    order = [F.desc(policy.MODEL_V1_SCORE), F.desc("value_at_risk_index"), F.asc("customer_id")]
    short = latest.orderBy(*order).limit(capacity).select("customer_id").collect()
    long = policy.select_top(latest, capacity).select("customer_id").collect()
    assert sorted(short) == sorted(long) and len(long) == min(capacity, 120)


def test_summary(spark):
    _, table = inputs(spark)
    listed = policy.create_intervention_list(table, table, 50).intervention_list
    row = policy.summarise_list(listed).first()
    assert (row["rows"], row["unique_customers"]) == (50, 50)
    assert (row["treatment_rows"], row["control_rows"]) == (40, 10)
    assert 1 <= row["recommended_actions"] <= 5


def test_missing_score_column_raises(spark):
    _, table = inputs(spark)
    with pytest.raises(ValueError, match=policy.MODEL_V1_SCORE):
        policy.create_intervention_list(table.drop(policy.MODEL_V1_SCORE), table, 10)
