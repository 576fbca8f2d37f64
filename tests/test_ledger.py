from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from compare import plan_of
from pyspark.sql import functions as F

from holdfast.operators import ledger
from holdfast.operators.policy import MODEL_V1_SCORE
from holdfast.schema import TARGET

BASE = {
    "policy_rank": 1, "customer_id": 1, "snapshot_month": "2024-06", TARGET: 1, MODEL_V1_SCORE: 0.5,
    "relationship_value_index": 60.0, "value_at_risk_index": 40.0, "relationship_health_score": 30.0,
    "recommended_action": "service_recovery_case", "assigned_group": "treatment",
    "reason_code_1": "service_friction", "reason_code_2": "credit_stress",
}


def listed(spark, *changes):
    rows = [{**BASE, "policy_rank": i, "customer_id": i, **c} for i, c in enumerate(changes, 1)]
    return spark.createDataFrame([tuple(r.values()) for r in rows], list(BASE))


def outcomes(spark, *rows):
    names = "customer_id BIGINT, contact_success INT, treatment_completed INT, retained INT"
    return spark.createDataFrame(list(rows), names).withColumn("snapshot_month", F.lit("2024-06"))


def test_gating_and_economics_of_each_kind_of_row(spark):
    people = listed(
        spark, {"assigned_group": "control"}, {}, {}, {TARGET: 0}, {}, {}, {})
    seen = outcomes(spark, (1, 1, 1, 1), (3, 1, 0, 1), (4, 1, 1, 1), (5, 1, 1, 0), (6, 1, 1, 1), (7, 0, 1, 1))
    table = ledger.build_ledger(people, seen)
    assert tuple(table.columns) == ledger.LEDGER_COLUMNS and len(table.columns) == 22
    rows = {r["customer_id"]: r for r in table.collect()}
    flags = ("contact_attempted", "contact_success", "treatment_completed",
             "prevented_attrition_flag", ledger.POST_TARGET)
    expected = {
        1: (0, 0, 0, 0, 1),  # control: nothing counts
        2: (1, 0, 0, 0, 1),  # no observation
        3: (1, 1, 0, 0, 1),  # contacted, not completed
        4: (1, 1, 1, 0, 0),  # completed, would have stayed
        5: (1, 1, 1, 0, 1),  # completed, left anyway
        6: (1, 1, 1, 1, 0),  # completed and kept
        7: (1, 0, 0, 0, 1),  # completion without contact does not count
    }
    assert {k: tuple(r[f] for f in flags) for k, r in rows.items()} == expected
    money = {k: (r["intervention_cost_index"], r["retained_value_index"], r["net_value_index"])
             for k, r in rows.items()}
    assert money[1] == (0.0, 0.0, 0.0) and money[2] == (5.0, 0.0, -5.0)
    assert money[4] == (6.75, 0.0, -6.75) and money[6] == (6.75, 60.0, 53.25)


def test_action_parameters_and_default(spark):
    names = [a[0] for a in ledger.ACTIONS] + ["something else"]
    frame = ledger.with_action_parameters(listed(spark, *[{"recommended_action": n} for n in names]))
    got = {r["recommended_action"]: tuple(r[c] for c in ledger.ACTION_COLUMNS[1:]) for r in frame.collect()}
    assert got.pop("something else") == ledger.ACTION_DEFAULTS
    assert got == {a[0]: a[1:] for a in ledger.ACTIONS}


def test_ids_widen_past_six_digits(spark):
    frame = ledger.with_ledger_id(listed(spark, {"policy_rank": 7}, {"policy_rank": 1234567}))
    assert [r["treatment_log_id"] for r in frame.orderBy("customer_id").collect()] == [
        "TLOG-000007", "TLOG-1234567"]


def probabilities(spark, change, contacted=0.0):
    frame = ledger.with_action_parameters(listed(spark, change))
    return tuple(frame.select(
        ledger.contact_probability(), ledger.completion_probability(F.lit(contacted)),
        ledger.effect_probability()).first())


def test_probabilities_by_hand(spark):
    assert probabilities(spark, {}) == pytest.approx(
        (0.58 + 0.05 - 0.02, 0.52 - 0.02, 0.28 + 0.05 + 0.03))
    assert probabilities(spark, {}, 1.0)[1] == pytest.approx(0.52 + 0.08 - 0.02)
    assert probabilities(spark, {"reason_code_1": "credit_stress"})[2] == pytest.approx(0.31)
    assert probabilities(spark, {"relationship_value_index": 100.0, "recommended_action": "x"})[2] \
        == pytest.approx(0.28)


def test_expected_value_is_the_mean_of_simulated_outcomes(spark):
    row = ledger.expected_value(listed(spark, {})).first()
    rng = np.random.default_rng(0)
    n = 400_000
    contact = rng.random(n) < row["contact_probability"]
    done = contact & (rng.random(n) < row["completion_probability"])
    kept = done & (rng.random(n) < row["effect_probability"])
    cost = np.where(done, 5.0 * 1.35, 5.0).mean()
    assert row["expected_cost"] == pytest.approx(cost, rel=0.005)
    assert row["expected_retained_value"] == pytest.approx(60.0 * kept.mean(), rel=0.02)
    assert row["expected_net_value"] == pytest.approx(
        row["expected_retained_value"] - row["expected_cost"])


def test_nothing_is_expected_of_control_rows(spark):
    row = ledger.expected_value(listed(spark, {"assigned_group": "control"})).first()
    assert (row["expected_cost"], row["expected_retained_value"]) == (0.0, 0.0)


def test_summary(spark):
    people = listed(spark, {"assigned_group": "control"}, {}, {}, {})
    row = ledger.summarise_ledger(
        ledger.build_ledger(people, outcomes(spark, (2, 1, 1, 1), (3, 1, 0, 0)))).first()
    assert (row["rows"], row["treatment_rows"], row["control_rows"]) == (4, 3, 1)
    assert row["contact_success_rate"] == pytest.approx(2 / 3)
    assert row["treatment_completion_rate"] == pytest.approx(1 / 3)
    assert (row["pre_intervention_target_rate"], row["post_intervention_target_rate"]) == (1.0, 0.75)
    assert row["prevented_attrition_count"] == 1
    assert row["total_net_value_index"] == pytest.approx(60 - 6.75 - 5 - 5)


def test_summary_without_treatment_rows(spark):
    people = listed(spark, {"assigned_group": "control"})
    row = ledger.summarise_ledger(ledger.build_ledger(people, outcomes(spark, (9, 1, 1, 1)))).first()
    assert (row["contact_success_rate"], row["treatment_completion_rate"]) == (0.0, 0.0)
    empty = ledger.summarise_ledger(
        ledger.build_ledger(people.where("1 = 0"), outcomes(spark, (9, 1, 1, 1)))).first()
    assert (empty["rows"], empty["treatment_rows"], empty["total_net_value_index"]) == (0, 0, 0.0)


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="reason_code_1"):
        ledger.build_ledger(listed(spark, {}).drop("reason_code_1"), outcomes(spark, (1, 1, 1, 1)))


def happened(spark, *rows):
    frame = spark.createDataFrame([(t, u, k) for t, u, k in rows], "ts string, user_id long, event_type string")
    return frame.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def outcomes_by_row(events, rows, **options):
    found = ledger.observed_outcomes(events, rows, **options).collect()
    assert len({(r["customer_id"], r["snapshot_month"]) for r in found}) == len(found)
    return {(r["customer_id"], r["snapshot_month"]): tuple(r[c] for c in ledger.OUTCOME_COLUMNS) for r in found}


LISTED = "customer_id long, snapshot_month string, user_id long"


def test_windows_open_when_the_row_s_month_ends(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01", 7), (1, "2024-03", 7), (2, "2024-03", 7), (3, "2023-12", 8), (4, None, 7), (5, "2024-01", None)],
        LISTED)
    events = happened(
        spark, ("2024-01-31 23:59:59.999999", 7, "click"), ("2024-02-01 00:00:00", 7, "signup"),
        ("2024-04-01 00:00:00", 7, "purchase"), ("2024-04-30 23:59:59", 7, "click"),
        ("2024-05-01 00:00:00", 7, "click"), ("2024-06-30 00:00:00", 7, "signup"),
        ("2024-02-10 00:00:00", 8, "view"), ("2024-02-10 00:00:00", 9, "click"), (None, 7, "click"))
    assert outcomes_by_row(events, rows) == {
        # 90 days from 1 February on: up to 30 April.
        (1, "2024-01"): (1, 1, 1),
        # From 1 April on, up to 29 June: the signup of 1 February was before the intervention.
        (1, "2024-03"): (1, 1, 0), (2, "2024-03"): (1, 1, 0),
    }
    assert outcomes_by_row(events, rows, days=60) == {
        (1, "2024-01"): (0, 0, 1), (1, "2024-03"): (1, 1, 0), (2, "2024-03"): (1, 1, 0)}
    assert outcomes_by_row(events, rows, days=1) == {
        (1, "2024-01"): (0, 0, 1), (1, "2024-03"): (0, 1, 0), (2, "2024-03"): (0, 1, 0)}


def test_a_given_start_opens_all_windows(spark):
    rows = spark.createDataFrame([(1, "2024-01", 7), (2, "2024-03", 8)], LISTED)
    events = happened(
        spark, ("2024-05-02 11:59:59", 7, "click"), ("2024-05-02 12:00:00", 7, "purchase"),
        ("2024-05-04 11:59:59", 8, "signup"), ("2024-05-04 12:00:00", 8, "click"))
    start = datetime(2024, 5, 2, 12)
    assert outcomes_by_row(events, rows, start=start, days=2) == {(1, "2024-01"): (0, 1, 0), (2, "2024-03"): (0, 0, 1)}


def test_windows_equal_a_plain_range_join(spark):
    draw = random.Random(3)
    rows = [(c, f"2023-{draw.randrange(1, 13):02d}", draw.randrange(12)) for c in range(60)]
    # User 0 has a third of all events.
    events = [
        (datetime(2023, 1, 1) + timedelta(seconds=draw.randrange(500 * 86400)), draw.choice((0, *range(12))) if k % 3 else 0,
         draw.choice(("click", "purchase", "signup", "view")))
        for k in range(900)
    ]
    for days in (7, 30, 90):
        want = {}
        for c, month, user in rows:
            year, number = map(int, month.split("-"))
            opens = datetime(year + number // 12, number % 12 + 1, 1)
            seen = {k for t, u, k in events if u == user and opens <= t < opens + timedelta(days=days)} - {"view"}
            if seen:
                want[c, month] = tuple(int(k in seen) for k in ledger.OUTCOME_EVENTS)
        frame = happened(spark, *[(str(t), u, k) for t, u, k in events])
        assert outcomes_by_row(frame, spark.createDataFrame(rows, LISTED), days=days) == want


def test_a_hot_user_s_events_are_combined_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, "2024-01", 7)], LISTED)
    plan = plan_of(ledger.observed_outcomes(happened(spark, ("2024-02-01", 7, "click")), rows))
    daily = plan[: plan.index("_day")]
    assert "partial_max" in plan and "Exchange" in daily
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_empty_inputs_have_no_outcomes(spark):
    rows = spark.createDataFrame([], LISTED)
    assert outcomes_by_row(happened(spark), rows) == {} == outcomes_by_row(happened(spark, ("2024-02-01", 7, "click")), rows)
    with pytest.raises(ValueError, match="one day"):
        ledger.observed_outcomes(happened(spark), rows, days=0)
