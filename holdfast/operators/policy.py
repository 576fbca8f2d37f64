"""Capacity-limited intervention list: reasons, actions and a keyed experiment split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import flag, keyed_digest
from holdfast.operators.joins import checked_left_join
from holdfast.operators.ranking import number_rows, top_rows
from holdfast.schema import (
    CARRIED_INDEXES,
    CUSTOMER,
    KEYS,
    MONTH,
    SEED,
    SPLIT,
    TARGET,
    require_columns,
)

MODEL_V1_VERSION = "ml_model_v1"
MODEL_V1_SCORE = "model_v1_risk_score"
MODEL_V1_DECILE = "model_v1_risk_decile"

# List capacity by run profile, shares of the experiment groups.
CAPACITY_BY_PROFILE = {"compact": 250, "deep": 1000}
TREATMENT_SHARE = 0.80
CONTROL_SHARE = 0.20

# Limits used by reasons and actions.
STRESSED = 55
WEAK_HEALTH = 45
HIGH_VALUE_AT_RISK = 40

POLICY_FEATURES = (
    "digital_inactivity_flag",
    "engagement_decline_flag",
    "high_service_friction_flag",
    "low_satisfaction_flag",
    "credit_stress_score",
)
# Columns of the intervention list, in order.
LIST_COLUMNS = (
    "policy_rank", *KEYS, SPLIT, "model_version", TARGET, MODEL_V1_SCORE, MODEL_V1_DECILE,
    *CARRIED_INDEXES, *POLICY_FEATURES, "reason_code_1", "reason_code_2", "recommended_action",
    "assigned_group", "intervention_capacity", "treatment_share", "control_share",
)


@dataclass(frozen=True)
class PolicyResult:
    intervention_list: DataFrame
    snapshot_month: str
    intervention_capacity: int
    model_version: str
    treatment_share: float
    control_share: float


def profile_capacity(profile: str) -> int:
    if profile not in CAPACITY_BY_PROFILE:
        raise ValueError(f"unknown profile {profile!r}; known: {sorted(CAPACITY_BY_PROFILE)}")
    return CAPACITY_BY_PROFILE[profile]


def latest_snapshot(df: DataFrame) -> DataFrame:
    """One row: the latest snapshot month."""
    return df.agg(F.max(MONTH).alias(MONTH))


def policy_candidates(
    scored: DataFrame, features: DataFrame, snapshot: str
) -> tuple[DataFrame, DataFrame]:
    """Scores and policy features of one month; a literal month prunes partitions."""
    in_month = F.col(MONTH) == snapshot
    return (
        scored.where(in_month).select(
            *KEYS, SPLIT, TARGET, MODEL_V1_SCORE, MODEL_V1_DECILE, *CARRIED_INDEXES
        ),
        features.where(in_month).select(*KEYS, *POLICY_FEATURES),
    )


def join_candidates(scores: DataFrame, features: DataFrame) -> DataFrame:
    """Every scored row with its features. Raises where the features repeat a scored key."""
    return checked_left_join(scores, features, KEYS, "feature table")


def select_top(frame: DataFrame, capacity: int) -> DataFrame:
    """The riskiest ``capacity`` rows: score, then value at risk, then customer.

    ``frame`` is read several times: pass a table. Rows without a score are not listed.
    """
    order = [-F.col("value_at_risk_index"), F.col(CUSTOMER)]
    return top_rows(frame, capacity, -F.col(MODEL_V1_SCORE), order)


def add_policy_rank(selected: DataFrame) -> DataFrame:
    order = [F.desc(MODEL_V1_SCORE), F.desc("value_at_risk_index"), F.asc(CUSTOMER)]
    return number_rows(selected, order, "policy_rank")


def reason_codes() -> tuple[Column, Column]:
    """First two applicable reasons in priority order, padded where fewer apply."""
    c = F.col
    # Reasons in priority order.
    applicable = F.array_compact(
        F.array(
            F.when(c("digital_inactivity_flag") == 1, "digital_inactivity"),
            F.when(c("engagement_decline_flag") == 1, "declining_engagement"),
            F.when(c("high_service_friction_flag") == 1, "service_friction"),
            F.when(c("low_satisfaction_flag") == 1, "low_satisfaction"),
            F.when(c("credit_stress_score") >= STRESSED, "credit_stress"),
            F.when(c("relationship_health_score") <= WEAK_HEALTH, "weak_relationship_health"),
            F.when(c("value_at_risk_index") >= HIGH_VALUE_AT_RISK, "high_value_at_risk"),
        )
    )
    return (
        F.coalesce(F.get(applicable, F.lit(0)), F.lit("high_model_risk")),
        F.coalesce(F.get(applicable, F.lit(1)), F.lit("portfolio_priority")),
    )


def recommended_action() -> Column:
    c = F.col
    # Actions in priority order.
    return (
        F.when(
            (c("high_service_friction_flag") == 1) | (c("low_satisfaction_flag") == 1),
            "service_recovery_case",
        )
        .when(c("credit_stress_score") >= STRESSED, "financial_wellbeing_check")
        .when(
            (c("digital_inactivity_flag") == 1) | (c("engagement_decline_flag") == 1),
            "digital_reactivation_nudge",
        )
        .when(c("value_at_risk_index") >= HIGH_VALUE_AT_RISK, "relationship_call")
        .otherwise("relationship_check_in")
    )


def assign_groups(
    selected: DataFrame,
    rows: int,
    treatment_share: float = TREATMENT_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Put an exact share of the list in treatment, the rest in control.

    ``rows`` is the exact length of the list. The order is a digest of seed and
    customer, so the split is the same on any partitioning and after any retry.
    """
    if not 0 < treatment_share < 1:
        raise ValueError("treatment_share must lie strictly between 0 and 1")
    treated = round(rows * treatment_share)
    digest = keyed_digest(seed, F.col(CUSTOMER), "treat")
    drawn = number_rows(
        selected.withColumn("_digest", digest), [F.col("_digest"), F.col(CUSTOMER)], "_draw"
    )
    return drawn.withColumn(
        "assigned_group", F.when(F.col("_draw") <= treated, "treatment").otherwise("control")
    ).drop("_digest", "_draw")


def create_intervention_list(
    scored: DataFrame,
    features: DataFrame,
    capacity: int | str = "deep",
    model_version: str = MODEL_V1_VERSION,
    treatment_share: float = TREATMENT_SHARE,
    seed: int = SEED,
    snapshot: str | None = None,
) -> PolicyResult:
    """Ranked list for the latest month. ``capacity`` is a number or a profile name.

    The list is chosen and ranked from the scores alone; features join its rows only.
    ``snapshot`` is the month, looked up when not given.
    """
    require_columns(
        scored, [*KEYS, SPLIT, TARGET, MODEL_V1_SCORE, MODEL_V1_DECILE, *CARRIED_INDEXES],
        "scored table",
    )
    require_columns(features, [*KEYS, *POLICY_FEATURES], "feature table")
    if isinstance(capacity, str):
        capacity = profile_capacity(capacity)
    if snapshot is None:
        snapshot = latest_snapshot(scored).first()[MONTH]
    scores, traits = policy_candidates(scored, features, snapshot)
    ranked = add_policy_rank(select_top(scores, capacity))
    rows = ranked.count()
    grouped = join_candidates(assign_groups(ranked, rows, treatment_share, seed), traits)
    first, second = reason_codes()
    listed = grouped.withColumns(
        {
            "reason_code_1": first,
            "reason_code_2": second,
            "recommended_action": recommended_action(),
            "model_version": F.lit(model_version),
            "intervention_capacity": F.lit(capacity),
            "treatment_share": F.lit(treatment_share),
            "control_share": F.lit(round(1 - treatment_share, 10)),
        }
    ).select(*LIST_COLUMNS)
    return PolicyResult(
        listed, snapshot, capacity, model_version, treatment_share, round(1 - treatment_share, 10)
    )


def summarise_list(listed: DataFrame) -> DataFrame:
    """One row of list diagnostics."""
    require_columns(listed, LIST_COLUMNS, "intervention list")
    group = F.col("assigned_group")
    return listed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(CUSTOMER).alias("unique_customers"),
        F.avg(TARGET).alias("target_rate"),
        F.avg(MODEL_V1_SCORE).alias("average_risk_score"),
        F.coalesce(F.sum(flag(group == "treatment")), F.lit(0)).alias("treatment_rows"),
        F.coalesce(F.sum(flag(group == "control")), F.lit(0)).alias("control_rows"),
        F.count_distinct("recommended_action").alias("recommended_actions"),
    )
