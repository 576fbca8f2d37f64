"""Intervention ledger: what was done for each selected customer, and what it was worth."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.numeric import clip, flag, ratio, round_even
from holdfast.operators.policy import MODEL_V1_SCORE
from holdfast.schema import CARRIED_INDEXES, KEYS, MONTH, TARGET, require_columns

POST_TARGET = "post_intervention_attrition_next_90d"

# Contact, completion and effect probability, cost and channel by action.
ACTION_COLUMNS = (
    "recommended_action", "base_contact", "base_completion", "base_effect", "base_cost",
    "contact_channel",
)
ACTIONS = (
    ("digital_reactivation_nudge", 0.72, 0.64, 0.22, 1.5, "in_app_message"),
    ("relationship_check_in", 0.62, 0.56, 0.18, 3.0, "email_or_phone"),
    ("service_recovery_case", 0.58, 0.52, 0.28, 5.0, "specialist_call"),
    ("financial_wellbeing_check", 0.55, 0.48, 0.24, 6.0, "advisory_call"),
    ("relationship_call", 0.50, 0.46, 0.20, 4.0, "relationship_manager_call"),
)
ACTION_DEFAULTS = (0.55, 0.50, 0.18, 3.0, "email_or_phone")
# Reasons an action addresses directly, cost factor of completed actions.
ALIGNED_REASONS = ("service_friction", "low_satisfaction", "digital_inactivity")
COMPLETED_COST = 1.35

OUTCOME_COLUMNS = ("contact_success", "treatment_completed", "retained")
# Events that show each outcome; the window is as long as the target looks ahead.
OUTCOME_EVENTS = dict(zip(("click", "purchase", "signup"), OUTCOME_COLUMNS))
OUTCOME_DAYS = 90
LEDGER_INPUTS = (
    "policy_rank", *KEYS, TARGET, MODEL_V1_SCORE, *CARRIED_INDEXES, "recommended_action",
    "assigned_group", "reason_code_1", "reason_code_2",
)
# Columns of the ledger, in order.
LEDGER_COLUMNS = (
    "treatment_log_id", "policy_rank", *KEYS, "assigned_group", "recommended_action",
    "contact_channel", "reason_code_1", "reason_code_2", MODEL_V1_SCORE, *CARRIED_INDEXES, TARGET,
    "contact_attempted", "contact_success", "treatment_completed", "prevented_attrition_flag",
    POST_TARGET, "intervention_cost_index", "retained_value_index", "net_value_index",
)


def action_dimension(spark: SparkSession) -> DataFrame:
    """The five actions with their parameters, as a local relation."""
    rows = ", ".join(
        f"('{a}', {p}D, {q}D, {e}D, {cost}D, '{channel}')" for a, p, q, e, cost, channel in ACTIONS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(ACTION_COLUMNS)})")


def with_action_parameters(listed: DataFrame) -> DataFrame:
    """Add channel and base rates of the row's action, defaults for an unknown one."""
    names = ACTION_COLUMNS[1:]
    # Five constant rows, hence the broadcast.
    joined = listed.join(
        F.broadcast(action_dimension(listed.sparkSession)), "recommended_action", "left"
    )
    return joined.withColumns(
        {n: F.coalesce(F.col(n), F.lit(d)) for n, d in zip(names, ACTION_DEFAULTS)}
    )


def with_ledger_id(listed: DataFrame) -> DataFrame:
    return listed.withColumn("treatment_log_id", F.format_string("TLOG-%06d", "policy_rank"))


def contact_probability() -> Column:
    return clip(
        F.col("base_contact")
        + 0.10 * (1.0 - F.col(MODEL_V1_SCORE))
        - 0.05 * clip(F.col("value_at_risk_index"), 0.0, 100.0) / 100.0,
        0.05, 0.95,
    )


def completion_probability(contacted: Column) -> Column:
    return clip(
        F.col("base_completion") + 0.08 * contacted - 0.04 * F.col(MODEL_V1_SCORE), 0.05, 0.90
    )


def effect_probability() -> Column:
    aligned = F.when(F.col("reason_code_1").isin(*ALIGNED_REASONS), 0.05).otherwise(0.0)
    return clip(
        F.col("base_effect")
        + aligned
        + 0.05 * (clip(F.col("relationship_value_index"), 0.0, 100.0) / 100.0),
        0.00, 0.45,
    )


def is_treatment() -> Column:
    return F.col("assigned_group") == "treatment"


def window_opening(start: datetime | None = None) -> Column:
    """The day an intervention's window opens, counted from 1970: the first one after its
    snapshot month, or that of ``start`` for all rows."""
    if start is not None:
        return F.lit((start.date() - date(1970, 1, 1)).days)
    return F.unix_date(F.add_months(F.to_date(F.col(MONTH), "yyyy-MM"), 1))


def observed_outcomes(
    events: DataFrame, listed: DataFrame, start: datetime | None = None, days: int = OUTCOME_DAYS
) -> DataFrame:
    """Outcome flags per listed row from the events in its own window of ``days`` days.

    ``listed`` has customer_id, snapshot_month and user_id; a row's window opens when its
    snapshot month ends, or at ``start`` for all rows. Events before that are no outcome of
    the intervention. Rows without an outcome event in their window have no row here, nor
    has one without a user or month; a row listed for several users has all their events.

    Events are combined per user and day before they are shuffled, so a user with a third
    of all events arrives as a few flags per day. Days meet windows on (user, stretch of
    ``days`` days), of which a window touches two at most, and rows with the same user and
    month share one window, so no user's events meet each of the user's rows.
    """
    require_columns(listed, [*KEYS, "user_id"], "listed rows")
    require_columns(events, ["ts", "user_id", "event_type"], "events")
    if days < 1:
        raise ValueError("an outcome window has one day or more")
    opened = listed.select(*KEYS, "user_id", window_opening(start).alias("_opens"))
    windows = opened.select("user_id", "_opens").distinct()
    # Days begin at the time of day at which the windows open.
    clock = timedelta() if start is None else start - datetime.combine(start.date(), time())
    day = F.unix_date(F.to_date(F.col("ts") - F.lit(clock)))
    kinds = {k: F.max(flag(F.col("event_type") == k)).alias(c) for k, c in OUTCOME_EVENTS.items()}
    daily = (
        events.where(F.col("event_type").isin(list(OUTCOME_EVENTS)))
        .join(windows.select("user_id").distinct(), "user_id", "left_semi")
        .groupBy("user_id", day.alias("_day"))
        .agg(*kinds.values())
        .withColumn("_stretch", F.floor(F.col("_day") / days))
    )
    first, last = F.floor(F.col("_opens") / days), F.floor((F.col("_opens") + days - 1) / days)
    touched = windows.where("_opens IS NOT NULL").withColumn("_stretch", F.explode(F.sequence(first, last)))
    inside = F.col("_day").between(F.col("_opens"), F.col("_opens") + days - 1)
    seen = (
        touched.join(daily, ["user_id", "_stretch"])
        .where(inside)
        .groupBy("user_id", "_opens")
        .agg(*[F.max(c).alias(c) for c in OUTCOME_COLUMNS])
    )
    found = opened.join(seen, ["user_id", "_opens"])
    return found.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in OUTCOME_COLUMNS])


def attach_outcomes(listed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Add the observed outcome flags, 0 where nothing was observed.

    ``outcomes`` has one row per listed row with any observation in its window.
    """
    require_columns(outcomes, [*KEYS, *OUTCOME_COLUMNS], "outcomes")
    prefixed = outcomes.select(*KEYS, *[F.col(c).alias(f"seen_{c}") for c in OUTCOME_COLUMNS])
    return listed.join(prefixed, list(KEYS), "left").withColumns(
        {f"seen_{c}": F.coalesce(F.col(f"seen_{c}"), F.lit(0)) for c in OUTCOME_COLUMNS}
    )


def with_flags(attached: DataFrame) -> DataFrame:
    """Gate observations: success needs treatment, completion needs success, and only a
    completed treatment of a customer who would have left can have prevented it."""
    c = F.col
    return (
        attached.withColumn("contact_attempted", flag(is_treatment()))
        .withColumn("contact_success", flag(is_treatment() & (c("seen_contact_success") == 1)))
        .withColumn(
            "treatment_completed",
            flag(
                is_treatment()
                & (c("contact_success") == 1)
                & (c("seen_treatment_completed") == 1)
            ),
        )
        .withColumn(
            "prevented_attrition_flag",
            flag(
                is_treatment()
                & (c("treatment_completed") == 1)
                & (c(TARGET) == 1)
                & (c("seen_retained") == 1)
            ),
        )
        .withColumn(POST_TARGET, clip(c(TARGET) - c("prevented_attrition_flag"), 0, 1))
    )


def with_economics(flagged: DataFrame) -> DataFrame:
    c = F.col
    factor = F.when(c("treatment_completed") == 1, COMPLETED_COST).otherwise(1.00)
    cost = F.when(is_treatment(), c("base_cost") * factor).otherwise(0.0)
    return (
        flagged.withColumn("intervention_cost_index", round_even(cost, 2))
        .withColumn(
            "retained_value_index",
            round_even(c("prevented_attrition_flag") * c("relationship_value_index"), 2),
        )
        .withColumn(
            "net_value_index",
            round_even(c("retained_value_index") - c("intervention_cost_index"), 2),
        )
    )


def expected_value(listed: DataFrame) -> DataFrame:
    """Expected cost, retained and net value per row from the action probabilities.

    Completion presupposes contact, so it enters with its rate among contacted
    customers; nothing is expected of a control row.
    """
    require_columns(listed, LEDGER_INPUTS, "intervention list")
    c = F.col
    rated = with_action_parameters(listed).withColumns(
        {
            "contact_probability": contact_probability(),
            "completion_probability": completion_probability(F.lit(1.0)),
            "effect_probability": effect_probability(),
        }
    )
    completed = c("contact_probability") * c("completion_probability")
    treated = flag(is_treatment())
    cost = treated * c("base_cost") * (1.0 + (COMPLETED_COST - 1.0) * completed)
    retained = (
        treated * completed * c("effect_probability") * c(TARGET) * c("relationship_value_index")
    )
    return rated.select(
        "policy_rank", *KEYS, "recommended_action", "assigned_group",
        "contact_probability", "completion_probability", "effect_probability",
        cost.alias("expected_cost"), retained.alias("expected_retained_value"),
        (retained - cost).alias("expected_net_value"),
    )


def build_ledger(listed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The 22-column ledger of an intervention list and its observed outcomes."""
    require_columns(listed, LEDGER_INPUTS, "intervention list")
    prepared = with_action_parameters(with_ledger_id(listed))
    return with_economics(with_flags(attach_outcomes(prepared, outcomes))).select(*LEDGER_COLUMNS)


def summarise_ledger(ledger: DataFrame) -> DataFrame:
    """One row: counts, pre and post rates, contact and completion rates, value totals."""
    require_columns(ledger, LEDGER_COLUMNS, "ledger")
    c = F.col
    treated = flag(is_treatment())
    attempted = treated * flag(c("contact_attempted") == 1)

    def sum_or_zero(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    def rate(over: Column, name: str) -> Column:
        return F.coalesce(ratio(F.sum(over * c(name)), F.sum(over)), F.lit(0.0))

    return ledger.agg(
        F.count(F.lit(1)).alias("rows"),
        sum_or_zero(treated).alias("treatment_rows"),
        sum_or_zero(flag(c("assigned_group") == "control")).alias("control_rows"),
        F.avg(TARGET).alias("pre_intervention_target_rate"),
        F.avg(POST_TARGET).alias("post_intervention_target_rate"),
        rate(attempted, "contact_success").alias("contact_success_rate"),
        rate(treated, "treatment_completed").alias("treatment_completion_rate"),
        sum_or_zero(c("prevented_attrition_flag")).alias("prevented_attrition_count"),
        F.coalesce(F.sum("intervention_cost_index"), F.lit(0.0)).alias("total_intervention_cost_index"),
        F.coalesce(F.sum("retained_value_index"), F.lit(0.0)).alias("total_retained_value_index"),
        F.coalesce(F.sum("net_value_index"), F.lit(0.0)).alias("total_net_value_index"),
    )
