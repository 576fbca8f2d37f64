"""Registered queries: each operator over the whole of the given fact tables.

A trained model's scores have no SQL equivalent, so queries that need scores to act on
use the rules score, or the panel's attrition propensity, in the model's place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.numeric import round_even
from holdfast.operators import audit, features, learning, ledger, metrics, panel, policy
from holdfast.operators import ranking, reports, rules, scorestate
from holdfast.plans.job import JobSpec, resume_job
from holdfast.schema import (
    DERIVED_COLUMNS,
    FEATURE_TABLE_SCHEMA,
    KEYS,
    MONTH,
    NUMERIC_FEATURES,
    PANEL_SCHEMA,
    SPLIT,
    TARGET,
)
from holdfast.sources.facts import read_fact
from holdfast.sources.staging import stage, staging_path
from holdfast.sources.tables import read_table, write_table

SPEC = panel.PanelSpec()
PROPENSITY = "attrition_propensity"
# One list place per this many customers.
CUSTOMERS_PER_PLACE = 6

# The events of the given tables are of January 2024, the orders end in 2001: their clock is
# set back so that they begin 28 days before the windows of the latest list open.
EVENT_CLOCK = timedelta(days=8308)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


# Inputs ---------------------------------------------------------------------------------


def panel_facts(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [read_fact(spark, folder, n) for n in ("customer", "nation", "orders", "lineitem")]


def panel_of(spark: SparkSession, folder: str) -> DataFrame:
    return panel.build_panel(*panel_facts(spark, folder), SPEC)


def features_of(spark: SparkSession, folder: str) -> DataFrame:
    return features.build_feature_table(panel_of(spark, folder), SPEC.snapshot_months())


def staged_features(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table over a staged panel: each pass derives the few columns that the panel
    has not, which costs less than to write them."""
    full_panel = stage(panel_of(spark, folder), "panel")
    return features.build_feature_table(full_panel, SPEC.snapshot_months())


def staged_rule_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return stage(features_of(spark, folder).select(*rules.RULES_COLUMNS), "rule-inputs")


def rules_scored(spark: SparkSession, folder: str) -> DataFrame:
    return rules.score_with_rules(staged_rule_inputs(spark, folder))


def as_model_scores(scored: DataFrame) -> DataFrame:
    return scored.withColumnsRenamed(
        {rules.RULES_SCORE: policy.MODEL_V1_SCORE, rules.RULES_DECILE: policy.MODEL_V1_DECILE}
    )


def propensity_scored(table: DataFrame) -> DataFrame:
    """Propensity of the rows of a panel, or of a feature table, which has the same columns."""
    scored = panel.propensity(table).select(*KEYS, TARGET, PROPENSITY)
    return features.add_temporal_split(scored, SPEC.snapshot_months())


def capacity_of(spark: SparkSession, folder: str) -> int:
    return read_fact(spark, folder, "customer").count() // CUSTOMERS_PER_PLACE


def policy_of(spark: SparkSession, folder: str, table: DataFrame) -> DataFrame:
    scored = as_model_scores(rules.score_with_rules(table))
    capacity = capacity_of(spark, folder)
    return policy.create_intervention_list(scored, table, capacity).intervention_list


def candidates_of(spark: SparkSession, folder: str) -> DataFrame:
    table = staged_rule_inputs(spark, folder)
    scored = as_model_scores(rules.score_with_rules(table))
    latest = SPEC.snapshot_months()[-1]
    return policy.join_candidates(*policy.policy_candidates(scored, table, latest))


def users_of(spark: SparkSession, folder: str, customers: DataFrame) -> DataFrame:
    """``customers`` with the user each one maps to; nobody where there are no users."""
    events = read_fact(spark, folder, "events")
    users = (events.agg(F.max("user_id")).first()[0] or 0) + 1
    return customers.withColumn("user_id", F.col("customer_id") % users)


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    """Events on the clock of the orders."""
    events = read_fact(spark, folder, "events")
    return events.withColumn("ts", F.col("ts") - F.lit(EVENT_CLOCK))


def outcomes_of(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    users = users_of(spark, folder, listed.select(*KEYS))
    return ledger.observed_outcomes(events_of(spark, folder), users)


def list_of(spark: SparkSession, folder: str) -> DataFrame:
    return policy_of(spark, folder, staged_rule_inputs(spark, folder))


def ledger_of(spark: SparkSession, folder: str, table: DataFrame | None = None) -> DataFrame:
    if table is None:
        table = staged_rule_inputs(spark, folder)
    listed = stage(policy_of(spark, folder, table), "listed")
    return ledger.build_ledger(listed, outcomes_of(spark, folder, listed))


def learning_of(spark: SparkSession, folder: str, table: DataFrame | None = None) -> DataFrame:
    if table is None:
        table = staged_features(spark, folder)
    log = stage(ledger_of(spark, folder, table), "ledger")
    return stage(learning.build_learning_table(table, log), "learning")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns rounded, so that the order of additions cannot show."""
    return df.select(
        *[
            round_even(F.col(name), digits).alias(name) if kind == "double" else name
            for name, kind in df.dtypes
        ]
    )


# Panel ----------------------------------------------------------------------------------


@query("panel_spine")
def panel_spine(spark, folder):
    return panel.month_spine(panel.dense_facts(*panel_facts(spark, folder), SPEC), SPEC)


PANEL_QUERIES = {
    "panel_attributes": ("age_band", "region_type", "relationship_segment"),
    "panel_tenure": ("customer_month_index", "tenure_months"),
    "panel_products": (
        "active_products", "has_savings_product", "has_credit_product", "has_digital_wallet",
    ),
    "panel_value_indexes": (
        "savings_balance_index", "credit_balance_index", "relationship_value_index",
    ),
    "panel_activity_counts": ("app_logins_30d", "web_logins_30d", "digital_transactions_30d"),
    "panel_recency": ("last_digital_activity_days",),
    "panel_engagement": ("digital_engagement_score",),
    "panel_trend": ("digital_engagement_trend_3m",),
    "panel_service_counts": (
        "contact_attempts_90d", "successful_contacts_90d", "complaint_count_180d",
        "average_resolution_days", "recent_credit_application_flag",
    ),
    "panel_service_scores": (
        "process_friction_score", "satisfaction_proxy_score", "repayment_behaviour_score",
    ),
    "panel_past_due_band": ("days_past_due_band",),
    "panel_label": (TARGET,),
}
FEATURE_QUERIES = {
    "features_scores": (
        "relationship_depth_score", "relationship_health_score", "value_at_risk_index",
    ),
    "features_flags": tuple(c for c in DERIVED_COLUMNS if c.endswith("_flag")),
    "features_credit_stress": ("days_past_due_band", "credit_stress_score"),
    "temporal_split": (SPLIT,),
}


def _select_query(source: Query, columns: tuple[str, ...]) -> Query:
    return lambda spark, folder: source(spark, folder).select(*KEYS, *columns)


for _name, _columns in PANEL_QUERIES.items():
    QUERIES[_name] = _select_query(panel_of, _columns)


@query("panel_propensity")
def panel_propensity(spark, folder):
    return panel.propensity(panel_of(spark, folder)).select(*KEYS, PROPENSITY)


@query("panel_seasonality")
def panel_seasonality(spark, folder):
    effect = panel.seasonal_effect(F.col("customer_month_index")).alias("seasonal_effect")
    return panel_of(spark, folder).select(*KEYS, effect)


@query("panel_summary")
def panel_summary(spark, folder):
    return rounded(panel.summarise_panel(panel_of(spark, folder)))


@query("panel_roundtrip")
def panel_roundtrip(spark, folder):
    path = staging_path(spark, "panel")
    write_table(panel_of(spark, folder), path, partition_by=MONTH)
    return read_table(spark, path, PANEL_SCHEMA)


# Features -------------------------------------------------------------------------------

for _name, _columns in FEATURE_QUERIES.items():
    QUERIES[_name] = _select_query(features_of, _columns)

QUERIES["feature_table"] = features_of


@query("features_roundtrip")
def features_roundtrip(spark, folder):
    path = staging_path(spark, "features")
    write_table(features_of(spark, folder), path, partition_by=MONTH)
    return read_table(spark, path, FEATURE_TABLE_SCHEMA)


@query("feature_summary")
def feature_summary(spark, folder):
    return rounded(features.summarise_features(features_of(spark, folder)))


@query("target_rate_by_split")
def target_rate_by_split(spark, folder):
    return rounded(features.target_rate_by_split(features_of(spark, folder)))


@query("numeric_profile")
def numeric_profile(spark, folder):
    return rounded(features.numeric_profile(features_of(spark, folder), NUMERIC_FEATURES), 4)


# Rules ----------------------------------------------------------------------------------


@query("rules_raw_score")
def rules_raw_score(spark, folder):
    raw = round_even(rules.raw_rules_score(), 9).alias("raw_score")
    return features_of(spark, folder).select(*KEYS, raw)


@query("rules_score")
def rules_score(spark, folder):
    return rules.score_rules(staged_rule_inputs(spark, folder)).select(*KEYS, rules.RULES_SCORE)


@query("rules_decile")
def rules_decile(spark, folder):
    return rules_scored(spark, folder).select(*KEYS, rules.RULES_SCORE, rules.RULES_DECILE)


@query("decile_profile")
def decile_profile(spark, folder):
    scored = rules_scored(spark, folder)
    return rounded(
        ranking.decile_profile(scored, rules.RULES_SCORE, rules.RULES_DECILE, TARGET)
    )


@query("rules_pipeline")
def rules_pipeline(spark, folder):
    result = rules.run_rules(staged_rule_inputs(spark, folder))
    measured = result.metrics.select(
        F.col("split").alias(SPLIT), F.col("roc_auc").alias("split_roc_auc")
    )
    # One row per evaluated split.
    return rounded(result.scored_table.join(F.broadcast(measured), SPLIT, "left"))


# Metrics --------------------------------------------------------------------------------


def rules_metrics_of(
    spark: SparkSession, folder: str, table: DataFrame | None = None, **options
) -> DataFrame:
    if table is None:
        table = staged_rule_inputs(spark, folder)
    scored = stage(rules.score_rules(table), "scored")
    return rounded(rules.evaluate_rules(scored, **options))


METRIC_QUERIES = {
    "metrics_base": ("rows", "target_rate"),
    "metrics_roc_auc": ("roc_auc",),
    "metrics_pr_auc": ("pr_auc",),
    "metrics_brier": ("brier_score",),
    "metrics_precision_at_k": tuple(f"precision_at_{k}" for k in metrics.K_VALUES),
    "metrics_lift_at_k": tuple(f"lift_at_{k}" for k in metrics.K_VALUES),
}


def _metric_query(columns: tuple[str, ...]) -> Query:
    return lambda spark, folder: rules_metrics_of(spark, folder).select("split", *columns)


for _name, _columns in METRIC_QUERIES.items():
    QUERIES[_name] = _metric_query(_columns)

QUERIES["metrics_rules"] = rules_metrics_of


@query("metrics_custom_k")
def metrics_custom_k(spark, folder):
    return rules_metrics_of(
        spark, folder, splits=("train", "test"), k_values=metrics.K_VALUES_LEDGER
    )


def propensity_metrics_of(
    spark: SparkSession, folder: str, table: DataFrame | None = None
) -> DataFrame:
    if table is None:
        table = panel_of(spark, folder)
    scored = stage(propensity_scored(table), "scored")
    return rounded(metrics.evaluate_scores(scored, PROPENSITY, policy.MODEL_V1_VERSION))


QUERIES["score_then_measure"] = propensity_metrics_of


# Policy ---------------------------------------------------------------------------------


@query("latest_snapshot")
def latest_snapshot(spark, folder):
    return policy.latest_snapshot(panel_of(spark, folder))


@query("policy_candidates")
def policy_candidates(spark, folder):
    table = staged_rule_inputs(spark, folder)
    scored = as_model_scores(rules.score_with_rules(table))
    latest = policy.latest_snapshot(scored).first()[MONTH]
    return policy.policy_candidates(scored, table, latest)[0]


QUERIES["policy_join"] = candidates_of


@query("policy_topk")
def policy_topk(spark, folder):
    scored = as_model_scores(rules_scored(spark, folder))
    latest = scored.where(F.col(MONTH) == SPEC.snapshot_months()[-1])
    top = policy.select_top(latest, capacity_of(spark, folder))
    return top.select(*KEYS, policy.MODEL_V1_SCORE, "value_at_risk_index")


@query("policy_reason_codes")
def policy_reason_codes(spark, folder):
    first, second = policy.reason_codes()
    return candidates_of(spark, folder).select(
        *KEYS, first.alias("reason_code_1"), second.alias("reason_code_2")
    )


@query("policy_actions")
def policy_actions(spark, folder):
    action = policy.recommended_action().alias("recommended_action")
    return candidates_of(spark, folder).select(*KEYS, action)


@query("policy_assignment")
def policy_assignment(spark, folder):
    return list_of(spark, folder).select(*KEYS, "assigned_group")


@query("policy_rank")
def policy_rank(spark, folder):
    return list_of(spark, folder).select(*KEYS, "policy_rank")


QUERIES["intervention_list"] = list_of


@query("intervention_summary")
def intervention_summary(spark, folder):
    return rounded(policy.summarise_list(list_of(spark, folder)))


# Ledger ---------------------------------------------------------------------------------


@query("ledger_ids")
def ledger_ids(spark, folder):
    return ledger.with_ledger_id(list_of(spark, folder)).select(
        "treatment_log_id", "policy_rank", *KEYS
    )


@query("ledger_channel")
def ledger_channel(spark, folder):
    return ledger.with_action_parameters(list_of(spark, folder)).select(
        *KEYS, "recommended_action", "contact_channel"
    )


@query("ledger_action_params")
def ledger_action_params(spark, folder):
    return ledger.with_action_parameters(candidates_with_action(spark, folder)).select(
        *KEYS, *ledger.ACTION_COLUMNS
    )


def candidates_with_action(spark: SparkSession, folder: str) -> DataFrame:
    return candidates_of(spark, folder).withColumn(
        "recommended_action", policy.recommended_action()
    )


@query("ledger_probabilities")
def ledger_probabilities(spark, folder):
    listed = stage(list_of(spark, folder), "listed")
    rated = ledger.with_flags(
        ledger.attach_outcomes(
            ledger.with_action_parameters(listed), outcomes_of(spark, folder, listed)
        )
    )
    return rated.select(
        *KEYS,
        ledger.contact_probability().alias("contact_probability"),
        ledger.completion_probability(F.col("contact_success")).alias("completion_probability"),
        ledger.effect_probability().alias("effect_probability"),
    )


@query("ledger_outcomes")
def ledger_outcomes(spark, folder):
    listed = stage(list_of(spark, folder), "listed")
    attached = ledger.attach_outcomes(listed, outcomes_of(spark, folder, listed))
    return attached.select(*KEYS, *[f"seen_{c}" for c in ledger.OUTCOME_COLUMNS])


@query("ledger_windows")
def ledger_windows(spark, folder):
    """Outcomes of every customer in the windows of all months, one intervention in each."""
    every = panel_of(spark, folder).select(*KEYS)
    return outcomes_of(spark, folder, every)


@query("ledger_flags")
def ledger_flags(spark, folder):
    return ledger_of(spark, folder).select(
        *KEYS, "assigned_group", "contact_attempted", "contact_success", "treatment_completed",
        "prevented_attrition_flag", ledger.POST_TARGET,
    )


@query("ledger_economics")
def ledger_economics(spark, folder):
    return ledger_of(spark, folder).select(
        *KEYS, "intervention_cost_index", "retained_value_index", "net_value_index"
    )


@query("ledger_expected_value")
def ledger_expected_value(spark, folder):
    return rounded(ledger.expected_value(list_of(spark, folder)), 9)


QUERIES["treatment_ledger"] = ledger_of


@query("ledger_summary")
def ledger_summary(spark, folder):
    return rounded(ledger.summarise_ledger(ledger_of(spark, folder)))


# Learning -------------------------------------------------------------------------------


@query("model_v1_design")
def model_v1_design(spark, folder):
    design = learning.model_v1_design(staged_features(spark, folder))
    entries = vector_to_array("design")
    summed = F.aggregate(entries, F.lit(0.0), lambda a, b: a + b)
    return rounded(
        design.groupBy(SPLIT).agg(
            F.count(F.lit(1)).alias("rows"),
            F.max(F.size(entries)).alias("design_width"),
            F.sum(summed).alias("design_total"),
        ),
        2,
    )


_trained: dict[tuple[str, str, str], PipelineModel] = {}


def trained(spark: SparkSession, folder: str, version: str, train) -> PipelineModel:
    """A model is fitted once per application and data folder."""
    key = (spark.sparkContext.applicationId, folder, version)
    if key not in _trained:
        _trained[key] = train()
    return _trained[key]


@query("model_v1_scores")
def model_v1_scores(spark, folder):
    table = staged_features(spark, folder)
    model = trained(spark, folder, learning.MODEL_V1_VERSION, lambda: learning.train_model_v1(table))
    scores = stage(learning.score_model_v1(model, table), "v1-scores")
    return ranking.assign_deciles(scores, policy.MODEL_V1_SCORE, policy.MODEL_V1_DECILE)


@query("model_v1_metrics")
def model_v1_metrics(spark, folder):
    return learning.evaluate_model_v1(model_v1_scores(spark, folder))


def contract_of(scored: DataFrame, score: str, decile: str, split: str, target: str) -> DataFrame:
    """Measures of a scored table that no fitted model may change."""
    ok = F.col(score).between(0, 1)
    whole = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(*KEYS).alias("distinct_keys"),
        F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)).alias("bad_scores"),
    ).unpivot([], ["rows", "distinct_keys", "bad_scores"], "measure", "value")
    parts = [whole.select("measure", F.col("value").cast("double"))]
    for column, name in ((decile, "decile"), (split, "rows")):
        label = F.concat(F.lit(f"{name}_"), F.col(column).cast("string")).alias("measure")
        parts.append(scored.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("value")))
    label = F.concat(F.lit("target_rate_"), F.col(split)).alias("measure")
    parts.append(scored.groupBy(label).agg(round_even(F.avg(target), 6).alias("value")))
    return reduce(DataFrame.unionByName, parts)


@query("model_v1_contract")
def model_v1_contract(spark, folder):
    scored = model_v1_scores(spark, folder)
    return contract_of(scored, policy.MODEL_V1_SCORE, policy.MODEL_V1_DECILE, SPLIT, TARGET)


@query("model_v2_contract")
def model_v2_contract(spark, folder):
    return contract_of(
        model_v2_scores(spark, folder), learning.MODEL_V2_SCORE, learning.MODEL_V2_DECILE,
        learning.LEARNING_SPLIT, ledger.POST_TARGET,
    )


@query("split_presence")
def split_presence(spark, folder):
    return learning.split_presence(features_of(spark, folder))


QUERIES["learning_table"] = learning_of


@query("learning_null_audit")
def learning_null_audit(spark, folder):
    table = staged_features(spark, folder)
    return learning.null_audit(learning.join_ledger(table, ledger_of(spark, folder, table)))


@query("stratified_split")
def stratified_split(spark, folder):
    return learning_of(spark, folder).select(*KEYS, ledger.POST_TARGET, learning.LEARNING_SPLIT)


@query("model_v2_scores")
def model_v2_scores(spark, folder):
    table = learning_of(spark, folder)
    model = trained(spark, folder, learning.MODEL_V2_VERSION, lambda: learning.train_model_v2(table))
    return learning.score_model_v2(model, table)


@query("model_v2_metrics")
def model_v2_metrics(spark, folder):
    return learning.evaluate_model_v2(model_v2_scores(spark, folder))


# Audit ----------------------------------------------------------------------------------


def ledger_metrics_of(learned: DataFrame) -> DataFrame:
    """Metrics of the first score against the post-intervention target."""
    return rounded(
        metrics.evaluate_scores(
            learned, policy.MODEL_V1_SCORE, learning.MODEL_V2_VERSION,
            k_values=metrics.K_VALUES_LEDGER, split_column=learning.LEARNING_SPLIT,
            target=ledger.POST_TARGET,
        )
    )


@query("comparison_normalise")
def comparison_normalise(spark, folder):
    return audit.normalise_metrics(rules_metrics_of(spark, folder), audit.RULES_FAMILY)


def comparison_of(spark: SparkSession, folder: str) -> DataFrame:
    """All three metric tables from one staged feature table."""
    table = staged_features(spark, folder)
    return audit.build_model_comparison(
        rules_metrics_of(spark, folder, table),
        propensity_metrics_of(spark, folder, table),
        ledger_metrics_of(learning_of(spark, folder, table)),
    )


QUERIES["model_comparison"] = comparison_of


def checks_of(spark: SparkSession, folder: str) -> DataFrame:
    full_panel = stage(panel_of(spark, folder), "panel")
    table = features.build_feature_table(full_panel, SPEC.snapshot_months())
    scored = rules.score_with_rules(table)
    v1 = as_model_scores(scored)
    chosen = policy.create_intervention_list(v1, table, capacity_of(spark, folder))
    listed = stage(chosen.intervention_list, "listed")
    log = stage(ledger.build_ledger(listed, outcomes_of(spark, folder, listed)), "ledger")
    learned = stage(learning.build_learning_table(table, log), "learned")
    v2 = learned.withColumnRenamed(policy.MODEL_V1_SCORE, learning.MODEL_V2_SCORE)
    return audit.build_governance_checks(
        full_panel, table, scored, v1, listed, log, learned, v2
    )


QUERIES["audit_checks"] = checks_of


@query("audit_duplicate_keys")
def audit_duplicate_keys(spark, folder):
    return audit.key_profile(panel_of(spark, folder)).select("rows", "duplicate_keys")


@query("audit_missing_values")
def audit_missing_values(spark, folder):
    return audit.key_profile(features_of(spark, folder)).select("rows", "missing_values")


@query("audit_row_parity")
def audit_row_parity(spark, folder):
    table = staged_rule_inputs(spark, folder)
    return audit.row_parity(rules.score_rules(table), table)


@query("audit_score_range")
def audit_score_range(spark, folder):
    scored = rules.score_rules(staged_rule_inputs(spark, folder))
    return audit.score_range_check(scored, rules.RULES_SCORE)


@query("audit_group_shares")
def audit_group_shares(spark, folder):
    return rounded(audit.group_shares(list_of(spark, folder)))


@query("audit_net_value")
def audit_net_value(spark, folder):
    return audit.net_value_audit(ledger_of(spark, folder))


@query("audit_summary")
def audit_summary(spark, folder):
    return audit.summarise_checks(checks_of(spark, folder))


@query("audit_failures")
def audit_failures(spark, folder):
    return audit.failed_checks(checks_of(spark, folder))


# Writers --------------------------------------------------------------------------------


def _written(name: str, source: Query, fmt: str = "parquet", single_file: bool = False) -> Query:
    """The table of another query, written and read back."""

    def run(spark, folder):
        df = source(spark, folder)
        path = write_table(df, staging_path(spark, name), fmt, single_file=single_file)
        return read_table(spark, path, df.schema, fmt)

    return run


QUERIES["scored_roundtrip"] = _written("scored", rules_decile)
QUERIES["metrics_roundtrip"] = _written("metrics", rules_metrics_of, "csv", single_file=True)
QUERIES["list_roundtrip"] = _written("list", list_of)
QUERIES["ledger_roundtrip"] = _written("ledger", ledger_of)
QUERIES["learning_roundtrip"] = _written("learning-table", learning_of)
QUERIES["comparison_roundtrip"] = _written("comparison", comparison_of, "csv", single_file=True)
QUERIES["checks_roundtrip"] = _written("checks", checks_of, "csv", single_file=True)


@query("learning_presented")
def learning_presented(spark, folder):
    return learning.in_policy_order(learning_of(spark, folder))


# Reports --------------------------------------------------------------------------------


@query("report_metric_ranking")
def report_metric_ranking(spark, folder):
    return reports.metric_ranking(comparison_of(spark, folder), "roc_auc")


@query("report_action_mix")
def report_action_mix(spark, folder):
    return reports.action_mix(list_of(spark, folder))


@query("score_state")
def score_state(spark, folder):
    """The rules score's state, added up from those of single years."""
    scored = stage(rules.score_rules(staged_rule_inputs(spark, folder)), "scored")
    years = sorted({m[:4] for m in SPEC.snapshot_months()})
    parts = [
        scorestate.count_scores(
            scored.where(F.col(MONTH).startswith(year)),
            F.col(rules.RULES_SCORE), F.col(SPLIT), F.col(TARGET),
        )
        for year in years
    ]
    return scorestate.merge_counts(parts)


@query("report_outcome_rates")
def report_outcome_rates(spark, folder):
    return rounded(reports.outcome_rates(ledger_of(spark, folder)))


@query("report_score_histogram")
def report_score_histogram(spark, folder):
    scored = rules.score_rules(staged_rule_inputs(spark, folder))
    return rounded(reports.score_histogram(scored, rules.RULES_SCORE))


# Tables of the job whose number of rows depends on what the models learned.
LEARNED_ROWS = ("governance_summary", "chart_roc_auc", "chart_pr_auc", "chart_action_mix")


@query("job_tables")
def job_tables(spark, folder):
    """Rows of the tables the whole job writes, from its manifest.

    Few boosting rounds: no row of these tables depends on the number of trees.
    """
    spec = JobSpec(
        panel=SPEC, capacity=capacity_of(spark, folder),
        v1_boosting=replace(learning.V1_BOOSTING, rounds=3),
        v2_boosting=replace(learning.V2_BOOSTING, rounds=3),
    )
    customers = read_fact(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"))
    users = users_of(spark, folder, customers)
    result = resume_job(spark, folder, staging_path(spark, "job"), users, spec)
    return result.manifest.where(~F.col("table_name").isin(*LEARNED_ROWS)).select(
        "table_name", "state", "rows"
    )
