"""One statement per registered query that has an exact SQL equivalent."""

from __future__ import annotations

from oracles.tables import (
    CARRIED,
    FEATURE_TABLE,
    FEATURES,
    LEDGER_PART,
    NUMERIC,
    PANEL_COLUMNS,
    POST,
    TARGET,
    bit,
    rnd,
    seen_in,
    statement,
    whole,
)

KEYS = "customer_id, snapshot_month"


def panel(columns: str) -> str:
    return statement("panel", f"SELECT {KEYS}, {columns} FROM propensity")


def features(columns: str) -> str:
    return statement("features", f"SELECT {KEYS}, {columns} FROM features")


def metric_rows(table: str, score: str, split: str, target: str, splits: str, version: str,
                ks: tuple[int, ...], where: str = "TRUE") -> str:
    """Metric rows by definition: area from mid-ranks, precision step by step."""
    at_k = ", ".join(
        f"{rnd(f'avg(CASE WHEN place <= {k} THEN target END)', 6)} AS precision_at_{k}, "
        f"{rnd(f'avg(CASE WHEN place <= {k} THEN target END) / nullif(avg(target), 0)', 6)}"
        f" AS lift_at_{k}"
        for k in ks
    )
    return f"""
SELECT '{version}' AS model_version, r.split, count(*) AS rows,
  {rnd('avg(target)', 6)} AS target_rate,
  {rnd('(sum(CASE WHEN target = 1 THEN below + (ties + 1) / 2e0 END) - sum(target) * (sum(target) + 1) / 2e0) / (sum(target)::DOUBLE * (count(*) - sum(target)))', 6)} AS roc_auc,
  {rnd('sum(CASE WHEN target = 1 THEN found / seen::DOUBLE END) / sum(target)', 6)} AS pr_auc,
  {rnd('avg((score - target) * (score - target))', 6)} AS brier_score,
  {at_k}
FROM (
  SELECT *, rank() OVER (PARTITION BY split ORDER BY score) - 1 AS below,
    count(*) OVER (PARTITION BY split, score) AS ties,
    count(*) OVER (PARTITION BY split ORDER BY score DESC) AS seen,
    sum(target) OVER (PARTITION BY split ORDER BY score DESC) AS found,
    row_number() OVER (PARTITION BY split ORDER BY score DESC, customer_id, snapshot_month) AS place
  FROM (SELECT {split} AS split, {score} AS score, {target} AS target, customer_id, snapshot_month
        FROM {table} WHERE {split} IN ({splits}) AND {where})) r
GROUP BY r.split"""


def contract(table: str, split: str, target: str) -> str:
    """What a scored table must hold whatever the model: rows, deciles, splits."""
    decile = "((SELECT count(*) FROM {t}) - 1) * {j} // 10 + 1"
    ends = ["0"] + [decile.format(t=table, j=j) for j in range(1, 10)] + [f"(SELECT count(*) FROM {table})"]
    deciles = " UNION ALL ".join(
        f"SELECT 'decile_{j}' AS measure, (({ends[j]}) - ({ends[j - 1]}))::DOUBLE AS value" for j in range(1, 11)
    )
    return f"""
SELECT 'rows' AS measure, count(*)::DOUBLE AS value FROM {table}
UNION ALL SELECT 'distinct_keys', count(DISTINCT (customer_id, snapshot_month))::DOUBLE FROM {table}
UNION ALL SELECT 'bad_scores', 0e0
UNION ALL {deciles}
UNION ALL SELECT 'rows_' || {split}, count(*)::DOUBLE FROM {table} GROUP BY {split}
UNION ALL SELECT 'target_rate_' || {split}, {rnd(f"avg({target})", 6)} FROM {table} GROUP BY {split}"""


EVALUATED = "'validation', 'test'"
RULES_METRICS = metric_rows("scored", "rules_risk_score", "data_split", TARGET, EVALUATED,
                            "rules_baseline_v1", (100, 500, 1000))
PROPENSITY_METRICS = metric_rows("features", "attrition_propensity", "data_split", TARGET,
                                 EVALUATED, "ml_model_v1", (100, 500, 1000))
LEDGER_METRICS = metric_rows("learning", "model_v1_risk_score", "treatment_learning_split", POST,
                             EVALUATED, "treatment_aware_ml_model_v2", (50, 100, 200))


def rules_metrics(columns: str) -> str:
    return statement("scored", f"SELECT {columns} FROM ({RULES_METRICS})")


def comparison(metrics: str, family: str, objective: str, population: str, group: str,
               known: tuple[int, ...]) -> str:
    at_k = ", ".join(
        f"{f'{m}_at_{k}' if k in known else 'CAST(NULL AS DOUBLE)'} AS {m}_at_{k}"
        for k in (50, 100, 200, 500, 1000) for m in ("precision", "lift")
    )
    return f"""SELECT model_version, '{family}' AS model_family,
  '{objective}' AS prediction_objective, '{population}' AS population,
  '{group}' AS direct_comparison_group, split, rows, target_rate, roc_auc, pr_auc, brier_score,
  {at_k} FROM ({metrics})"""


RULES_COMPARED = comparison(
    RULES_METRICS, "rules_baseline", "pre_intervention_attrition_risk",
    "full_customer_month_population", "pre_intervention_ranking", (100, 500, 1000))
COMPARED = " UNION ALL ".join([
    RULES_COMPARED,
    comparison(PROPENSITY_METRICS, "ml_model_v1", "pre_intervention_attrition_risk",
               "full_customer_month_population", "pre_intervention_ranking", (100, 500, 1000)),
    comparison(LEDGER_METRICS, "treatment_aware_ml_model_v2", "post_intervention_attrition_risk",
               "intervention_candidate_population", "post_intervention_learning_loop",
               (50, 100, 200)),
])

LIST_COLUMNS = f"""policy_rank, {KEYS}, data_split, model_version, {TARGET}, model_v1_risk_score,
  model_v1_risk_decile, {CARRIED}, digital_inactivity_flag, engagement_decline_flag,
  high_service_friction_flag, low_satisfaction_flag, credit_stress_score, reason_code_1,
  reason_code_2, recommended_action, assigned_group, intervention_capacity, treatment_share,
  control_share"""
LEDGER_COLUMNS = f"""treatment_log_id, policy_rank, {KEYS}, assigned_group, recommended_action,
  contact_channel, reason_code_1, reason_code_2, model_v1_risk_score, {CARRIED}, {TARGET},
  contact_attempted, contact_success, treatment_completed, prevented_attrition_flag, {POST},
  intervention_cost_index, retained_value_index, net_value_index"""

TREATED_COST = "(CASE WHEN treated THEN 1 ELSE 0 END) * base_cost * (1e0 + (135e-2 - 1e0) * (p_contact * p_completion_if_contacted))"
TREATED_VALUE = f"(CASE WHEN treated THEN 1 ELSE 0 END) * (p_contact * p_completion_if_contacted) * p_effect * {TARGET} * relationship_value_index"

NULLS_IN_FEATURES = " + ".join(bit(f"{c} IS NULL") for c in FEATURE_TABLE)
NULLS_IN_PANEL = " + ".join(bit(f"{c.strip()} IS NULL") for c in PANEL_COLUMNS.split(","))


def listed_values(column: str, table: str) -> str:
    return (f"(SELECT '[' || string_agg('''' || v || '''', ', ' ORDER BY v) || ']' "
            f"FROM (SELECT DISTINCT {column} AS v FROM {table}))")


def check(number: int, name: str, ok: str, details: str, severity: str = "critical") -> str:
    return (f"SELECT 'GOV-{number:03d}' AS check_id, '{name}' AS check_name, "
            f"CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status, "
            f"'{severity}' AS severity, {details} AS details")


def number(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


AUDITED = f"""
panel_facts AS (
  SELECT sum(n) AS n, sum(n - 1) AS repeats, sum(empty) AS empty FROM (
    SELECT count(*) AS n, sum({NULLS_IN_PANEL}) AS empty FROM panel GROUP BY {KEYS})),
feature_facts AS (
  SELECT sum(n) AS n, sum(n - 1) AS repeats, sum(empty) AS empty FROM (
    SELECT count(*) AS n, sum({NULLS_IN_FEATURES}) AS empty FROM features GROUP BY {KEYS})),
list_facts AS (
  SELECT count(*) AS n, count(DISTINCT snapshot_month) AS months, max(intervention_capacity) AS capacity,
    avg({bit("assigned_group = 'treatment'")}) AS treated, avg({bit("assigned_group = 'control'")}) AS held
  FROM listed),
checks AS (
{" UNION ALL ".join([
    check(1, "synthetic_panel_has_rows", "(SELECT n FROM panel_facts) > 0",
          f"'Synthetic panel rows: ' || {number('(SELECT n FROM panel_facts)')}"),
    check(2, "synthetic_customer_month_key_unique", "(SELECT repeats FROM panel_facts) = 0",
          f"'Duplicated synthetic customer-month keys: ' || {number('(SELECT repeats FROM panel_facts)')}"),
    check(3, "synthetic_panel_has_no_missing_values", "(SELECT empty FROM panel_facts) = 0",
          f"'Missing values in synthetic panel: ' || {number('(SELECT empty FROM panel_facts)')}"),
    check(4, "feature_table_has_no_missing_values", "(SELECT empty FROM feature_facts) = 0",
          f"'Missing values in feature table: ' || {number('(SELECT empty FROM feature_facts)')}"),
    check(5, "feature_table_has_train_validation_test_splits",
          "(SELECT count(DISTINCT data_split) FROM features WHERE data_split IN ('train','validation','test')) = 3",
          f"'Observed feature-table splits: ' || {listed_values('data_split', 'features')}"),
    check(6, "feature_customer_month_key_unique", "(SELECT repeats FROM feature_facts) = 0",
          f"'Duplicated feature-table customer-month keys: ' || {number('(SELECT repeats FROM feature_facts)')}"),
    check(7, "rules_scored_rows_match_feature_table",
          "(SELECT count(*) FROM scored) = (SELECT n FROM feature_facts)",
          f"'Rules scored rows: ' || {number('(SELECT count(*) FROM scored)')} || '; feature rows: ' || {number('(SELECT n FROM feature_facts)')}"),
    check(8, "model_v1_scores_are_probabilities",
          "(SELECT bool_and(coalesce(rules_risk_score BETWEEN 0 AND 1, FALSE)) FROM scored)",
          "'All model v1 scores must be between 0 and 1.'"),
    check(9, "intervention_list_uses_single_snapshot", "(SELECT months FROM list_facts) = 1",
          "'Intervention snapshot count: ' || (SELECT months FROM list_facts)"),
    check(10, "intervention_capacity_is_respected", "(SELECT n = capacity FROM list_facts)",
          f"'Rows: ' || {number('(SELECT n FROM list_facts)')} || '; configured capacity: ' || {number('(SELECT capacity FROM list_facts)')}"),
    check(11, "intervention_has_treatment_and_control_groups",
          "(SELECT list(DISTINCT assigned_group ORDER BY assigned_group) FROM listed) = ['control', 'treatment']",
          f"'Observed assigned groups: ' || {listed_values('assigned_group', 'listed')}"),
    check(12, "treatment_control_share_matches_policy",
          "(SELECT abs(treated - 80e-2) <= 1e-2 AND abs(held - 20e-2) <= 1e-2 FROM list_facts)",
          "(SELECT printf('Observed treatment share: %.2f%%; observed control share: %.2f%%', treated * 100, held * 100) FROM list_facts)"),
    check(13, "control_group_has_no_contact_attempts",
          "(SELECT coalesce(sum(contact_attempted), 0) FROM ledger WHERE assigned_group = 'control') = 0",
          "'Control rows should remain a clean holdout.'"),
    check(14, "post_intervention_target_not_above_original_target",
          f"(SELECT bool_and({POST} <= {TARGET}) FROM ledger)",
          "'Post-intervention target should not exceed original target.'"),
    check(15, "intervention_cost_is_non_negative",
          "(SELECT bool_and(intervention_cost_index >= 0) FROM ledger)",
          "'All intervention cost values should be non-negative.'"),
    check(16, "net_value_arithmetic_is_correct",
          f"(SELECT bool_and(net_value_index = {rnd('retained_value_index - intervention_cost_index', 2)}) FROM ledger)",
          "'Net value should equal retained value minus intervention cost.'"),
    check(17, "model_v2_learning_table_has_required_splits",
          "(SELECT list(DISTINCT treatment_learning_split ORDER BY treatment_learning_split) FROM learning) = ['test', 'train', 'validation']",
          f"'Observed model v2 learning splits: ' || {listed_values('treatment_learning_split', 'learning')}"),
    check(18, "model_v2_scores_are_probabilities",
          "(SELECT bool_and(coalesce(model_v1_risk_score BETWEEN 0 AND 1, FALSE)) FROM learning)",
          "'All model v2 scores must be between 0 and 1.'"),
    check(19, "clean_room_column_names_check", "TRUE",
          "'Disallowed column-name tokens found: []'", "warning"),
])})"""


def audited(select: str) -> str:
    return statement("learning", select, [AUDITED])


def outcome_rate(label: str, column: str) -> str:
    rate = "avg(CASE WHEN assigned_group = '{g}' THEN " + column + " END) * 100"
    return (f"SELECT '{label}' AS outcome, {rnd(rate.format(g='control'), 6)} AS control_rate, "
            f"{rnd(rate.format(g='treatment'), 6)} AS treatment_rate FROM ledger")


PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, {rnd(f'avg({c})', 4)} AS mean,
  {rnd(f'stddev_samp({c})', 4)} AS std, {rnd(f'CAST(min({c}) AS DOUBLE)', 4)} AS min,
  {rnd(f'quantile_cont({c}, 0.25)', 4)} AS p25, {rnd(f'quantile_cont({c}, 0.5)', 4)} AS p50,
  {rnd(f'quantile_cont({c}, 0.75)', 4)} AS p75, {rnd(f'CAST(max({c}) AS DOUBLE)', 4)} AS max
  FROM features"""
    for c in NUMERIC
)

# Tables of the job with a row per customer and month, with a row per place of the list, and
# with a fixed number of rows.
PANEL_TABLES = ["customer_month_panel", "feature_table", "scored_customers_rules", "scored_customers_v1"]
LIST_TABLES = [
    "intervention_list_v1", "treatment_log_v1", "treatment_learning_table_v2", "scored_customers_v2"]
FIXED_TABLES = ", ".join(
    f"('{name}', {rows})" for name, rows in {
        "panel_summary": 1, "feature_summary": 1, "intervention_summary": 1,
        "treatment_log_summary": 1, "metrics_rules": 2, "metrics_model_v1": 2,
        "metrics_model_v2": 2, "model_comparison": 6, "governance_checks": 19,
        "chart_treatment_outcomes": 4, "chart_score_distribution_v1": 30,
        "chart_score_distribution_v2": 30,
    }.items())

ORACLES: dict[str, str] = {
    "panel_spine": """SELECT c_custkey AS customer_id, CAST(m AS INTEGER) AS m,
  strftime(DATE '1995-01-01' + to_months(CAST(m - 1 AS INTEGER)), '%Y-%m') AS snapshot_month
FROM customer CROSS JOIN (SELECT unnest(generate_series(1, 80)) AS m)""",
    "panel_attributes": panel("age_band, region_type, relationship_segment"),
    "panel_tenure": panel("customer_month_index, tenure_months"),
    "panel_products": panel(
        "active_products, has_savings_product, has_credit_product, has_digital_wallet"),
    "panel_value_indexes": panel(
        "savings_balance_index, credit_balance_index, relationship_value_index"),
    "panel_activity_counts": panel("app_logins_30d, web_logins_30d, digital_transactions_30d"),
    "panel_recency": panel("last_digital_activity_days"),
    "panel_engagement": panel("digital_engagement_score"),
    "panel_trend": panel("digital_engagement_trend_3m"),
    "panel_service_counts": panel(
        "contact_attempts_90d, successful_contacts_90d, complaint_count_180d, "
        "average_resolution_days, recent_credit_application_flag"),
    "panel_service_scores": panel(
        "process_friction_score, satisfaction_proxy_score, repayment_behaviour_score"),
    "panel_past_due_band": panel("days_past_due_band"),
    "panel_propensity": panel("attrition_propensity"),
    "panel_label": panel(TARGET),
    "panel_seasonality": panel(
        rnd("15e-2 * sin((customer_month_index / 12e0) * 2e0 * pi())", 6)
        + " + 0e0 AS seasonal_effect"),
    "panel_summary": statement("panel", f"""SELECT count(*) AS rows,
  count(DISTINCT customer_id) AS customers, count(DISTINCT snapshot_month) AS months,
  {whole(30)} AS columns, {rnd(f'avg({TARGET})', 6)} AS target_rate,
  CAST(sum({NULLS_IN_PANEL}) AS BIGINT) AS missing_values FROM panel"""),
    "panel_roundtrip": statement("panel", f"SELECT {PANEL_COLUMNS} FROM panel"),
    "features_scores": features(
        "relationship_depth_score, relationship_health_score, value_at_risk_index"),
    "features_flags": features(
        "digital_inactivity_flag, engagement_decline_flag, high_service_friction_flag, "
        "low_satisfaction_flag"),
    "features_credit_stress": features("days_past_due_band, credit_stress_score"),
    "temporal_split": features("data_split"),
    "feature_table": statement("features", f"SELECT {', '.join(FEATURE_TABLE)} FROM features"),
    "features_roundtrip": statement("features", f"SELECT {', '.join(FEATURE_TABLE)} FROM features"),
    "feature_summary": statement("features", f"""SELECT count(*) AS rows,
  count(DISTINCT customer_id) AS customers, count(DISTINCT snapshot_month) AS months,
  {whole(39)} AS columns, {whole(35)} AS features, {whole(31)} AS numeric_features,
  {whole(4)} AS categorical_features, {rnd(f'avg({TARGET})', 6)} AS target_rate,
  CAST(sum({NULLS_IN_FEATURES}) AS BIGINT) AS missing_values,
  count(*) FILTER (data_split = 'train') AS train_rows,
  count(*) FILTER (data_split = 'validation') AS validation_rows,
  count(*) FILTER (data_split = 'test') AS test_rows FROM features"""),
    "target_rate_by_split": statement("features", f"""SELECT data_split,
  {rnd(f'avg({TARGET})', 6)} AS target_rate, count(*) AS rows FROM features GROUP BY data_split"""),
    "numeric_profile": statement("features", PROFILE),
    "rules_raw_score": statement("scored", f"SELECT {KEYS}, {rnd('raw_score', 9)} AS raw_score FROM raw"),
    "rules_score": statement("scored", f"SELECT {KEYS}, rules_risk_score FROM scored"),
    "rules_decile": statement(
        "scored", f"SELECT {KEYS}, rules_risk_score, rules_risk_decile FROM ranked"),
    "decile_profile": statement("scored", f"""SELECT rules_risk_decile, count(*) AS rows,
  {rnd(f'avg({TARGET})', 6)} AS target_rate, min(rules_risk_score) AS min_score,
  max(rules_risk_score) AS max_score FROM ranked GROUP BY rules_risk_decile"""),
    "rules_pipeline": statement("scored", f"""SELECT {KEYS}, data_split, {TARGET}, {CARRIED},
  rules_risk_score, rules_risk_decile, roc_auc AS split_roc_auc
FROM ranked LEFT JOIN ({RULES_METRICS}) q ON q.split = data_split"""),
    "metrics_base": rules_metrics("split, rows, target_rate"),
    "metrics_roc_auc": rules_metrics("split, roc_auc"),
    "metrics_pr_auc": rules_metrics("split, pr_auc"),
    "metrics_brier": rules_metrics("split, brier_score"),
    "metrics_precision_at_k": rules_metrics(
        "split, precision_at_100, precision_at_500, precision_at_1000"),
    "metrics_lift_at_k": rules_metrics("split, lift_at_100, lift_at_500, lift_at_1000"),
    "metrics_rules": rules_metrics("*"),
    "metrics_custom_k": statement("scored", metric_rows(
        "scored", "rules_risk_score", "data_split", TARGET, "'train', 'test'",
        "rules_baseline_v1", (50, 100, 200))),
    "score_then_measure": statement("features", PROPENSITY_METRICS),
    "latest_snapshot": statement("panel", "SELECT max(snapshot_month) AS snapshot_month FROM panel"),
    "policy_candidates": statement("listed", f"""SELECT {KEYS}, data_split, {TARGET},
  model_v1_risk_score, model_v1_risk_decile, {CARRIED} FROM candidates"""),
    "policy_join": statement("listed", f"""SELECT {KEYS}, data_split, {TARGET},
  model_v1_risk_score, model_v1_risk_decile, {CARRIED}, digital_inactivity_flag,
  engagement_decline_flag, high_service_friction_flag, low_satisfaction_flag, credit_stress_score
FROM candidates"""),
    "policy_topk": statement("listed", f"""SELECT {KEYS}, model_v1_risk_score, value_at_risk_index
FROM candidates ORDER BY model_v1_risk_score DESC, value_at_risk_index DESC, customer_id
LIMIT (SELECT count(*) // 6 FROM customer)"""),
    "policy_reason_codes": statement("listed", f"""SELECT {KEYS},
  CASE WHEN len(reasons) >= 1 THEN reasons[1] ELSE 'high_model_risk' END AS reason_code_1,
  CASE WHEN len(reasons) >= 2 THEN reasons[2] ELSE 'portfolio_priority' END AS reason_code_2
FROM candidates"""),
    "policy_actions": statement("listed", f"SELECT {KEYS}, recommended_action FROM candidates"),
    "policy_assignment": statement("listed", f"SELECT {KEYS}, assigned_group FROM listed"),
    "policy_rank": statement("listed", f"SELECT {KEYS}, policy_rank FROM listed"),
    "intervention_list": statement("listed", f"SELECT {LIST_COLUMNS} FROM listed"),
    "intervention_summary": statement("listed", f"""SELECT count(*) AS rows,
  count(DISTINCT customer_id) AS unique_customers, {rnd(f'avg({TARGET})', 6)} AS target_rate,
  {rnd('avg(model_v1_risk_score)', 6)} AS average_risk_score,
  count(*) FILTER (assigned_group = 'treatment') AS treatment_rows,
  count(*) FILTER (assigned_group = 'control') AS control_rows,
  count(DISTINCT recommended_action) AS recommended_actions FROM listed"""),
    "ledger_ids": statement("ledger", f"SELECT treatment_log_id, policy_rank, {KEYS} FROM ledger"),
    "ledger_channel": statement(
        "ledger", f"SELECT {KEYS}, recommended_action, contact_channel FROM ledger"),
    "ledger_action_params": statement("ledger", f"""SELECT {KEYS}, recommended_action, base_contact,
  base_completion, base_effect, base_cost, contact_channel
FROM candidates JOIN actions USING (recommended_action)"""),
    "ledger_probabilities": statement("ledger", f"""SELECT {KEYS},
  p_contact AS contact_probability, p_completion AS completion_probability,
  p_effect AS effect_probability FROM ledger"""),
    "ledger_outcomes": statement("ledger", f"""SELECT {KEYS}, seen_contact_success,
  seen_treatment_completed, seen_retained FROM ledger"""),
    "ledger_windows": statement("panel", f"""SELECT {KEYS}, clicked AS contact_success,
  bought AS treatment_completed, signed AS retained FROM seen""", [seen_in("propensity")]),
    "ledger_flags": statement("ledger", f"""SELECT {KEYS}, assigned_group, contact_attempted,
  contact_success, treatment_completed, prevented_attrition_flag, {POST} FROM ledger"""),
    "ledger_economics": statement("ledger", f"""SELECT {KEYS}, intervention_cost_index,
  retained_value_index, net_value_index FROM ledger"""),
    "ledger_expected_value": statement("ledger", f"""SELECT policy_rank, {KEYS},
  recommended_action, assigned_group, {rnd('p_contact', 9)} AS contact_probability,
  {rnd('p_completion_if_contacted', 9)} AS completion_probability,
  {rnd('p_effect', 9)} AS effect_probability, {rnd(TREATED_COST, 9)} AS expected_cost,
  {rnd(TREATED_VALUE, 9)} AS expected_retained_value,
  {rnd(f'{TREATED_VALUE} - {TREATED_COST}', 9)} AS expected_net_value FROM ledger"""),
    "treatment_ledger": statement("ledger", f"SELECT {LEDGER_COLUMNS} FROM ledger"),
    "ledger_summary": statement("ledger", f"""SELECT count(*) AS rows,
  count(*) FILTER (assigned_group = 'treatment') AS treatment_rows,
  count(*) FILTER (assigned_group = 'control') AS control_rows,
  {rnd(f'avg({TARGET})', 6)} AS pre_intervention_target_rate,
  {rnd(f'avg({POST})', 6)} AS post_intervention_target_rate,
  {rnd("coalesce(avg(contact_success) FILTER (treated AND contact_attempted = 1), 0e0)", 6)}
    AS contact_success_rate,
  {rnd("coalesce(avg(treatment_completed) FILTER (treated), 0e0)", 6)} AS treatment_completion_rate,
  CAST(sum(prevented_attrition_flag) AS BIGINT) AS prevented_attrition_count,
  {rnd('sum(intervention_cost_index)', 6)} AS total_intervention_cost_index,
  {rnd('sum(retained_value_index)', 6)} AS total_retained_value_index,
  {rnd('sum(net_value_index)', 6)} AS total_net_value_index FROM ledger"""),
    "model_v1_design": statement("features", f"""SELECT data_split, count(*) AS rows,
  {whole('31 + (SELECT count(DISTINCT age_band) + count(DISTINCT region_type) + count(DISTINCT relationship_segment) + count(DISTINCT days_past_due_band) FROM features WHERE data_split = $$train$$)')}
    AS design_width,
  {rnd('sum(' + ' + '.join(NUMERIC) + ' + 4)', 2)} AS design_total
FROM features GROUP BY data_split"""),
    "split_presence": statement("features", f"""SELECT
  max({bit("data_split = 'train'")}) AS has_train,
  max({bit("data_split = 'validation'")}) AS has_validation,
  max({bit("data_split = 'test'")}) AS has_test FROM features"""),
    "model_v1_contract": statement("features", contract("features", "data_split", TARGET)),
    "model_v2_contract": statement("learning", contract("learning", "treatment_learning_split", POST)),
    "learning_table": statement("learning", f"""SELECT {LEDGER_PART}, {', '.join(FEATURES)},
  assigned_treatment_flag, treatment_learning_split FROM learning"""),
    "learning_null_audit": statement("learning", f"""SELECT count(*) AS rows,
  CAST(sum({' + '.join(bit(f'{c} IS NULL') for c in FEATURES)}) AS BIGINT)
    AS missing_feature_cells FROM joined"""),
    "stratified_split": statement(
        "learning", f"SELECT {KEYS}, {POST}, treatment_learning_split FROM learning"),
    "comparison_normalise": statement("scored", RULES_COMPARED),
    "model_comparison": statement("learning", COMPARED),
    "audit_checks": audited("SELECT * FROM checks"),
    "audit_duplicate_keys": statement("panel", f"""SELECT CAST(sum(n) AS BIGINT) AS rows,
  CAST(sum(n - 1) AS BIGINT) AS duplicate_keys
FROM (SELECT count(*) AS n FROM panel GROUP BY {KEYS})"""),
    "audit_missing_values": statement("features", f"""SELECT count(*) AS rows,
  CAST(sum({NULLS_IN_FEATURES}) AS BIGINT) AS missing_values FROM features"""),
    "audit_row_parity": statement("scored", """SELECT (SELECT count(*) FROM scored) AS scored_rows,
  (SELECT count(*) FROM features) AS feature_rows"""),
    "audit_score_range": statement("scored", """SELECT count(*) AS rows,
  min(rules_risk_score) AS min_score, max(rules_risk_score) AS max_score,
  bool_and(rules_risk_score BETWEEN 0 AND 1) AS in_range FROM scored"""),
    "audit_group_shares": statement("listed", f"""SELECT count(*) AS rows,
  {rnd(f'''avg({bit("assigned_group = 'treatment'")})''', 6)} AS treatment_share,
  {rnd(f'''avg({bit("assigned_group = 'control'")})''', 6)} AS control_share FROM listed"""),
    "audit_net_value": statement("ledger", f"""SELECT count(*) AS rows,
  count(*) FILTER (net_value_index IS DISTINCT FROM
    {rnd('retained_value_index - intervention_cost_index', 2)}) AS mismatches FROM ledger"""),
    "audit_summary": audited(
        "SELECT severity, status, count(*) AS checks FROM checks GROUP BY severity, status"),
    "audit_failures": audited(
        "SELECT check_id, check_name, severity, details FROM checks WHERE status = 'fail'"),
    "job_tables": statement("listed", f"""SELECT table_name, 'done' AS state, rows FROM (
  SELECT unnest({PANEL_TABLES}) AS table_name, (SELECT count(*) FROM panel) AS rows
  UNION ALL SELECT unnest({LIST_TABLES}), (SELECT count(*) FROM listed)
  UNION ALL VALUES {FIXED_TABLES})"""),
    "report_metric_ranking": statement("learning", f"""SELECT
  model_family || ' | ' || model_version || ' | ' || split AS display_label,
  'ROC AUC' AS metric_name, roc_auc AS metric_value
FROM ({COMPARED}) WHERE roc_auc IS NOT NULL"""),
    "report_action_mix": statement("listed", """SELECT recommended_action, count(*) AS customers
FROM listed GROUP BY recommended_action"""),
    "report_outcome_rates": statement("ledger", " UNION ALL ".join([
        outcome_rate("Contact Attempted", "contact_attempted"),
        outcome_rate("Contact Success", "contact_success"),
        outcome_rate("Treatment Completed", "treatment_completed"),
        outcome_rate("Prevented Attrition Flag", "prevented_attrition_flag")])),
    "score_state": statement("scored", f"""SELECT data_split AS split,
  CAST(round_even(rules_risk_score * 1e6, 0) AS BIGINT) AS millionth, count(*) AS n,
  CAST(sum({TARGET}) AS BIGINT) AS hits, min(rules_risk_score) AS low, max(rules_risk_score) AS high
FROM scored GROUP BY 1, 2"""),
    "report_score_histogram": statement("scored", f"""SELECT CAST(g.bin AS INTEGER) AS bin,
  {rnd('low + g.bin * ((high - low) / 30e0)', 6)} AS lower_edge,
  {rnd('low + (g.bin + 1) * ((high - low) / 30e0)', 6)} AS upper_edge, coalesce(n, 0) AS rows
FROM (SELECT unnest(generate_series(0, 29)) AS bin) g
CROSS JOIN (SELECT min(rules_risk_score) AS low, max(rules_risk_score) AS high FROM scored)
LEFT JOIN (
  SELECT least(29, floor((rules_risk_score - l) / (h - l) * 30)) AS bin, count(*) AS n
  FROM scored, (SELECT min(rules_risk_score) AS l, max(rules_risk_score) AS h FROM scored)
  GROUP BY ALL) c ON c.bin = g.bin"""),
}

# Tables written and read back hold what was written.
for _name, _same in {
    "scored_roundtrip": "rules_decile",
    "metrics_roundtrip": "metrics_rules",
    "list_roundtrip": "intervention_list",
    "ledger_roundtrip": "treatment_ledger",
    "learning_roundtrip": "learning_table",
    "learning_presented": "learning_table",
    "comparison_roundtrip": "model_comparison",
    "checks_roundtrip": "audit_checks",
}.items():
    ORACLES[_name] = ORACLES[_same]
