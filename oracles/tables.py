"""Shared table expressions. Real literals carry an exponent so they are doubles."""

from __future__ import annotations


def clip(x: str, low: str, high: str) -> str:
    return f"(CASE WHEN ({x}) < {low} THEN {low} WHEN ({x}) > {high} THEN {high} ELSE ({x}) END)"


def rnd(x: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def index(x: str, low: str = "0e0", high: str = "100e0") -> str:
    return rnd(clip(f"CAST({x} AS DOUBLE)", low, high), 2)


def bit(condition: str) -> str:
    return f"(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def whole(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


K3 = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
B3 = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN 5 PRECEDING AND 3 PRECEDING)"
K6 = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
K12 = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
FAR = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
NEXT3 = "(PARTITION BY customer_id ORDER BY m ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)"

PANEL_COLUMNS = """customer_id, snapshot_month, customer_month_index, tenure_months, age_band,
    region_type, relationship_segment, active_products, has_savings_product, has_credit_product,
    has_digital_wallet, savings_balance_index, credit_balance_index, relationship_value_index,
    app_logins_30d, web_logins_30d, digital_transactions_30d, last_digital_activity_days,
    digital_engagement_score, digital_engagement_trend_3m, contact_attempts_90d,
    successful_contacts_90d, complaint_count_180d, average_resolution_days,
    process_friction_score, satisfaction_proxy_score, repayment_behaviour_score,
    days_past_due_band, recent_credit_application_flag, voluntary_attrition_next_90d"""
NUMERIC = [
    "customer_month_index", "tenure_months", "active_products", "has_savings_product",
    "has_credit_product", "has_digital_wallet", "savings_balance_index", "credit_balance_index",
    "relationship_value_index", "app_logins_30d", "web_logins_30d", "digital_transactions_30d",
    "last_digital_activity_days", "digital_engagement_score", "digital_engagement_trend_3m",
    "contact_attempts_90d", "successful_contacts_90d", "complaint_count_180d",
    "average_resolution_days", "process_friction_score", "satisfaction_proxy_score",
    "repayment_behaviour_score", "recent_credit_application_flag", "relationship_depth_score",
    "digital_inactivity_flag", "engagement_decline_flag", "high_service_friction_flag",
    "low_satisfaction_flag", "credit_stress_score", "relationship_health_score",
    "value_at_risk_index",
]
CATEGORICAL = ["age_band", "region_type", "relationship_segment", "days_past_due_band"]
FEATURES = NUMERIC + CATEGORICAL
FEATURE_TABLE = ["customer_id", "snapshot_month", "data_split", *FEATURES,
                 "voluntary_attrition_next_90d"]
TARGET = "voluntary_attrition_next_90d"
POST = "post_intervention_attrition_next_90d"

PANEL = f"""
order_lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
    CAST(sum({bit("l_returnflag = 'R'")}) AS BIGINT) AS n_returned,
    CAST(sum(CAST(round_even(l_quantity * 1e2, 0) AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem GROUP BY l_orderkey),
keyed_orders AS (
  SELECT o_custkey AS customer_id,
    (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS m,
    CAST(o_orderdate AS DATE) AS order_day, o_orderstatus AS status, o_orderpriority AS priority,
    CAST(round_even(o_totalprice * 1e2, 0) AS BIGINT) AS price,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_returned, 0) AS n_returned,
    coalesce(quantity, 0) AS quantity
  FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey),
activity AS (
  SELECT customer_id, m, count(*) AS n_orders, sum(n_lines) AS n_lines,
    sum(n_returned) AS n_returned, sum(quantity) AS quantity, sum(price) AS price,
    sum({bit("priority = '1-URGENT'")}) AS urgent,
    sum({bit("priority = '1-URGENT' AND status = 'F'")}) AS urgent_closed,
    sum({bit("status = 'P'")}) AS partials, max(order_day) AS last_day
  FROM keyed_orders GROUP BY customer_id, m),
dense AS (
  SELECT c_custkey AS customer_id, CAST(g.m AS INTEGER) AS m, c_acctbal, n_regionkey, c_mktsegment,
    CAST(DATE '1995-01-01' + to_months(CAST(g.m - 1 AS INTEGER)) AS DATE) AS month_start,
    coalesce(n_orders, 0) AS n_orders, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_returned, 0) AS n_returned, coalesce(quantity, 0) AS quantity,
    coalesce(price, 0) AS price, coalesce(urgent, 0) AS urgent,
    coalesce(urgent_closed, 0) AS urgent_closed, coalesce(partials, 0) AS partials, last_day
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  CROSS JOIN (SELECT unnest(generate_series(1, 80)) AS m) g
  LEFT JOIN activity a ON a.customer_id = c_custkey AND a.m = g.m),
framed AS (
  SELECT *,
    sum(n_orders) OVER {K3} AS orders3, sum(n_lines) OVER {K3} AS lines3,
    coalesce(sum(n_lines) OVER {B3}, 0) AS lines3_before,
    sum(urgent) OVER {K3} AS urgent3, sum(urgent_closed) OVER {K3} AS urgent_closed3,
    sum(n_lines) OVER {K6} AS lines6, sum(n_returned) OVER {K6} AS returned6,
    sum(quantity) OVER {K6} AS quantity6,
    sum(n_lines) OVER {K12} AS lines12, sum(price) OVER {K12} AS price12,
    sum(partials) OVER {K12} AS partials12, sum(urgent) OVER {K12} AS urgent12,
    min(CASE WHEN n_orders > 0 THEN m END) OVER {FAR} AS first_m,
    max(last_day) OVER {FAR} AS last_seen,
    coalesce(sum(n_orders) OVER {NEXT3}, 0) AS orders_next
  FROM dense),
measured AS (
  SELECT customer_id, strftime(month_start, '%Y-%m') AS snapshot_month,
    {whole('m - 11')} AS customer_month_index,
    {whole('coalesce(m - first_m, 0)')} AS tenure_months,
    CASE WHEN c_acctbal < 0 THEN '18-29' WHEN c_acctbal < 3000 THEN '30-44'
      WHEN c_acctbal < 6500 THEN '45-59' ELSE '60+' END AS age_band,
    CASE n_regionkey WHEN 1 THEN 'suburban' WHEN 2 THEN 'regional' WHEN 3 THEN 'rural'
      ELSE 'urban' END AS region_type,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'emerging' WHEN 'BUILDING' THEN 'core'
      WHEN 'HOUSEHOLD' THEN 'core' WHEN 'FURNITURE' THEN 'established'
      WHEN 'MACHINERY' THEN 'high_value' END AS relationship_segment,
    {whole(clip('lines12 // 2', '1', '7'))} AS active_products,
    {bit('c_acctbal > 0')} AS has_savings_product,
    {bit('partials12 > 0')} AS has_credit_product,
    {bit('urgent12 > 0')} AS has_digital_wallet,
    {index('(c_acctbal + 1000e0) / 110e0')} AS savings_balance_index,
    {index('CAST(price12 AS DOUBLE) / 100e0 / 15000e0')} AS credit_balance_index,
    {whole('n_lines')} AS app_logins_30d, {whole('n_orders')} AS web_logins_30d,
    {whole('lines3')} AS digital_transactions_30d,
    {whole("CASE WHEN last_seen IS NULL THEN 180 ELSE " + clip("last_day(month_start) - last_seen", "0", "180") + " END")}
      AS last_digital_activity_days,
    {index('5 * (lines3 - lines3_before)', '-50e0', '50e0')} AS digital_engagement_trend_3m,
    {whole('urgent3')} AS contact_attempts_90d,
    {whole('urgent_closed3')} AS successful_contacts_90d,
    {whole('returned6')} AS complaint_count_180d,
    CASE WHEN lines6 = 0 THEN 0e0
      ELSE {index('CAST(quantity6 AS DOUBLE) / 100e0 / (5e0 * CAST(lines6 AS DOUBLE))', '0e0', '45e0')} END
      AS average_resolution_days,
    CASE WHEN partials12 = 0 THEN 'no_credit_product' WHEN c_acctbal >= 0 THEN 'current'
      WHEN c_acctbal >= -500 THEN '1-30' WHEN c_acctbal >= -800 THEN '31-60' ELSE '61+' END
      AS days_past_due_band,
    {bit('urgent > 0')} AS recent_credit_application_flag,
    {bit('orders3 > 0 AND orders_next = 0')} AS voluntary_attrition_next_90d
  FROM framed WHERE m BETWEEN 12 AND 76),
valued AS (
  SELECT *,
    {index('55e-2 * savings_balance_index + 30e-2 * credit_balance_index + 4e0 * active_products')}
      AS relationship_value_index,
    {index('20e0 + 2e0 * app_logins_30d + 12e-1 * web_logins_30d + 17e-1 * digital_transactions_30d - 25e-2 * last_digital_activity_days')}
      AS digital_engagement_score
  FROM measured),
frictioned AS (
  SELECT *, {index('15e0 + 85e-1 * complaint_count_180d + 12e-1 * average_resolution_days + 15e-2 * last_digital_activity_days - 12e-2 * digital_engagement_score')}
      AS process_friction_score FROM valued),
satisfied AS (
  SELECT *, {index('82e0 - 55e-2 * process_friction_score - 32e-1 * complaint_count_180d + 12e-2 * digital_engagement_score + 6e-2 * relationship_value_index')}
      AS satisfaction_proxy_score FROM frictioned),
panel AS (
  SELECT *, {index('78e0 + 12e-2 * relationship_value_index + 8e-2 * satisfaction_proxy_score - 25e-2 * process_friction_score')}
      AS repayment_behaviour_score FROM satisfied),
propensity AS (
  SELECT *, {rnd(clip("1e0 / (1e0 + exp(-(-80e-2 + -20e-3 * active_products + -10e-3 * tenure_months + -11e-3 * relationship_value_index + -10e-3 * satisfaction_proxy_score + -6e-3 * repayment_behaviour_score + 20e-3 * last_digital_activity_days + 55e-3 * complaint_count_180d + 12e-3 * process_friction_score + -14e-3 * digital_engagement_trend_3m + 20e-2 * " + bit("days_past_due_band = '31-60'") + " + 42e-2 * " + bit("days_past_due_band = '61+'") + ")))", "5e-3", "65e-2"), 6)}
      AS attrition_propensity FROM panel)"""

FEATURE = f"""
month_list AS (
  SELECT snapshot_month, row_number() OVER (ORDER BY snapshot_month) AS place,
    count(*) OVER () AS n_months
  FROM (SELECT DISTINCT snapshot_month FROM panel)),
month_splits AS (
  SELECT snapshot_month, CASE WHEN place <= floor(n_months * 70e-2) THEN 'train'
    WHEN place <= floor(n_months * 85e-2) THEN 'validation' ELSE 'test' END AS data_split
  FROM month_list),
flagged AS (
  SELECT *,
    {index('12e0 * active_products + 25e-2 * tenure_months + 20e-2 * relationship_value_index')}
      AS relationship_depth_score,
    {bit('last_digital_activity_days >= 45')} AS digital_inactivity_flag,
    {bit('digital_engagement_trend_3m <= -10')} AS engagement_decline_flag,
    {bit('process_friction_score >= 60')} AS high_service_friction_flag,
    {bit('satisfaction_proxy_score <= 45')} AS low_satisfaction_flag,
    CASE days_past_due_band WHEN 'current' THEN 5 WHEN '1-30' THEN 25 WHEN '31-60' THEN 55
      WHEN '61+' THEN 85 ELSE 0 END AS credit_stress_score
  FROM propensity),
healthy AS (
  SELECT *, {index('30e-2 * relationship_depth_score + 25e-2 * digital_engagement_score + 25e-2 * satisfaction_proxy_score + 20e-2 * repayment_behaviour_score - 30e-2 * process_friction_score - 15e-2 * credit_stress_score')}
      AS relationship_health_score FROM flagged),
features AS (
  SELECT h.*, data_split, {index('relationship_value_index * (100e0 - relationship_health_score) / 100e0')}
      AS value_at_risk_index
  FROM healthy h JOIN month_splits USING (snapshot_month))"""

SCORED = f"""
raw AS (
  SELECT *, 22e-2 * digital_inactivity_flag + 17e-2 * engagement_decline_flag
    + 16e-2 * high_service_friction_flag + 14e-2 * low_satisfaction_flag
    + 12e-2 * (credit_stress_score / 100e0) + 11e-2 * (process_friction_score / 100e0)
    + 9e-2 * ({clip('last_digital_activity_days', '0', '180')} / 180e0)
    + 9e-2 * (value_at_risk_index / 100e0)
    + 7e-2 * ({clip('complaint_count_180d', '0', '5')} / 5e0)
    + -12e-2 * (relationship_health_score / 100e0) + -8e-2 * (relationship_depth_score / 100e0)
    AS raw_score
  FROM features),
raw_range AS (SELECT min(raw_score) AS low, max(raw_score) AS high FROM raw),
scored AS (
  SELECT raw.*, CASE WHEN low = high THEN 5e-1
    ELSE {rnd('(raw_score - low) / (high - low)', 6)} END AS rules_risk_score
  FROM raw, raw_range),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY rules_risk_score, customer_id, snapshot_month) AS place,
    count(*) OVER () AS n_rows
  FROM scored),
ranked AS (
  SELECT *, {whole('CASE WHEN n_rows = 1 THEN 1 ELSE greatest(1, ((place - 1) * 10 + n_rows - 2) // (n_rows - 1)) END')}
      AS rules_risk_decile
  FROM numbered)"""

CARRIED = "relationship_value_index, value_at_risk_index, relationship_health_score"
POLICY_FLAGS = """digital_inactivity_flag, engagement_decline_flag, high_service_friction_flag,
    low_satisfaction_flag, credit_stress_score"""

LISTED = f"""
places AS (SELECT {whole('count(*) // 6')} AS capacity FROM customer),
candidates AS (
  SELECT customer_id, snapshot_month, data_split, voluntary_attrition_next_90d,
    rules_risk_score AS model_v1_risk_score, rules_risk_decile AS model_v1_risk_decile,
    {CARRIED}, {POLICY_FLAGS},
    list_filter([CASE WHEN digital_inactivity_flag = 1 THEN 'digital_inactivity' END,
      CASE WHEN engagement_decline_flag = 1 THEN 'declining_engagement' END,
      CASE WHEN high_service_friction_flag = 1 THEN 'service_friction' END,
      CASE WHEN low_satisfaction_flag = 1 THEN 'low_satisfaction' END,
      CASE WHEN credit_stress_score >= 55 THEN 'credit_stress' END,
      CASE WHEN relationship_health_score <= 45 THEN 'weak_relationship_health' END,
      CASE WHEN value_at_risk_index >= 40 THEN 'high_value_at_risk' END],
      lambda x: x IS NOT NULL) AS reasons,
    CASE WHEN high_service_friction_flag + low_satisfaction_flag > 0 THEN 'service_recovery_case'
      WHEN credit_stress_score >= 55 THEN 'financial_wellbeing_check'
      WHEN digital_inactivity_flag + engagement_decline_flag > 0 THEN 'digital_reactivation_nudge'
      WHEN value_at_risk_index >= 40 THEN 'relationship_call'
      ELSE 'relationship_check_in' END AS recommended_action
  FROM ranked WHERE snapshot_month = (SELECT max(snapshot_month) FROM ranked)),
selected AS (
  SELECT *, row_number() OVER (ORDER BY model_v1_risk_score DESC, value_at_risk_index DESC,
      customer_id) AS policy_rank
  FROM candidates),
drawn AS (
  SELECT *, row_number() OVER (ORDER BY md5('42|' || customer_id || '|treat'), customer_id) AS draw,
    count(*) OVER () AS n_listed
  FROM selected WHERE policy_rank <= (SELECT capacity FROM places)),
listed AS (
  SELECT policy_rank, customer_id, snapshot_month, data_split, 'ml_model_v1' AS model_version,
    voluntary_attrition_next_90d, model_v1_risk_score, model_v1_risk_decile, {CARRIED},
    {POLICY_FLAGS}, coalesce(reasons[1], 'high_model_risk') AS reason_code_1,
    coalesce(reasons[2], 'portfolio_priority') AS reason_code_2, recommended_action,
    CASE WHEN draw <= round_even(n_listed * 80e-2, 0) THEN 'treatment' ELSE 'control' END
      AS assigned_group,
    (SELECT capacity FROM places) AS intervention_capacity, 80e-2 AS treatment_share,
    20e-2 AS control_share
  FROM drawn)"""



def seen_in(rows: str) -> str:
    """Outcomes of each row from its user's events in the 90 days after its month; the events'
    clock is 8,308 days late."""
    return f"""seen AS (
  SELECT customer_id, snapshot_month, max({bit("event_type = 'click'")}) AS clicked,
    max({bit("event_type = 'purchase'")}) AS bought, max({bit("event_type = 'signup'")}) AS signed
  FROM (SELECT customer_id, snapshot_month, customer_id % (SELECT max(user_id) + 1 FROM events) AS user_id,
      CAST(snapshot_month || '-01' AS DATE) + INTERVAL 1 MONTH AS opens FROM {rows}) r
  JOIN (SELECT user_id, event_type, ts - INTERVAL 8308 DAY AS ts FROM events) e USING (user_id)
  WHERE event_type IN ('click', 'purchase', 'signup') AND ts >= opens AND ts < opens + INTERVAL 90 DAY
  GROUP BY customer_id, snapshot_month)"""


LEDGER = f"""
{seen_in("listed")},
actions(recommended_action, base_contact, base_completion, base_effect, base_cost, contact_channel)
AS (VALUES
  ('digital_reactivation_nudge', 72e-2, 64e-2, 22e-2, 15e-1, 'in_app_message'),
  ('relationship_check_in', 62e-2, 56e-2, 18e-2, 3e0, 'email_or_phone'),
  ('service_recovery_case', 58e-2, 52e-2, 28e-2, 5e0, 'specialist_call'),
  ('financial_wellbeing_check', 55e-2, 48e-2, 24e-2, 6e0, 'advisory_call'),
  ('relationship_call', 50e-2, 46e-2, 20e-2, 4e0, 'relationship_manager_call')),
observed AS (
  SELECT l.*, base_contact, base_completion, base_effect, base_cost, contact_channel,
    printf('TLOG-%06d', policy_rank) AS treatment_log_id,
    coalesce(clicked, 0) AS seen_contact_success, coalesce(bought, 0) AS seen_treatment_completed,
    coalesce(signed, 0) AS seen_retained, assigned_group = 'treatment' AS treated
  FROM listed l JOIN actions USING (recommended_action)
  LEFT JOIN seen USING (customer_id, snapshot_month)),
gated AS (
  SELECT *, {bit('treated')} AS contact_attempted,
    {bit('treated AND seen_contact_success = 1')} AS contact_success,
    {bit('treated AND seen_contact_success = 1 AND seen_treatment_completed = 1')}
      AS treatment_completed,
    {bit('treated AND seen_contact_success = 1 AND seen_treatment_completed = 1 AND seen_retained = 1 AND ' + TARGET + ' = 1')}
      AS prevented_attrition_flag
  FROM observed),
costed AS (
  SELECT *, {TARGET} - prevented_attrition_flag AS {POST},
    {rnd('CASE WHEN treated THEN base_cost * (CASE WHEN treatment_completed = 1 THEN 135e-2 ELSE 1e0 END) ELSE 0e0 END', 2)}
      AS intervention_cost_index,
    {rnd('prevented_attrition_flag * relationship_value_index', 2)} AS retained_value_index
  FROM gated),
ledger AS (
  SELECT *, {rnd('retained_value_index - intervention_cost_index', 2)} AS net_value_index,
    {clip('base_contact + 10e-2 * (1e0 - model_v1_risk_score) - 5e-2 * value_at_risk_index / 100e0', '5e-2', '95e-2')}
      AS p_contact,
    {clip('base_completion + 8e-2 * contact_success - 4e-2 * model_v1_risk_score', '5e-2', '90e-2')}
      AS p_completion,
    {clip('base_completion + 8e-2 * 1e0 - 4e-2 * model_v1_risk_score', '5e-2', '90e-2')}
      AS p_completion_if_contacted,
    {clip("base_effect + (CASE WHEN reason_code_1 IN ('service_friction', 'low_satisfaction', 'digital_inactivity') THEN 5e-2 ELSE 0e0 END) + 5e-2 * (relationship_value_index / 100e0)", '0e0', '45e-2')}
      AS p_effect
  FROM costed)"""

LEDGER_PART = f"""treatment_log_id, policy_rank, customer_id, snapshot_month, assigned_group,
    recommended_action, contact_channel, reason_code_1, reason_code_2, model_v1_risk_score,
    contact_attempted, contact_success, treatment_completed, intervention_cost_index, {POST}"""

# Quotas: the floor of the proportional share, then the largest remainders, by class.
LEARNING = f"""
joined AS (
  SELECT {', '.join('g.' + c.strip() for c in LEDGER_PART.split(','))},
    {', '.join('f.' + c for c in FEATURES)},
    {bit("assigned_group = 'treatment'")} AS assigned_treatment_flag
  FROM ledger g LEFT JOIN features f USING (customer_id, snapshot_month)),
classes AS (
  SELECT {POST} AS class, count(*) AS size, sum(count(*)) OVER () AS n FROM joined GROUP BY ALL),
test_exact AS (SELECT *, ceil(20e-2 * n) AS wanted, size * ceil(20e-2 * n) / n AS exact FROM classes),
test_quota AS (
  SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, class)
      <= wanted - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS n_test
  FROM test_exact),
rest AS (SELECT class, n_test, size - n_test AS rest_size, n - wanted AS rest_n FROM test_quota),
val_exact AS (
  SELECT *, ceil(25e-2 * rest_n) AS wanted, rest_size * ceil(25e-2 * rest_n) / rest_n AS exact
  FROM rest),
quotas AS (
  SELECT class, n_test, floor(exact) + CASE WHEN row_number() OVER
      (ORDER BY exact - floor(exact) DESC, class) <= wanted - sum(floor(exact)) OVER ()
      THEN 1 ELSE 0 END AS n_validation
  FROM val_exact),
learning AS (
  SELECT j.* EXCLUDE (place), CASE WHEN place <= n_test THEN 'test'
    WHEN place <= n_test + n_validation THEN 'validation' ELSE 'train' END
    AS treatment_learning_split
  FROM (SELECT *, row_number() OVER (PARTITION BY {POST}
      ORDER BY md5('42|' || customer_id || '|learn'), customer_id) AS place FROM joined) j
  JOIN quotas ON class = {POST})"""

STAGES = {
    "panel": [PANEL],
    "features": [PANEL, FEATURE],
    "scored": [PANEL, FEATURE, SCORED],
    "listed": [PANEL, FEATURE, SCORED, LISTED],
    "ledger": [PANEL, FEATURE, SCORED, LISTED, LEDGER],
    "learning": [PANEL, FEATURE, SCORED, LISTED, LEDGER, LEARNING],
}


def statement(upto: str, select: str, extra: list[str] = ()) -> str:
    return "WITH " + ",".join([*STAGES[upto], *extra]) + "\n" + select
