"""Table layouts and the column check every operator runs on its inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CUSTOMER = "customer_id"
MONTH = "snapshot_month"
KEYS = (CUSTOMER, MONTH)
TARGET = "voluntary_attrition_next_90d"
SPLIT = "data_split"
SPLITS = ("train", "validation", "test")
SEED = 42

# Column names and order of the customer-month panel.
PANEL_DDL = """
    customer_id BIGINT, snapshot_month STRING, customer_month_index INT, tenure_months INT,
    age_band STRING, region_type STRING, relationship_segment STRING, active_products INT,
    has_savings_product INT, has_credit_product INT, has_digital_wallet INT,
    savings_balance_index DOUBLE, credit_balance_index DOUBLE, relationship_value_index DOUBLE,
    app_logins_30d INT, web_logins_30d INT, digital_transactions_30d INT,
    last_digital_activity_days INT, digital_engagement_score DOUBLE,
    digital_engagement_trend_3m DOUBLE, contact_attempts_90d INT, successful_contacts_90d INT,
    complaint_count_180d INT, average_resolution_days DOUBLE, process_friction_score DOUBLE,
    satisfaction_proxy_score DOUBLE, repayment_behaviour_score DOUBLE, days_past_due_band STRING,
    recent_credit_application_flag INT, voluntary_attrition_next_90d INT
"""
# Columns the feature build adds to the panel.
DERIVED_DDL = """
    relationship_depth_score DOUBLE, digital_inactivity_flag INT, engagement_decline_flag INT,
    high_service_friction_flag INT, low_satisfaction_flag INT, credit_stress_score INT,
    relationship_health_score DOUBLE, value_at_risk_index DOUBLE
"""

_DDL_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
}


def struct(ddl: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; unlike Spark's parser it needs no session."""
    pairs = [pair.split() for pair in ddl.split(",")]
    return T.StructType([T.StructField(name, _DDL_TYPES[kind]) for name, kind in pairs])


PANEL_SCHEMA = struct(PANEL_DDL)
DERIVED_SCHEMA = struct(DERIVED_DDL)
PANEL_COLUMNS = PANEL_SCHEMA.fieldNames()
DERIVED_COLUMNS = DERIVED_SCHEMA.fieldNames()

_MEASURES = [f for f in PANEL_SCHEMA if f.name not in (*KEYS, TARGET)]
CATEGORICAL_FEATURES = [f.name for f in _MEASURES if isinstance(f.dataType, T.StringType)]
NUMERIC_FEATURES = [
    f.name for f in _MEASURES if not isinstance(f.dataType, T.StringType)
] + DERIVED_COLUMNS
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

_TYPES = {f.name: f.dataType for f in (*PANEL_SCHEMA, *DERIVED_SCHEMA)}
_TYPES[SPLIT] = T.StringType()
FEATURE_TABLE_COLUMNS = [*KEYS, SPLIT, *FEATURES, TARGET]
FEATURE_TABLE_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES[name]) for name in FEATURE_TABLE_COLUMNS]
)

# The three indexes every scored table carries along with its keys.
CARRIED_INDEXES = (
    "relationship_value_index",
    "value_at_risk_index",
    "relationship_health_score",
)


def require_columns(df: DataFrame, names: Iterable[str], label: str) -> None:
    """Raise ``ValueError`` naming, in order, the columns ``df`` lacks. Runs no job."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks required columns: {missing}")
