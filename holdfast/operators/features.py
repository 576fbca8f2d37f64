"""Model-ready feature table with a time-ordered train/validation/test split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import flag, index, ratio
from holdfast.operators.panel import missing_cells
from holdfast.operators.quantiles import exact_quantiles, one_row
from holdfast.operators.summary import totals
from holdfast.schema import (
    CATEGORICAL_FEATURES,
    CUSTOMER,
    FEATURE_TABLE_COLUMNS,
    FEATURES,
    MONTH,
    NUMERIC_FEATURES,
    PANEL_COLUMNS,
    SPLIT,
    SPLITS,
    TARGET,
    require_columns,
)
from holdfast.sources.staging import stage

# Thresholds of the behaviour flags.
INACTIVE_DAYS = 45
DECLINE_TREND = -10
HIGH_FRICTION = 60
LOW_SATISFACTION = 45
# Credit stress points by past-due band; any other band scores 0.
STRESS_POINTS = {"no_credit_product": 0, "current": 5, "1-30": 25, "31-60": 55, "61+": 85}
# Cumulative month shares at which validation and test begin.
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.85


def credit_stress(band: Column) -> Column:
    points = F.when(F.lit(False), 0)
    for label, value in STRESS_POINTS.items():
        points = points.when(band == label, value)
    return points.otherwise(0)


def derive_features(panel: DataFrame) -> DataFrame:
    """Add depth, flags, stress, health and value at risk to the panel."""
    c = F.col
    first = panel.withColumns(
        {
            "relationship_depth_score": index(
                12.0 * c("active_products")
                + 0.25 * c("tenure_months")
                + 0.20 * c("relationship_value_index")
            ),
            "digital_inactivity_flag": flag(c("last_digital_activity_days") >= INACTIVE_DAYS),
            "engagement_decline_flag": flag(c("digital_engagement_trend_3m") <= DECLINE_TREND),
            "high_service_friction_flag": flag(c("process_friction_score") >= HIGH_FRICTION),
            "low_satisfaction_flag": flag(c("satisfaction_proxy_score") <= LOW_SATISFACTION),
            "credit_stress_score": credit_stress(c("days_past_due_band")),
        }
    )
    health = index(
        0.30 * c("relationship_depth_score")
        + 0.25 * c("digital_engagement_score")
        + 0.25 * c("satisfaction_proxy_score")
        + 0.20 * c("repayment_behaviour_score")
        - 0.30 * c("process_friction_score")
        - 0.15 * c("credit_stress_score")
    )
    at_risk = index(
        c("relationship_value_index") * (100.0 - c("relationship_health_score")) / 100.0
    )
    return first.withColumn("relationship_health_score", health).withColumn(
        "value_at_risk_index", at_risk
    )


def split_starts(months: list[str]) -> tuple[str, str]:
    """First validation month and first test month of an ordered month list."""
    ordered = sorted(set(months))
    n = len(ordered)
    if n < 4:
        raise ValueError(f"a time split needs at least four snapshot months, got {n}")
    train = max(1, math.floor(n * TRAIN_SHARE))
    validation = min(max(train + 1, math.floor(n * VALIDATION_SHARE)), n - 1)
    return ordered[train], ordered[validation]


def add_temporal_split(df: DataFrame, months: list[str] | None = None) -> DataFrame:
    """Label rows train, validation or test by month.

    ``months`` are the snapshot months of the table; a panel built from a month range
    knows them. Without it they are read from the data, one value per month.
    """
    if months is None:
        months = [row[0] for row in df.select(MONTH).distinct().collect()]
    validation, test = split_starts(months)
    month = F.col(MONTH)
    train_, validation_, test_ = SPLITS
    return df.withColumn(
        SPLIT,
        F.when(month < validation, train_).when(month < test, validation_).otherwise(test_),
    )


def build_feature_table(panel: DataFrame, months: list[str] | None = None) -> DataFrame:
    """Keys, split, 35 features and the target."""
    require_columns(panel, PANEL_COLUMNS, "panel")
    return add_temporal_split(derive_features(panel), months).select(*FEATURE_TABLE_COLUMNS)


def summarise_features(features: DataFrame) -> DataFrame:
    """One row of diagnostics, feature counts and rows per split included."""
    require_columns(features, FEATURE_TABLE_COLUMNS, "feature table")
    counted = totals(
        features,
        {
            "positives": F.col(TARGET),
            "labelled": flag(F.col(TARGET).isNotNull()),
            "missing_values": missing_cells(features),
            **{f"{s}_rows": flag(F.col(SPLIT) == s) for s in SPLITS},
        },
    )
    return counted.select(
        "rows", "customers", "months",
        F.lit(len(features.columns)).alias("columns"),
        F.lit(len(FEATURES)).alias("features"),
        F.lit(len(NUMERIC_FEATURES)).alias("numeric_features"),
        F.lit(len(CATEGORICAL_FEATURES)).alias("categorical_features"),
        ratio(F.col("positives"), F.col("labelled")).alias("target_rate"),
        "missing_values",
        *[f"{s}_rows" for s in SPLITS],
    )


def target_rate_by_split(features: DataFrame) -> DataFrame:
    return features.groupBy(SPLIT).agg(
        F.avg(TARGET).alias("target_rate"), F.count(F.lit(1)).alias("rows")
    )


PROFILE_SCHEMA = (
    "column_name string, count bigint, mean double, std double, min double, "
    "p25 double, p50 double, p75 double, max double"
)


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column.

    All columns are measured side by side over one staged copy of them: one pass for the
    moments, a few more for the quartiles (``quantiles.exact_quantiles``). Quartiles are exact,
    interpolated between neighbours. Columns without a value have no row.
    """
    require_columns(df, columns, "profiled table")
    table = stage(df.select(*[F.col(name).cast("double").alias(name) for name in columns]), "profile")
    measures = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    moments = one_row(table, {n: [of(n).cast("double") for of in measures] for n in columns})
    rows = {name: int(found[0]) for name, found in moments.items()}
    quartiles = exact_quantiles(table, (0.25, 0.5, 0.75), rows)
    profile = [
        (name, rows[name], mean, std, least, *quartiles[name], most)
        for name, (_, mean, std, least, most) in moments.items() if rows[name]
    ]
    return df.sparkSession.createDataFrame(profile, PROFILE_SCHEMA)
