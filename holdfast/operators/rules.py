"""Transparent rules score: the benchmark every trained model is compared with."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import clip, round_even, total
from holdfast.operators.metrics import decile_and_measure, evaluate_scores
from holdfast.operators.ranking import assign_deciles
from holdfast.operators.scorestate import ScoreState
from holdfast.schema import CARRIED_INDEXES, KEYS, SPLIT, TARGET, require_columns
from holdfast.sources.staging import stage

RULES_VERSION = "rules_baseline_v1"
RULES_SCORE = "rules_risk_score"
RULES_DECILE = "rules_risk_decile"

# Weight, input column, divisor, upper bound of the input.
RULE_TERMS = (
    (0.22, "digital_inactivity_flag", 1, None),
    (0.17, "engagement_decline_flag", 1, None),
    (0.16, "high_service_friction_flag", 1, None),
    (0.14, "low_satisfaction_flag", 1, None),
    (0.12, "credit_stress_score", 100, None),
    (0.11, "process_friction_score", 100, None),
    (0.09, "last_digital_activity_days", 180, 180),
    (0.09, "value_at_risk_index", 100, None),
    (0.07, "complaint_count_180d", 5, 5),
    (-0.12, "relationship_health_score", 100, None),
    (-0.08, "relationship_depth_score", 100, None),
)
RULE_INPUTS = tuple(name for _, name, _, _ in RULE_TERMS)
RULES_COLUMNS = tuple(dict.fromkeys((*KEYS, SPLIT, TARGET, *CARRIED_INDEXES, *RULE_INPUTS)))


@dataclass(frozen=True)
class RulesResult:
    scored_table: DataFrame
    metrics: DataFrame
    state: ScoreState
    score_column: str = RULES_SCORE
    model_version: str = RULES_VERSION


def raw_rules_score() -> Column:
    """Weighted sum of the eleven rule inputs."""
    terms = []
    for weight, name, divisor, bound in RULE_TERMS:
        value = F.col(name) if bound is None else clip(F.col(name), 0, bound)
        if divisor != 1:
            value = value / F.lit(float(divisor))
        terms.append(F.lit(weight) * value)
    return total(terms)


def score_range(features: DataFrame, fit_on: Column | None = None) -> tuple[float, float]:
    """Smallest and largest raw score, one row from one aggregation."""
    source = features if fit_on is None else features.where(fit_on)
    low, high = source.agg(F.min(raw_rules_score()), F.max(raw_rules_score())).first()
    return low, high


def scaled_rules_score(bounds: tuple[float, float]) -> Column:
    """Raw score scaled to 0-1 at six decimals; 0.5 where all raw scores are equal."""
    low, high = bounds
    if low is None or low == high:
        return F.lit(0.5)
    scaled = (raw_rules_score() - F.lit(low)) / F.lit(high - low)
    return round_even(clip(scaled, 0.0, 1.0), 6)


def score_rules(features: DataFrame, fit_on: Column | None = None) -> DataFrame:
    """Keys, split, target, carried indexes and the rules score."""
    require_columns(features, RULES_COLUMNS, "feature table")
    return features.select(
        *KEYS, SPLIT, TARGET, *CARRIED_INDEXES,
        scaled_rules_score(score_range(features, fit_on)).alias(RULES_SCORE),
    )


def score_with_rules(features: DataFrame, fit_on: Column | None = None) -> DataFrame:
    """Rules score and decile. The scale and the decile cuts come from all rows, or from
    the rows matching ``fit_on`` when later months must not influence them.

    The scores are staged, so that the passes behind the deciles read one narrow column
    instead of computing the score again from all its inputs.
    """
    scores = stage(score_rules(features, fit_on), "rules-scores")
    return assign_deciles(scores, RULES_SCORE, RULES_DECILE, fit_on=fit_on)


def evaluate_rules(scored: DataFrame, **options) -> DataFrame:
    return evaluate_scores(scored, RULES_SCORE, RULES_VERSION, **options)


def run_rules(features: DataFrame) -> RulesResult:
    """Scores, deciles and metrics from two passes over the staged scores."""
    scores = stage(score_rules(features), "rules-scores")
    scored, metrics, state = decile_and_measure(scores, RULES_SCORE, RULES_DECILE, RULES_VERSION)
    return RulesResult(scored, metrics, state)
