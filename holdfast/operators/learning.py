"""Boosted-tree classifiers: the risk model and the ledger-aware model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.numeric import flag, keyed_digest, keyed_uniform, round_even, total
from holdfast.operators.boosting import BoostedTreesModel, GBTClassifier
from holdfast.operators.joins import checked_left_join
from holdfast.operators.ledger import POST_TARGET
from holdfast.operators.metrics import K_VALUES_LEDGER, decile_and_measure, evaluate_scores
from holdfast.operators.policy import MODEL_V1_DECILE, MODEL_V1_SCORE, MODEL_V1_VERSION
from holdfast.operators.ranking import assign_deciles, number_rows
from holdfast.operators.scorestate import ScoreState
from holdfast.schema import (
    CARRIED_INDEXES,
    CATEGORICAL_FEATURES,
    CUSTOMER,
    FEATURES,
    KEYS,
    NUMERIC_FEATURES,
    SEED,
    SPLIT,
    SPLITS,
    TARGET,
    require_columns,
)
from holdfast.sources.staging import stage

MODEL_V2_VERSION = "treatment_aware_ml_model_v2"
LEARNING_SPLIT = "treatment_learning_split"
MODEL_V2_SCORE = "model_v2_post_intervention_risk_score"
MODEL_V2_DECILE = "model_v2_risk_decile"

# Ledger columns of the learning table, ledger features of model v2.
LEDGER_PART = (
    "treatment_log_id", "policy_rank", *KEYS, "assigned_group", "recommended_action",
    "contact_channel", "reason_code_1", "reason_code_2", MODEL_V1_SCORE, "contact_attempted",
    "contact_success", "treatment_completed", "intervention_cost_index", POST_TARGET,
)
LEDGER_NUMERIC = (
    MODEL_V1_SCORE, "contact_attempted", "contact_success", "treatment_completed",
    "intervention_cost_index", "assigned_treatment_flag",
)
LEDGER_CATEGORICAL = (
    "assigned_group", "recommended_action", "contact_channel", "reason_code_1", "reason_code_2",
)
# Columns model v2 scores carry.
V2_SCORED_COLUMNS = (
    "treatment_log_id", "policy_rank", *KEYS, LEARNING_SPLIT, "assigned_group",
    "recommended_action", "contact_channel", POST_TARGET, MODEL_V1_SCORE, "contact_attempted",
    "contact_success", "treatment_completed", "intervention_cost_index",
)
# Test share of all rows, validation share of the remaining rows.
TEST_SHARE = 0.20
VALIDATION_SHARE = 0.25


@dataclass(frozen=True)
class BoostingSpec:
    """Boosting parameters; depth d grows about 2**d leaves.

    A keyed share of the training rows is held out, and boosting stops once its loss has
    not fallen by ``tolerance`` for ``patience`` rounds.
    """

    step: float
    rounds: int
    depth: int
    holdout: float
    patience: int
    tolerance: float = 1e-7
    bins: int = 255
    least_rows: int = 20
    seed: int = SEED


# Learning rate, rounds, leaves (as depth), hold-out share and patience.
V1_BOOSTING = BoostingSpec(step=0.06, rounds=160, depth=5, holdout=0.12, patience=15)
V2_BOOSTING = BoostingSpec(step=0.05, rounds=120, depth=4, holdout=0.15, patience=12)


@dataclass(frozen=True)
class ModelResult:
    model: PipelineModel
    scored_table: DataFrame
    metrics: DataFrame
    score_column: str
    model_version: str
    learning_table: DataFrame | None = None
    state: ScoreState | None = None


def split_presence(features: DataFrame, split_column: str = SPLIT) -> DataFrame:
    """One row: which of the three splits have rows."""
    return features.agg(
        *[F.coalesce(F.max(flag(F.col(split_column) == s)), F.lit(0)).alias(f"has_{s}")
          for s in SPLITS]
    )


def require_splits(features: DataFrame, split_column: str = SPLIT) -> None:
    found = split_presence(features, split_column).first()
    missing = [s for s in SPLITS if not found[f"has_{s}"]]
    if missing:
        raise ValueError(f"training needs rows in every split; none in {missing}")


def design_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Numeric columns as they are, categories one-hot; an unseen category encodes as zeros.

    ``keep`` gives unseen values the last index, and the encoder drops the last one.
    """
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_onehot" for c in categorical]
    return [
        StringIndexer(
            inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="design"),
    ]


def rounds_to_keep(losses: Sequence[float], spec: BoostingSpec) -> int:
    """The round after which the loss has not fallen for ``patience`` rounds, or all."""
    for last in range(spec.patience, len(losses)):
        reference = losses[last - spec.patience] - spec.tolerance
        if not any(loss < reference for loss in losses[last - spec.patience + 1 : last + 1]):
            return last + 1
    return len(losses)


def first_rounds(model: BoostedTreesModel, rounds: int) -> BoostedTreesModel:
    """The model as it was after ``rounds`` rounds: its first trees. Each round adds a tree and
    changes none before it, so a fit of that many rounds gives the same ones."""
    return BoostedTreesModel(model.design, model.grown[:rounds])


def fit_on_train(
    table: DataFrame, split_column: str, numeric: Sequence[str], categorical: Sequence[str],
    target: str, spec: BoostingSpec,
) -> PipelineModel:
    """Fit on the train rows, a keyed share of them held out to find the number of rounds.

    The loss of the held-out rows after each round tells where to stop; no round is fitted
    behind the one at which patience ends, and the trees up to there are the model.
    """
    key = F.concat_ws("|", *KEYS)
    train = table.where(F.col(split_column) == "train").select(
        *numeric, *categorical, target,
        (keyed_uniform(spec.seed, key, "holdout") < spec.holdout).alias("held_out"),
    )
    boosting = GBTClassifier(numeric, categorical, target, spec)
    model, losses = boosting.fit(train, lambda losses: rounds_to_keep(losses, spec) < len(losses))
    if losses:
        model = first_rounds(model, rounds_to_keep(losses, spec))
    return PipelineModel(stages=[model])


def score_rows(
    model: PipelineModel, table: DataFrame, carried: Sequence[str], score: str
) -> DataFrame:
    """Carried columns and the probability of the positive class at six decimals."""
    scored = model.stages[-1].scored(table, carried)
    return scored.select(*carried, round_even(F.col("probability"), 6).alias(score))


def model_v1_design(features: DataFrame) -> DataFrame:
    """Keys, split, target and the design vector of model v1."""
    stages = Pipeline(stages=design_stages(NUMERIC_FEATURES, CATEGORICAL_FEATURES))
    fitted = stages.fit(features.where(F.col(SPLIT) == "train"))
    return fitted.transform(features).select(*KEYS, SPLIT, TARGET, "design")


def train_model_v1(features: DataFrame, spec: BoostingSpec = V1_BOOSTING) -> PipelineModel:
    require_columns(features, [*KEYS, SPLIT, TARGET, *FEATURES], "feature table")
    require_splits(features)
    return fit_on_train(features, SPLIT, NUMERIC_FEATURES, CATEGORICAL_FEATURES, TARGET, spec)


def score_model_v1(model: PipelineModel, features: DataFrame) -> DataFrame:
    require_columns(features, [*KEYS, SPLIT, TARGET, *FEATURES], "feature table")
    return score_rows(model, features, [*KEYS, SPLIT, TARGET, *CARRIED_INDEXES], MODEL_V1_SCORE)


def evaluate_model_v1(scored: DataFrame, **options) -> DataFrame:
    return evaluate_scores(scored, MODEL_V1_SCORE, MODEL_V1_VERSION, **options)


def run_model_v1(features: DataFrame, spec: BoostingSpec = V1_BOOSTING) -> ModelResult:
    """Train, score with deciles, evaluate. ``features`` is read several times: pass a table."""
    model = train_model_v1(features, spec)
    # Staged, so that the two passes behind state and ties do not evaluate the trees again.
    scores = stage(score_model_v1(model, features), "v1-scores")
    scored, metrics, state = decile_and_measure(
        scores, MODEL_V1_SCORE, MODEL_V1_DECILE, MODEL_V1_VERSION
    )
    return ModelResult(
        model, scored, metrics, MODEL_V1_SCORE, MODEL_V1_VERSION, state=state
    )


def missing_features(table: DataFrame) -> Column:
    return total([flag(F.col(name).isNull()) for name in FEATURES])


def join_ledger(features: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows with the features of their customer-month. Raises where the features
    repeat a key of the ledger."""
    require_columns(features, [*KEYS, *FEATURES], "feature table")
    require_columns(ledger, LEDGER_PART, "ledger")
    part = ledger.select(*LEDGER_PART)
    traits = features.select(*KEYS, *[c for c in FEATURES if c not in LEDGER_PART])
    return checked_left_join(part, traits, KEYS, "feature table").withColumn(
        "assigned_treatment_flag", flag(F.col("assigned_group") == "treatment")
    )


def null_audit(learning: DataFrame) -> DataFrame:
    """One row: learning rows and feature cells the join left empty."""
    return learning.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(missing_features(learning)), F.lit(0)).alias("missing_feature_cells"),
    )


def stratum_quotas(sizes: dict[int, int], share: float) -> dict[int, int]:
    """Rows to draw per class: floors of the proportional quota, then largest remainders."""
    n = sum(sizes.values())
    drawn = math.ceil(share * n)
    exact = {k: size * drawn / n for k, size in sizes.items()} if n else {}
    quotas = {k: math.floor(q) for k, q in exact.items()}
    by_remainder = sorted(exact, key=lambda k: (quotas[k] - exact[k], k))
    for k in by_remainder[: drawn - sum(quotas.values())]:
        quotas[k] += 1
    return quotas


def stratified_split(
    table: DataFrame, target: str = POST_TARGET, name: str = LEARNING_SPLIT, seed: int = SEED
) -> DataFrame:
    """60/20/20 train, validation and test rows with the class shares of the whole.

    Rows are numbered by class, then by a keyed digest; a class's first rows are test,
    the next validation. Class sizes are one small aggregation; classes other than 0 and 1
    are an error.
    """
    label = F.when(F.col(target).isin(0, 1), F.col(target)).alias("label")
    sizes = {r["label"]: r["count"] for r in table.groupBy(label).count().orderBy("label").collect()}
    if None in sizes:
        raise ValueError(f"{sizes[None]} rows have a {target} other than 0 and 1")
    test = stratum_quotas(sizes, TEST_SHARE)
    rest = {k: size - test[k] for k, size in sizes.items()}
    validation = stratum_quotas(rest, VALIDATION_SHARE)
    digest = keyed_digest(seed, F.col(CUSTOMER), "learn")
    numbered = number_rows(
        table.withColumn("_digest", digest),
        [F.col(target), F.col("_digest"), F.col(CUSTOMER)], "_draw",
    )
    label = F.lit("train")
    before = 0
    for k, size in sizes.items():
        place = F.col("_draw") - before
        label = F.when(
            F.col(target) == k,
            F.when(place <= test[k], "test")
            .when(place <= test[k] + validation[k], "validation")
            .otherwise("train"),
        ).otherwise(label)
        before += size
    return numbered.withColumn(name, label).drop("_digest", "_draw")


def build_learning_table(features: DataFrame, ledger: DataFrame, seed: int = SEED) -> DataFrame:
    """Ledger with features and learning split; fails where a ledger row has no features."""
    # Staged, for the checks and class sizes below read it before the result is used.
    joined = join_ledger(features, ledger)
    missing = null_audit(joined).first()["missing_feature_cells"]
    if missing:
        raise ValueError(f"the feature join left {missing} empty feature cells")
    columns = [*LEDGER_PART, *FEATURES, "assigned_treatment_flag", LEARNING_SPLIT]
    return stratified_split(joined, seed=seed).select(*columns)


def in_policy_order(learning: DataFrame) -> DataFrame:
    """The learning table as it is presented; a global sort, so for reading only."""
    return learning.orderBy("policy_rank")


def train_model_v2(learning: DataFrame, spec: BoostingSpec = V2_BOOSTING) -> PipelineModel:
    return fit_on_train(
        learning, LEARNING_SPLIT, [*NUMERIC_FEATURES, *LEDGER_NUMERIC],
        [*CATEGORICAL_FEATURES, *LEDGER_CATEGORICAL], POST_TARGET, spec,
    )


def score_model_v2(model: PipelineModel, learning: DataFrame) -> DataFrame:
    scored = stage(score_rows(model, learning, V2_SCORED_COLUMNS, MODEL_V2_SCORE), "v2-scores")
    return assign_deciles(scored, MODEL_V2_SCORE, MODEL_V2_DECILE)


def evaluate_model_v2(scored: DataFrame, k_values: Sequence[int] = K_VALUES_LEDGER) -> DataFrame:
    return evaluate_scores(
        scored, MODEL_V2_SCORE, MODEL_V2_VERSION, k_values=k_values,
        split_column=LEARNING_SPLIT, target=POST_TARGET,
    )


def run_model_v2(
    features: DataFrame, ledger: DataFrame, spec: BoostingSpec = V2_BOOSTING
) -> ModelResult:
    learning = build_learning_table(features, ledger)
    model = train_model_v2(learning, spec)
    scored = score_model_v2(model, learning)
    return ModelResult(
        model, scored, evaluate_model_v2(scored), MODEL_V2_SCORE, MODEL_V2_VERSION, learning
    )
