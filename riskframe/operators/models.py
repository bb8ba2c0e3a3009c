"""Model factory, training, scoring and cross-validation."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.config import MODEL_TYPES, CVConfig, ModelConfig, PreprocessingConfig
from riskframe.functions.columns import kept
from riskframe.operators.metrics import METRICS, classification_metrics
from riskframe.operators.prep import (
    FEATURES, LINEAR, TREE, FittedPreprocessor, Preprocessor, helper_columns,
)
from riskframe.operators.split import assign_folds, assign_parts
from riskframe.session import shared_folder

logger = logging.getLogger(__name__)

LABEL = "label"
WEIGHT = "__weight"
SCORE = "p"


def class_ratio(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(negatives, positives, ratio) of the labels."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ).withColumn("ratio", F.col("negatives") / F.nullif(F.col("positives"), F.lit(0)))


def scale_pos_weight(df: DataFrame, label: str = LABEL) -> float:
    ratio = class_ratio(df, label).first()["ratio"]
    if ratio is None:
        raise ValueError("there are no positive rows, so there is no class ratio")
    return float(ratio)


def class_weights(df: DataFrame, strategy: str, label: str = LABEL) -> dict[float, float]:
    """Weight per class: ``balanced`` is n / (2 n_class), otherwise the ratio for positives."""
    row = class_ratio(df, label).first()
    if strategy in ("balanced", "class_weight"):
        n = row["negatives"] + row["positives"]
        return {c: n / (2.0 * k) for c, k in ((0.0, row["negatives"]), (1.0, row["positives"])) if k}
    if row["ratio"] is None:
        raise ValueError("there are no positive rows, so there is no class ratio")
    return {0.0: 1.0, 1.0: float(row["ratio"])}


def with_weights(df: DataFrame, weights: dict[float, float] | None, label: str = LABEL) -> DataFrame:
    if not weights:
        return df
    column = None
    for c, w in weights.items():
        column = F.when(F.col(label) == c, F.lit(w)) if column is None else column.when(F.col(label) == c, F.lit(w))
    return df.withColumn(WEIGHT, column)


class LinearModel(Estimator):
    """Logistic regression with the penalty 1/2 |w|^2 + C * sum of losses.

    Spark averages the losses, so the penalty is 1 / (C * total weight).
    """

    def __init__(self, params: dict[str, Any], balanced: bool = False):
        super().__init__()
        self.params_, self.balanced = dict(params), balanced

    def _fit(self, dataset: DataFrame):
        weights = class_weights(dataset, "balanced") if self.balanced else None
        # Balanced weights add up to the number of rows.
        total = dataset.count()
        C = float(self.params_.get("C", 1.0))
        estimator = LogisticRegression(
            featuresCol=FEATURES, labelCol=LABEL, regParam=1.0 / (C * total), elasticNetParam=0.0,
            standardization=False, maxIter=int(self.params_.get("max_iter", 1000)),
            tol=float(self.params_.get("tol", 1e-8)))
        if weights:
            estimator = estimator.setWeightCol(WEIGHT)
        return estimator.fit(with_weights(dataset, weights))


# Boosting parameters that have a counterpart in Spark.
TREE_PARAMS = (
    "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight",
    "min_gain", "max_bins", "random_state",
)


class TreeModel(Estimator):
    """Gradient boosted trees; the log-odds are twice the sum of the trees."""

    def __init__(self, params: dict[str, Any], positive_weight: float | None = None, seed: int = 42):
        super().__init__()
        self.params_, self.positive_weight, self.seed_ = dict(params), positive_weight, seed

    def _fit(self, dataset: DataFrame):
        p = self.params_
        unknown = sorted(set(p) - set(TREE_PARAMS))
        if unknown:
            logger.warning("boosting parameters without a counterpart are ignored: %s", unknown)
        estimator = GBTClassifier(
            featuresCol=FEATURES, labelCol=LABEL, seed=int(p.get("random_state", self.seed_)),
            maxIter=int(p.get("n_estimators", 200)), maxDepth=int(p.get("max_depth", 4)),
            stepSize=float(p.get("learning_rate", 0.1)),
            subsamplingRate=float(p.get("subsample", 1.0)),
            featureSubsetStrategy=_subset(float(p.get("colsample_bytree", 1.0))),
            minInstancesPerNode=int(p.get("min_child_weight", 1)),
            minInfoGain=float(p.get("min_gain", 0.0)), maxBins=int(p.get("max_bins", 32)))
        weights = None
        if self.positive_weight is not None:
            weights = {0.0: 1.0, 1.0: self.positive_weight}
            estimator = estimator.setWeightCol(WEIGHT)
        # Boosting grows lineage with every tree; Spark cuts it in the shared folder.
        shared_folder(dataset.sparkSession)
        return estimator.fit(with_weights(dataset, weights))


def _subset(fraction: float) -> str:
    return "all" if fraction >= 1.0 else str(fraction)


@dataclass
class ModelPlan:
    """An unfitted preprocessor plus classifier. Fitting leaves the plan as it is."""

    name: str
    numerical: list[str]
    categorical: list[str]
    preprocessing: PreprocessingConfig = field(default_factory=PreprocessingConfig)
    params: dict[str, Any] = field(default_factory=dict)
    balanced: bool = False
    positive_weight: float | None = None
    seed: int = 42

    @property
    def family(self) -> str:
        return LINEAR if self.name == "logistic_regression" else TREE

    def preprocessor(self) -> Preprocessor:
        return Preprocessor(self.numerical, self.categorical, self.preprocessing, self.family)

    def classifier(self) -> Estimator:
        if self.family == LINEAR:
            return LinearModel(self.params, self.balanced)
        return TreeModel(self.params, self.positive_weight, self.seed)

    def with_params(self, **params: Any) -> "ModelPlan":
        return replace(self, params={**self.params, **params})

    def fit(self, train: DataFrame) -> "FittedModel":
        """Fits preprocessing and classifier; the columns they need are kept for the passes it takes."""
        with kept(train, [*self.numerical, *self.categorical, LABEL]) as rows:
            return self.fit_kept(rows)

    def fit_kept(self, rows: DataFrame) -> "FittedModel":
        """The same on rows that are held already, or are a filter of held rows."""
        prep = self.preprocessor().fit_rows(rows)
        return self.fit_classifier(prep, prep.transform(rows))

    def fit_classifier(self, prep: FittedPreprocessor, transformed: DataFrame) -> "FittedModel":
        """Fits the classifier on rows that ``prep`` has transformed."""
        columns = transformed.select(FEATURES, F.col(LABEL).cast("double").alias(LABEL))
        return FittedModel(self.name, self.family, prep, self.classifier().fit(columns))


@dataclass
class FittedModel:
    """A fitted preprocessor and classifier."""

    name: str
    family: str
    prep: FittedPreprocessor
    classifier: Any

    def pipeline(self) -> PipelineModel:
        if self.prep.model is None:
            raise ValueError("a model whose categories are a table is no pipeline; save its parts instead")
        return PipelineModel([*self.prep.model.stages, self.classifier])

    def score(self, df: DataFrame, output: str = SCORE) -> DataFrame:
        """Adds the probability of class 1; a narrow projection, or joins where the categories are a table."""
        self.prep.schema.require(df)
        if self.prep.model is None:
            scored = self.classifier.transform(self.prep.transform(df, FEATURES))
            return scored.withColumn(output, vector_to_array("probability")[1]).drop(FEATURES, *CLASSIFIER_COLUMNS)
        return add_score(self.pipeline(), df, output)


CLASSIFIER_COLUMNS = ("rawPrediction", "probability", "prediction")


def add_score(model: PipelineModel, df: DataFrame, output: str = SCORE) -> DataFrame:
    clash = [c for c in (FEATURES, *CLASSIFIER_COLUMNS) if c in df.columns]
    if clash:
        raise ValueError(f"the input already has the columns {clash}")
    scored = model.transform(df).withColumn(output, vector_to_array("probability")[1])
    return scored.drop(*helper_columns(scored), FEATURES, *CLASSIFIER_COLUMNS)


def model_plan(
    name: str,
    numerical: Sequence[str],
    categorical: Sequence[str],
    preprocessing: PreprocessingConfig | None = None,
    model: ModelConfig | None = None,
    train: DataFrame | None = None,
) -> ModelPlan:
    """The unfitted model for ``name``. ``train`` is read only for ``scale_pos_weight``."""
    if name not in MODEL_TYPES:
        raise ValueError(f"unknown model name {name!r}; known: {MODEL_TYPES}")
    model = model or ModelConfig()
    linear = name == "logistic_regression"
    plan = ModelPlan(
        name, list(numerical), list(categorical), preprocessing or PreprocessingConfig(),
        dict(model.logistic_regression_params if linear else model.boosted_trees_params),
        seed=model.random_state)
    strategy = model.class_imbalance_strategy
    if strategy in ("balanced", "class_weight") and linear:
        plan.balanced = True
    elif strategy == "scale_pos_weight" and not linear:
        if train is None:
            raise ValueError("scale_pos_weight needs the training rows")
        plan.positive_weight = scale_pos_weight(train)
    elif strategy is not None:
        logger.warning("%s does not apply to %s and is ignored", strategy, name)
    return plan


@dataclass
class CVResult:
    """Fold metrics, their mean and sample deviation, and the out-of-fold scores."""

    model_name: str
    fold_metrics: DataFrame
    mean_metrics: dict[str, float | None]
    std_metrics: dict[str, float | None]
    seconds: float
    oof: DataFrame

    def summary(self) -> DataFrame:
        """One row: cv_<metric> and cv_<metric>_std."""
        return summarise_folds(self.fold_metrics)


def summarise_folds(fold_metrics: DataFrame) -> DataFrame:
    """Mean and sample deviation over folds; folds where a metric is undefined do not count."""
    return fold_metrics.agg(
        *[F.avg(m).alias(f"cv_{m}") for m in METRICS],
        *[F.stddev_samp(m).alias(f"cv_{m}_std") for m in METRICS])


def in_threads(tasks: Sequence[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Runs independent driver-side fits at the same time; Spark schedules their jobs."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda t: t(), tasks)


def fit_folds(plan: ModelPlan, folded: DataFrame, k: int, parallelism: int = 1) -> list[FittedModel]:
    """One model per fold, fitted with its preprocessing on the other folds. ``folded`` is held."""
    return in_threads(
        [lambda f=f: plan.fit_kept(folded.where(F.col("fold") != f)) for f in range(k)], parallelism)


def score_folds(models: Sequence[FittedModel], folded: DataFrame) -> DataFrame:
    """Every row scored by the model of its own fold."""
    parts = [m.score(folded.where(F.col("fold") == f)) for f, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


def cross_validate(plan: ModelPlan, train: DataFrame, keys: Sequence[str], config: CVConfig | None = None) -> CVResult:
    """Stratified k-fold validation on training rows, metrics at the threshold 0.5.

    Metrics of all folds come from one pass over the out-of-fold scores.
    """
    config = config or CVConfig()
    start = time.time()
    folded = assign_folds(train, LABEL, keys, config.n_splits, config.random_state).persist()
    models = fit_folds(plan, folded, config.n_splits, config.parallelism)
    oof = score_folds(models, folded).select(*keys, "fold", LABEL, SCORE).persist()
    metrics = classification_metrics(oof, LABEL, SCORE, group_cols=["fold"]).persist()
    row = summarise_folds(metrics).first().asDict()
    folded.unpersist()
    return CVResult(
        plan.name, metrics,
        {m: row[f"cv_{m}"] for m in METRICS}, {m: row[f"cv_{m}_std"] for m in METRICS},
        time.time() - start, oof)


def validation_scores(plan: ModelPlan, train: DataFrame, keys: Sequence[str], config: CVConfig | None = None,
                      strategy: str = "oof", holdout_size: float = 0.2, seed: int = 42) -> DataFrame:
    """(keys, label, p) for choosing a threshold, never from rows a model was fitted on."""
    config = config or CVConfig()
    if strategy == "oof":
        folded = assign_folds(train, LABEL, keys, config.n_splits, config.random_state)
        with kept(folded) as rows:
            models = fit_folds(plan, rows, config.n_splits, config.parallelism)
        return score_folds(models, folded).select(*keys, LABEL, SCORE)
    if strategy == "holdout":
        parts = assign_parts(train, LABEL, keys, holdout_size, seed=seed)
        model = plan.fit(parts.where("part = 'train'"))
        return model.score(parts.where("part = 'test'")).select(*keys, LABEL, SCORE)
    raise ValueError(f"unknown validation strategy {strategy!r}; use 'oof' or 'holdout'")


@dataclass
class ComparisonEntry:
    model_name: str
    cv: DataFrame
    seconds: float
    validation: DataFrame | None = None
    limitations: list[str] = field(default_factory=list)


def comparison(entries: Sequence[ComparisonEntry]) -> DataFrame:
    """One row per model with cv_* and, where given, val_* columns. It picks no winner."""
    rows = []
    for e in entries:
        row = e.cv.select(
            F.lit(e.model_name).alias("model_name"), F.lit(float(e.seconds)).alias("training_time_seconds"),
            F.lit("; ".join(e.limitations)).alias("limitations"), "*")
        if e.validation is not None:
            values = e.validation.select(*METRICS).first().asDict()
            row = row.withColumns({f"val_{m}": F.lit(v).cast("double") for m, v in values.items()})
        rows.append(row)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
