"""Random search over hyperparameters with stratified folds."""

from __future__ import annotations

import itertools
import json
import logging
import math
import random
import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.config import TuningConfig
from riskframe.functions.local import local_table
from riskframe.operators.metrics import METRICS, classification_metrics
from riskframe.operators.models import LABEL, SCORE, FittedModel, ModelPlan, in_threads, score_folds
from riskframe.operators.prep import FEATURES
from riskframe.operators.split import assign_folds
from riskframe.sources.sinks import write_json, write_table

logger = logging.getLogger(__name__)

# Scores where a smaller value is better.
LOSSES = ("brier_score", "log_loss")


def draw_candidates(space: dict[str, Sequence[Any]], n_iter: int, seed: int) -> list[dict[str, Any]]:
    """``n_iter`` different points of the grid, or the whole grid if it is smaller."""
    names = sorted(space)
    size = math.prod(len(space[n]) for n in names)
    if n_iter >= size:
        return [dict(zip(names, values)) for values in itertools.product(*(space[n] for n in names))]
    drawn = []
    for position in random.Random(seed).sample(range(size), n_iter):
        point = {}
        for n in names:
            position, i = divmod(position, len(space[n]))
            point[n] = space[n][i]
        drawn.append(point)
    return drawn


@dataclass
class TuningResult:
    best_params: dict[str, Any]
    best_score: float
    cv_results: DataFrame
    best_model: FittedModel
    best_plan: ModelPlan
    scoring: str
    seconds: float
    train_val_gap: float | None
    oof: DataFrame

    def document(self) -> dict[str, Any]:
        return {"best_params": self.best_params, "best_score": self.best_score, "scoring": self.scoring,
                "search_time_seconds": self.seconds, "train_val_gap": self.train_val_gap}


def random_search(plan: ModelPlan, train: DataFrame, keys: Sequence[str],
                  config: TuningConfig | None = None) -> TuningResult:
    """Validates random candidates on shared folds and refits the best one on all rows.

    Preprocessing does not depend on the candidate, so it is fitted once per fold. Folds
    are worked through one after the other: the transformed rows of one fold are held,
    each candidate is fitted, scored and reduced to its metrics at once, then the fold is
    released. The out-of-fold scores are those of the winner's own models.
    """
    config = config or TuningConfig()
    if config.scoring not in METRICS:
        raise ValueError(f"unknown scoring {config.scoring!r}; known: {METRICS}")
    start = time.time()
    k = config.n_splits
    candidates = draw_candidates(config.param_distributions, config.n_iter, config.random_state)
    folded = assign_folds(train, LABEL, keys, k, config.random_state).persist()
    fitted: dict[tuple[int, int], FittedModel] = {}
    measured: list[tuple] = []
    for f in range(k):
        prep = plan.preprocessor().fit_rows(folded.where(F.col("fold") != f))
        frame = prep.transform(folded).select(F.col(LABEL).cast("double").alias(LABEL), "fold", FEATURES).persist()

        def validate(c: int, f: int = f, prep=prep, frame: DataFrame = frame) -> list[tuple]:
            model = plan.with_params(**candidates[c]).fit_classifier(prep, frame.where(F.col("fold") != f))
            fitted[c, f] = model
            role = F.when(F.col("fold") == f, "test").otherwise("train")
            scored = model.classifier.transform(frame).select(
                LABEL, role.alias("role"), vector_to_array("probability")[1].alias(SCORE))
            rows = classification_metrics(scored, LABEL, SCORE, group_cols=["role"]).collect()
            return [(c, f, r["role"], r[config.scoring]) for r in rows]

        for rows in in_threads([lambda c=c: validate(c) for c in range(len(candidates))], config.parallelism):
            measured += rows
        frame.unpersist()
    # One number per candidate, fold and role.
    metrics = local_table(train.sparkSession, measured,
                          f"candidate int, split int, role string, {config.scoring} double")
    results = _results(metrics, candidates, config.scoring)

    best = results.orderBy("rank", "candidate").first()
    winner = plan.with_params(**candidates[best["candidate"]])
    oof = score_folds([fitted[best["candidate"], f] for f in range(k)], folded).select(*keys, LABEL, SCORE)
    model = winner.fit_kept(folded)
    folded.unpersist()
    gap = None
    if best["mean_train_score"] is not None and best["mean_test_score"] is not None:
        gap = best["mean_train_score"] - best["mean_test_score"]
        gap = -gap if config.scoring in LOSSES else gap
    if gap is not None and gap > config.train_val_gap_warning_threshold:
        logger.warning("the best candidate scores %.4f better on its training rows: possible overfitting", gap)
    return TuningResult(
        candidates[best["candidate"]], best["mean_test_score"], results, model, winner,
        config.scoring, time.time() - start, gap, oof)


def _results(metrics: DataFrame, candidates: list[dict[str, Any]], scoring: str) -> DataFrame:
    """(candidate, params, mean/std test score, mean train score, rank)."""
    def over(role: str):
        return F.when(F.col("role") == role, F.col(scoring))

    table = metrics.groupBy("candidate").agg(
        F.avg(over("test")).alias("mean_test_score"), F.stddev_pop(over("test")).alias("std_test_score"),
        F.avg(over("train")).alias("mean_train_score"), F.stddev_pop(over("train")).alias("std_train_score"))
    names = local_table(
        metrics.sparkSession, [(i, json.dumps(c, sort_keys=True)) for i, c in enumerate(candidates)],
        "candidate int, params string")
    score = F.col("mean_test_score")
    order = score.asc_nulls_last() if scoring in LOSSES else score.desc_nulls_last()
    # One row per candidate.
    return names.join(F.broadcast(table), "candidate").withColumn("rank", F.rank().over(Window.orderBy(order)))


def top_candidates(result: TuningResult, n: int = 10) -> DataFrame:
    return result.cv_results.orderBy("rank", "candidate").limit(n)


def save_tuning(result: TuningResult, models_dir: str, metadata_dir: str, version: str) -> dict[str, str]:
    model = f"{models_dir}/tuned_{version}"
    result.best_model.pipeline().write().overwrite().save(model)
    spark = result.cv_results.sparkSession
    return {
        "model": model,
        "cv_results": write_table(result.cv_results, f"{metadata_dir}/tuning_cv_results_{version}"),
        "metadata": write_json(spark, result.document(), f"{metadata_dir}/tuning_metadata_{version}"),
    }
