"""Workflow 2: compare models, tune, choose a threshold, evaluate on the test rows once.

    spark-submit -m riskframe.plans.model_job --data-path P --target T --id-columns K --root O
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from riskframe.config import ArtifactConfig, Config
from riskframe.functions.columns import kept
from riskframe.operators.metrics import METRICS, classification_metrics, pr_curve, roc_curve
from riskframe.operators.models import (
    LABEL, SCORE, ComparisonEntry, FittedModel, comparison, cross_validate, model_plan, validation_scores,
)
from riskframe.operators.threshold import apply_threshold, choose, save_threshold, tradeoff_table
from riskframe.operators.tuning import TuningResult, random_search, save_tuning
from riskframe.plans.common import gate, load_and_check, prepare
from riskframe.session import build_session
from riskframe.sources.sinks import write_json, write_table

logger = logging.getLogger(__name__)


@dataclass
class ModelOutcome:
    comparison: DataFrame
    tuning: TuningResult
    sweep: DataFrame
    threshold: DataFrame
    model: FittedModel
    test_metrics: dict[str, Any]


def run(spark: SparkSession, config: Config, version: str | None = None) -> ModelOutcome:
    config.validate()
    version = version or datetime.now(timezone.utc).strftime("run-%Y-%j-%H%M%S")
    artifacts, keys = config.artifacts, config.data.id_columns
    df, report = load_and_check(spark, config)
    gate(report)
    data = prepare(df, config)

    with kept(data.train) as train:
        entries = []
        for name in ("logistic_regression", "boosted_trees"):
            plan = model_plan(name, data.numerical, data.categorical, config.preprocessing, config.model, train)
            result = cross_validate(plan, train, keys, config.cv)
            held_out = None
            if data.validation is not None:
                held_out = classification_metrics(plan.fit(train).score(data.validation), LABEL, SCORE)
            entries.append(ComparisonEntry(name, result.summary(), result.seconds, held_out,
                                           ["fitted once with the configured parameters; the search comes later"]))
        table = comparison(entries)
        write_table(table, f"{artifacts.evaluation_reports_dir}/model_comparison_{version}")

        tuned = random_search(plan, train, keys, config.tuning)
        save_tuning(tuned, artifacts.models_dir, artifacts.metadata_dir, version)

        settings = config.threshold
        scores = tuned.oof
        if settings.validation_strategy == "holdout" or config.tuning.n_splits != config.cv.n_splits \
                or config.tuning.random_state != config.cv.random_state:
            scores = validation_scores(tuned.best_plan, train, keys, config.cv, settings.validation_strategy,
                                       settings.holdout_size, config.split.random_state)
        # With the same folds and seed the search has scored these rows already.
        sweep, chosen = choose(scores, settings.strategy, LABEL, SCORE, settings.grid(), **settings.arguments())
        save_threshold(chosen, sweep, artifacts.threshold_dir(version),
                       {"version": version, "validation_strategy": settings.validation_strategy})
        value = chosen.first()["threshold"]
        write_table(tradeoff_table(sweep, value), f"{artifacts.threshold_reports_dir}/{version}/tradeoff")

    with kept(tuned.best_model.score(data.test)) as tested:
        decided = apply_threshold(tested, value, SCORE, "decision")
        row = classification_metrics(decided, LABEL, SCORE, "decision").first().asDict()
        folder = f"{artifacts.evaluation_reports_dir}/{version}"
        write_table(roc_curve(decided, LABEL, SCORE), f"{folder}/roc_curve")
        write_table(pr_curve(decided, LABEL, SCORE), f"{folder}/pr_curve")
    final = {m: row[m] for m in METRICS}
    write_json(spark, {
        "final_test_metrics": final, "confusion": {c: row[c] for c in ("tp", "fp", "tn", "fn")},
        "selected_threshold": value, "best_params": tuned.best_params, "version": version,
    }, f"{folder}/final_test_evaluation")
    return ModelOutcome(table, tuned, sweep, chosen, tuned.best_model, final)


def main() -> None:
    parser = argparse.ArgumentParser(description="Compare, tune and evaluate models on a table.")
    parser.add_argument("--data-path", required=True)
    parser.add_argument("--data-format", default="csv")
    parser.add_argument("--target", required=True)
    parser.add_argument("--id-columns", nargs="+", required=True)
    parser.add_argument("--root", default="artifacts")
    parser.add_argument("--tuning-n-iter", type=int, default=None)
    args = parser.parse_args()
    config = Config()
    config.artifacts = ArtifactConfig.below(args.root)
    config.data.data_path, config.data.data_format = args.data_path, args.data_format
    config.data.target_column, config.data.id_columns = args.target, args.id_columns
    if args.tuning_n_iter:
        config.tuning.n_iter = args.tuning_n_iter
    outcome = run(build_session("model"), config)
    logger.info("test metrics: %s", outcome.test_metrics)


if __name__ == "__main__":
    main()
