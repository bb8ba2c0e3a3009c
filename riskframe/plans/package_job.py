"""Workflow 3: calibrate, choose a threshold, attribute, package, reload. Test rows are not read.

    spark-submit -m riskframe.plans.package_job --data-path P --target T --id-columns K --root O
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import ArtifactConfig, Config
from riskframe.functions.columns import kept
from riskframe.operators.attribution import Attributor, GlobalReport, explain_global, explain_rows
from riskframe.operators.bundle import (
    Bundle, load_bundle, rescoring_differences, save_bundle, training_record,
)
from riskframe.operators.calibration import (
    CALIBRATED, CalibrationFit, compare, fit_calibrated, probability_histogram, reliability_curve,
)
from riskframe.operators.models import LABEL, SCORE, ModelPlan, model_plan
from riskframe.operators.threshold import SWEEP_COLUMNS, choose, save_threshold
from riskframe.plans.common import gate, load_and_check, prepare
from riskframe.session import build_session
from riskframe.sources.sinks import write_json, write_table

logger = logging.getLogger(__name__)


@dataclass
class PackageOutcome:
    fit: CalibrationFit
    comparison: dict[str, Any]
    threshold: float
    importance: GlobalReport | None
    bundle: Bundle
    differences: int


def save_version(spark: SparkSession, plan: ModelPlan, fit: CalibrationFit, chosen: dict[str, Any],
                 comparison: dict[str, Any], config: Config, version: str) -> Bundle:
    """Writes the bundle of a fitted model and its chosen threshold, and loads it again."""
    artifacts = config.artifacts
    metadata = training_record(
        artifacts.model_name, version, plan, fit, chosen, comparison, config.data.target_column or LABEL)
    document = {
        "threshold": chosen["threshold"], "strategy": chosen["strategy"], "rationale": chosen["rationale"],
        "metrics_at_threshold": {c: chosen[c] for c in SWEEP_COLUMNS[1:]},
    }
    save_bundle(spark, version, fit.calibrated, fit.raw, document, metadata, artifacts)
    return load_bundle(spark, version, artifacts)


def package(spark: SparkSession, plan: ModelPlan, train: DataFrame, keys: Sequence[str], config: Config,
            version: str) -> PackageOutcome:
    """Everything after the split, from training rows to a reloaded bundle."""
    artifacts = config.artifacts
    fit = fit_calibrated(plan, train, keys, config.calibration, config.cv.parallelism)
    both = fit.calibrated.score(fit.raw.score(fit.calibration_rows))
    with kept(both) as scored:
        comparison = compare(scored, SCORE, CALIBRATED).first().asDict()
        folder = artifacts.calibration_reports_dir
        write_json(spark, comparison, f"{folder}/calibration_metrics")
        write_table(reliability_curve(scored, SCORE, CALIBRATED), f"{folder}/reliability_curve")
        write_table(probability_histogram(scored, SCORE, CALIBRATED), f"{folder}/probability_histogram")

        settings = config.threshold
        sweep, chosen = choose(scored, settings.strategy, LABEL, CALIBRATED, settings.grid(), **settings.arguments())
        save_threshold(chosen, sweep, artifacts.threshold_reports_dir, {"version": version})
        row = chosen.first().asDict()

    importance = None
    if plan.family == "tree":
        attributor = Attributor(fit.raw, spark)
        limits = config.explainability
        importance = explain_global(attributor, fit.calibration_rows, keys, limits.global_sample_size,
                                    limits.random_state)
        folder = artifacts.attribution_reports_dir
        write_table(importance.importance, f"{folder}/feature_importance")
        write_json(spark, importance.summary, f"{folder}/summary")
        write_table(attributor.bar(fit.calibration_rows, limits.max_display_features), f"{folder}/bar")
        if attributor.boxes.used:
            write_table(attributor.swarm(fit.calibration_rows, keys, limits.max_display_features), f"{folder}/swarm")
        local = explain_rows(attributor, fit.calibrated, fit.calibration_rows, row["threshold"], keys,
                             limits.top_n_local_features)
        # One row per feature that explains a decision, so the table has plain columns only.
        write_table(local.select(*keys, "prediction_probability", "prediction", "threshold_used",
                                 F.inline_outer("top_features")), f"{folder}/local")

    loaded = save_version(spark, plan, fit, row, comparison, config, version)
    differences = rescoring_differences(fit.calibration_rows, fit.calibrated, loaded.calibrated)
    if differences:
        raise RuntimeError(f"the reloaded bundle scores {differences} rows differently")
    return PackageOutcome(fit, comparison, row["threshold"], importance, loaded, differences)


def run(spark: SparkSession, config: Config, version: str = "v1.0.0") -> PackageOutcome:
    config.validate()
    df, report = load_and_check(spark, config)
    gate(report)
    data = prepare(df, config)
    plan = model_plan(config.model.model_type, data.numerical, data.categorical, config.preprocessing,
                      config.model, data.train)
    with kept(data.train) as train:
        return package(spark, plan, train, config.data.id_columns, config, version)


def main() -> None:
    parser = argparse.ArgumentParser(description="Calibrate, explain and package a model.")
    parser.add_argument("--data-path", required=True)
    parser.add_argument("--data-format", default="csv")
    parser.add_argument("--target", required=True)
    parser.add_argument("--id-columns", nargs="+", required=True)
    parser.add_argument("--root", default="artifacts")
    parser.add_argument("--version", default="v1.0.0")
    args = parser.parse_args()
    config = Config()
    config.artifacts = ArtifactConfig.below(args.root)
    config.data.data_path, config.data.data_format = args.data_path, args.data_format
    config.data.target_column, config.data.id_columns = args.target, args.id_columns
    outcome = run(build_session("package"), config, args.version)
    logger.info("threshold %s, calibration %s", outcome.threshold, outcome.comparison)


if __name__ == "__main__":
    main()
