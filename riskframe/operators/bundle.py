"""Versioned model bundles, their metadata and the model registry."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import ArtifactConfig
from riskframe.errors import BundleLoadError
from riskframe.functions.local import local_table
from riskframe.operators.attribution import Attributor
from riskframe.operators.calibration import CALIBRATED, CalibratedModel, CalibrationFit
from riskframe.operators.metrics import METRICS
from riskframe.operators.models import FittedModel, ModelPlan, in_threads
from riskframe.operators.prep import FittedPreprocessor
from riskframe.operators.quality import FeatureSchema
from riskframe.operators.threshold import apply_threshold
from riskframe.sources.sinks import path_exists, read_json, write_json


# Pipelines of a bundle that are written or read at the same time.
PARALLEL_FILES = 4


def training_record(
    name: str, version: str, plan: ModelPlan, fit: CalibrationFit, chosen: dict[str, Any], comparison: dict[str, Any],
    target: str,
) -> dict[str, Any]:
    """What is kept of the run behind a version: settings and aggregates, never rows.

    ``chosen`` is the selected row of a threshold sweep, ``comparison`` the row of ``calibration.compare``.
    """
    features = {"numerical_features": list(plan.numerical), "categorical_features": list(plan.categorical)}
    measured = {
        "evaluation_metrics": {m: comparison[f"after_{m}"] for m in METRICS},
        "calibration_metrics": {m: comparison[m] for m in ("brier_score_delta", "log_loss_delta")},
    }
    return {
        "packaged_at_utc": datetime.now(timezone.utc).isoformat(), "target_column": target,
        "model_name": name, "model_version": version, "model_type": plan.name,
        "best_hyperparameters": dict(plan.params), "training_random_state": plan.seed,
        "feature_count": sum(len(names) for names in features.values()), **features,
        "calibration_method": fit.method, "calibration_strategy": fit.strategy,
        "threshold": float(chosen["threshold"]), "threshold_selection_strategy": chosen["strategy"], **measured,
    }


REGISTRY_SCHEMA = (
    "model_name string, model_version string, model_type string, calibration_method string, "
    "calibration_strategy string, threshold double, threshold_selection_strategy string, "
    "feature_count bigint, numerical_features string, categorical_features string, target_column string, "
    "evaluation_metrics string, packaged_at_utc string"
)


def registry_row(spark: SparkSession, metadata: dict[str, Any]) -> DataFrame:
    names = [f.split()[0] for f in REGISTRY_SCHEMA.split(",")]
    values = [metadata[n] for n in names]
    row = tuple(json.dumps(v) if isinstance(v, (list, dict)) else v for v in values)
    return local_table(spark, [row], REGISTRY_SCHEMA)


def register(spark: SparkSession, metadata: dict[str, Any], registry_dir: str) -> None:
    registry_row(spark, metadata).write.mode("append").parquet(registry_dir)


def model_info(spark: SparkSession, registry_dir: str, version: str | None = None) -> DataFrame:
    """The latest registry entry per version, or of one version."""
    entries = spark.read.parquet(registry_dir)
    if version is not None:
        entries = entries.where(F.col("model_version") == version)
    columns = [c for c in entries.columns if c not in ("model_name", "model_version")]
    latest = F.max_by(F.struct(*columns), "packaged_at_utc").alias("entry")
    return entries.groupBy("model_name", "model_version").agg(latest).select(
        "model_name", "model_version", "entry.*")


@dataclass
class Bundle:
    """A loaded model version."""

    version: str
    calibrated: CalibratedModel
    raw: FittedModel
    threshold: float
    threshold_document: dict[str, Any]
    metadata: dict[str, Any]
    attribution: dict[str, Any]
    schema: FeatureSchema

    def predict_proba(self, df: DataFrame, output: str = CALIBRATED, known: Sequence[str] = ()) -> DataFrame:
        self.schema.validate(df, known=known)
        return self.calibrated.score(df, output)

    def predict(self, df: DataFrame, output: str = CALIBRATED, known: Sequence[str] = ()) -> DataFrame:
        return apply_threshold(self.predict_proba(df, output, known), self.threshold, output)

    def attributor(self, spark: SparkSession) -> Attributor:
        return Attributor(self.raw, spark)


def _parts(config: ArtifactConfig, version: str) -> dict[str, str]:
    model_dir = config.model_dir(version)
    return {
        "model": f"{model_dir}/model",
        "raw pipeline": f"{model_dir}/raw_pipeline",
        "attribution metadata": f"{model_dir}/attribution_metadata",
        "threshold": f"{config.threshold_dir(version)}/threshold",
        "model metadata": f"{config.metadata_dir_for(version)}/model_metadata",
    }


def save_bundle(spark: SparkSession, version: str, calibrated: CalibratedModel, raw: FittedModel,
                threshold_document: dict[str, Any], metadata: dict[str, Any],
                config: ArtifactConfig) -> dict[str, str]:
    """Writes the five parts of a version and adds it to the registry."""
    parts = _parts(config, version)
    pipelines = {f"{parts['model']}/member_{i}": m for i, m in enumerate(calibrated.members)}
    pipelines[parts["raw pipeline"]] = raw.pipeline()
    in_threads([lambda u=u, m=m: m.write().overwrite().save(u) for u, m in pipelines.items()], PARALLEL_FILES)
    write_json(spark, {"members": len(calibrated.members)}, f"{parts['model']}/members")
    write_json(spark, {**raw.prep.document(), "name": raw.name, "family": raw.family}, parts["attribution metadata"])
    write_json(spark, threshold_document, parts["threshold"])
    write_json(spark, metadata, parts["model metadata"])
    register(spark, metadata, config.registry_dir)
    return parts


def load_bundle(spark: SparkSession, version: str, config: ArtifactConfig) -> Bundle:
    """Loads a version. All five parts have to exist and make sense."""
    parts = _parts(config, version)
    for what, uri in parts.items():
        if not path_exists(spark, uri):
            raise BundleLoadError(f"no {what} of version {version!r} at {uri}")
    threshold_document = read_json(spark, parts["threshold"])
    metadata = read_json(spark, parts["model metadata"])
    attribution = read_json(spark, parts["attribution metadata"])

    threshold = threshold_document.get("threshold")
    if threshold is None or not 0.0 <= threshold <= 1.0:
        raise BundleLoadError(f"invalid threshold {threshold!r} at {parts['threshold']}")
    numerical, categorical = metadata.get("numerical_features"), metadata.get("categorical_features")
    if numerical is None or categorical is None:
        raise BundleLoadError("the model metadata lacks the feature lists")

    members = read_json(spark, f"{parts['model']}/members")["members"]
    uris = [f"{parts['model']}/member_{i}" for i in range(members)] + [parts["raw pipeline"]]
    *pipelines, raw = in_threads([lambda u=u: PipelineModel.load(u) for u in uris], PARALLEL_FILES)
    calibrated = CalibratedModel(pipelines)
    prep = FittedPreprocessor.of(PipelineModel(raw.stages[:-1]), attribution)
    return Bundle(
        version, calibrated, FittedModel(attribution["name"], attribution["family"], prep, raw.stages[-1]),
        float(threshold), threshold_document, metadata, attribution,
        FeatureSchema(tuple(numerical), tuple(categorical)))


def reload_differences(before: DataFrame, after: DataFrame) -> int:
    """Rows that two scorings of the same input do not share; 0 if they agree."""
    return before.exceptAll(after).count() + after.exceptAll(before).count()


def rescoring_differences(df: DataFrame, saved: CalibratedModel, loaded: CalibratedModel) -> int:
    """Rows of ``df`` that two models score differently: one projection, no shuffle of rows."""
    both = loaded.score(saved.score(df, "__saved"), "__loaded")
    return both.where(~F.col("__saved").eqNullSafe(F.col("__loaded"))).count()
