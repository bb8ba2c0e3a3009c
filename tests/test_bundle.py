import os

import pytest
from pyspark.sql import functions as F

from riskframe.config import ArtifactConfig, Config, ModelConfig
from riskframe.errors import BundleLoadError, SchemaValidationError
from riskframe.operators import bundle, models, scoring
from riskframe.plans import package_job
from riskframe.sources.sinks import write_json
from riskframe.streaming import scoring as stream
from conftest import NUMBERS


@pytest.fixture(scope="module")
def saved(spark, training, tmp_path_factory):
    config = Config()
    config.artifacts = ArtifactConfig.below(str(tmp_path_factory.mktemp("bundle")))
    config.data.target_column = "label"
    plan = models.model_plan("boosted_trees", NUMBERS, ["category"], model=ModelConfig(
        boosted_trees_params={"n_estimators": 4, "max_depth": 2, "learning_rate": .3}))
    return package_job.package(spark, plan, training, ["row_id"], config, "v1_test"), config.artifacts


@pytest.fixture(scope="module")
def loaded(spark, saved):
    return bundle.load_bundle(spark, "v1_test", saved[1])


def test_reload_scores_the_same(saved, loaded, training):
    outcome, _ = saved
    assert outcome.differences == 0
    before = outcome.fit.calibrated.score(training).select("row_id", "p_calibrated")
    after = loaded.calibrated.score(training).select("row_id", "p_calibrated")
    assert bundle.reload_differences(before, after) == 0


def test_parts_and_metadata(saved, loaded):
    outcome, config = saved
    assert loaded.threshold == outcome.threshold
    assert loaded.metadata["feature_count"] == 5
    assert loaded.metadata["numerical_features"] == NUMBERS
    assert loaded.metadata["target_column"] == "label"
    assert [s[1] for s in loaded.attribution["slots"]][:4] == NUMBERS
    for uri in bundle._parts(config, "v1_test").values():
        assert os.path.exists(uri)


def test_registry(spark, saved, loaded):
    _, config = saved
    row = bundle.model_info(spark, config.registry_dir, "v1_test").first()
    assert row["model_type"] == "boosted_trees" and row["threshold"] == loaded.threshold
    assert bundle.model_info(spark, config.registry_dir, "nope").count() == 0
    bundle.register(spark, {**loaded.metadata, "packaged_at_utc": "9999", "threshold": 0.9}, config.registry_dir)
    assert bundle.model_info(spark, config.registry_dir).first()["threshold"] == 0.9


def test_missing_version_and_part(spark, saved, tmp_path):
    with pytest.raises(BundleLoadError):
        bundle.load_bundle(spark, "v0", saved[1])
    outcome, _ = saved
    config = ArtifactConfig.below(str(tmp_path / "partial"))
    write_json(spark, {"threshold": .5}, f"{config.threshold_dir('v1')}/threshold")
    with pytest.raises(BundleLoadError):
        bundle.load_bundle(spark, "v1", config)


@pytest.mark.parametrize("threshold,metadata", [(1.5, {}), (None, {}), (.5, {"numerical_features": None})])
def test_invalid_contents(spark, saved, loaded, tmp_path, threshold, metadata):
    outcome, _ = saved
    config = ArtifactConfig.below(str(tmp_path / "bad"))
    record = {**loaded.metadata, **metadata}
    bundle.save_bundle(spark, "v1", outcome.fit.calibrated, outcome.fit.raw, {"threshold": threshold}, record, config)
    with pytest.raises(BundleLoadError):
        bundle.load_bundle(spark, "v1", config)


def test_score(training, loaded):
    rows = scoring.score(training, loaded, ["row_id"], ("low", "high"))
    assert rows.columns == ["row_id", "probability", "prediction", "risk_label", "threshold", "model_version"]
    assert rows.where((F.col("prediction") == 1) != (F.col("risk_label") == "high")).count() == 0
    assert rows.where((F.col("probability") >= loaded.threshold) != (F.col("prediction") == 1)).count() == 0
    with pytest.raises(SchemaValidationError):
        scoring.score(training.drop("num_0"), loaded, ["row_id"])


def test_scoring_is_narrow(training, loaded):
    plan = scoring.score(training, loaded, ["row_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_explain_one_and_many_rows(training, loaded):
    row = scoring.explain(training.where("row_id = 3"), loaded, ["row_id"], top_n=2).first()
    assert len(row["top_features"]) == 2 and row["explanation_note"]
    assert {"feature", "impact", "direction", "value"} == set(row["top_features"][0].asDict())
    assert 0 <= row["prediction_probability"] <= 1
    many = scoring.explain(training, loaded, ["row_id"], top_n=5)
    assert many.count() == 300
    again = many.where("row_id = 3").first()
    assert [r["impact"] for r in again["top_features"]][:2] == [r["impact"] for r in row["top_features"]]


def test_stream_equals_batch(spark, training, loaded, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    training.where("row_id < 100").write.parquet(source)
    rows = stream.feature_stream(spark, source, training.schema)
    scored = stream.score_stream(rows, loaded, ["row_id"])
    stream.write_stream(scored, out, f"{out}-cp").awaitTermination()
    assert spark.read.parquet(out).count() == 100
    # New files are picked up from the checkpoint; old ones are not scored again.
    training.where("row_id >= 100").write.mode("append").parquet(source)
    stream.write_stream(scored, out, f"{out}-cp").awaitTermination()
    batch = scoring.score(training, loaded, ["row_id"])
    assert bundle.reload_differences(batch, spark.read.parquet(out)) == 0
    with pytest.raises(ValueError):
        stream.score_stream(training, loaded, ["row_id"])


def test_explain_stream(spark, training, loaded, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    training.write.parquet(source)
    rows = stream.explain_stream(stream.feature_stream(spark, source, training.schema), loaded, ["row_id"], 3)
    stream.write_stream(rows, out, f"{out}-cp").awaitTermination()
    batch = scoring.explain(training, loaded, ["row_id"], 3)
    assert bundle.reload_differences(batch, spark.read.parquet(out)) == 0
