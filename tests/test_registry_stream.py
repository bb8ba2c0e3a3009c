"""A stream follows the registry: versions change between micro-batches, restarts and repeats add no rows."""

import pytest
from pyspark.sql import functions as F

from riskframe.config import ArtifactConfig, Config, ModelConfig
from riskframe.errors import BundleLoadError
from riskframe.operators import bundle, models
from riskframe.plans import package_job
from riskframe.streaming import registry
from riskframe.streaming import scoring as stream
from conftest import NUMBERS


@pytest.fixture(scope="module")
def packaged(spark, training, tmp_path_factory):
    config = Config()
    config.artifacts = ArtifactConfig.below(str(tmp_path_factory.mktemp("served")))
    config.data.target_column = "label"
    plan = models.model_plan("boosted_trees", NUMBERS, ["category"], model=ModelConfig(
        boosted_trees_params={"n_estimators": 3, "max_depth": 2, "learning_rate": .3}))
    package_job.package(spark, plan, training, ["row_id"], config, "a1")
    return config.artifacts, bundle.load_bundle(spark, "a1", config.artifacts)


def again(spark, packaged, version, at, threshold):
    artifacts, loaded = packaged
    bundle.save_bundle(spark, version, loaded.calibrated, loaded.raw, {**loaded.threshold_document, "threshold": threshold},
                       {**loaded.metadata, "model_version": version, "packaged_at_utc": at, "threshold": threshold}, artifacts)


def test_served_version_is_the_last_registered(spark, packaged, tmp_path):
    artifacts, _ = packaged
    assert registry.served_version(spark, artifacts.registry_dir) == "a1"
    with pytest.raises(BundleLoadError):
        registry.served_version(spark, str(tmp_path / "none"))
    with pytest.raises(BundleLoadError):
        registry.served_version(spark, artifacts.registry_dir, "another model")


def test_version_change_restart_and_repeat(spark, packaged, training, tmp_path):
    artifacts, _ = packaged
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def drain(rows=None, top_n=None):
        if rows is not None:
            rows.coalesce(1).write.mode("append").parquet(source)
        files = stream.feature_stream(spark, source, training.schema)
        registry.follow_registry(files, artifacts, ["row_id"], out, progress, top_n=top_n).awaitTermination()
        return {r["row_id"]: (r["model_version"], r["threshold"], r["batch_id"])
                for r in registry.read_results(spark, out).collect()}, registry.read_results(spark, out).count()

    found, n = drain(training.where("row_id < 100"))
    assert n == 100 and {v[0] for v in found.values()} == {"a1"}
    again(spark, packaged, "a2", "9998", 0.9)
    found, n = drain(training.where("row_id >= 100"))
    assert n == 300
    assert {i for i, v in found.items() if v[0] == "a1"} == set(range(100))
    assert {v[1:] for v in found.values() if v[0] == "a2"} == {(0.9, 1)}
    # The last batch is not committed: it runs again, now with a newer version, and replaces its rows.
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).unlink()
    again(spark, packaged, "a3", "9999", 0.1)
    found, n = drain()
    assert n == 300 and {v[0] for i, v in found.items() if i >= 100} == {"a3"}
    assert drain()[1] == 300


def test_explained_micro_batches(spark, packaged, training, tmp_path):
    artifacts, _ = packaged
    training.where("row_id < 20").coalesce(1).write.parquet(str(tmp_path / "in"))
    files = stream.feature_stream(spark, str(tmp_path / "in"), training.schema)
    registry.follow_registry(files, artifacts, ["row_id"], str(tmp_path / "out"), str(tmp_path / "p"), top_n=2,
                             prepare=lambda df: df.where(F.col("row_id") >= 5)).awaitTermination()
    rows = registry.read_results(spark, str(tmp_path / "out"))
    assert rows.count() == 15 and rows.where(F.size("top_features") != 2).count() == 0
