import pytest

from riskframe.config import ArtifactConfig, Config, ModelConfig, TuningConfig
from riskframe.errors import DataValidationError
from riskframe.plans import model_job, package_job, profile_job
from riskframe.plans.common import load_and_check, prepare
from riskframe.sources.sinks import read_json
from conftest import model_rows


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    rows, schema = model_rows(240, 2, ["A", "B"], seed=4)
    lines = [",".join(f.split()[0] for f in schema.split(","))]
    for i, r in enumerate(rows):
        values = [str(v) for v in r]
        if i % 11 == 0:
            values[1] = "NA"
        lines.append(",".join(values))
    path = tmp_path_factory.mktemp("csv") / "loans.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def settings(csv, root):
    config = Config()
    config.artifacts = ArtifactConfig.below(root)
    config.data.data_path, config.data.target_column = csv, "label"
    config.data.id_columns = ["row_id"]
    config.model = ModelConfig(boosted_trees_params={"n_estimators": 3, "max_depth": 2, "learning_rate": .3})
    config.cv.n_splits = 3
    config.tuning = TuningConfig(n_iter=2, n_splits=3, param_distributions={"n_estimators": [2, 3], "max_depth": [2]})
    return config


def test_profile(spark, csv, tmp_path):
    tables = profile_job.run(spark, settings(csv, str(tmp_path)), str(tmp_path / "eda"))
    assert {"overview", "numerical_summary", "categorical_summary", "target_distribution", "missing_values",
            "histograms", "correlation", "category_shares"} == set(tables)
    assert read_json(spark, str(tmp_path / "eda/quality_report"))["missing_values"]["num_0"] == 22
    assert spark.read.csv(str(tmp_path / "eda/missing_values"), header=True).count() == 1


def test_errors_stop_the_workflow(spark, csv, tmp_path):
    config = settings(csv, str(tmp_path))
    config.data.valid_target_values = [0.0]
    with pytest.raises(DataValidationError):
        profile_job.run(spark, config, str(tmp_path / "eda"))


def test_model(spark, csv, tmp_path):
    config = settings(csv, str(tmp_path))
    outcome = model_job.run(spark, config, "v1")
    assert outcome.comparison.count() == 2
    assert 0 < outcome.threshold.first()["threshold"] < 1
    assert outcome.test_metrics["roc_auc"] > .6
    report = read_json(spark, f"{config.artifacts.evaluation_reports_dir}/v1/final_test_evaluation")
    assert sum(report["confusion"].values()) == 48
    assert report["best_params"] == outcome.tuning.best_params


def test_package(spark, csv, tmp_path):
    config = settings(csv, str(tmp_path))
    config.threshold.strategy, config.threshold.min_recall = "min_recall", 0.5
    outcome = package_job.run(spark, config, "v2")
    assert outcome.differences == 0 and outcome.bundle.version == "v2"
    assert outcome.bundle.threshold_document["strategy"] == "min_recall"
    assert outcome.importance.summary["n_samples_explained"] == 48

    folder = config.artifacts.attribution_reports_dir
    bar = spark.read.csv(f"{folder}/bar", header=True)
    local = spark.read.csv(f"{folder}/local", header=True, inferSchema=True)
    assert bar.count() == 3 and spark.read.csv(f"{folder}/swarm", header=True).count() > 0
    assert local.select("row_id").distinct().count() == 48 and local.count() == 3 * 48
    assert local.where("prediction != int(prediction_probability >= threshold_used)").isEmpty()


def test_validation_part_is_held_out_and_compared(spark, csv, tmp_path):
    config = settings(csv, str(tmp_path))
    df, _ = load_and_check(spark, config)
    assert prepare(df, config).validation is None
    config.split.validation_size = 0.1
    found = prepare(df, config)
    ids = [{r["row_id"] for r in part.select("row_id").collect()}
           for part in (found.train, found.validation, found.test)]
    assert [len(part) for part in ids] == [168, 24, 48] and len(set.union(*ids)) == 240
    outcome = model_job.run(spark, config, "v3")
    assert outcome.comparison.where("val_roc_auc is null").isEmpty()


def test_missing_threshold_and_type_overrides_take_effect(spark, csv, tmp_path):
    config = settings(csv, str(tmp_path))
    config.data.missing_value_threshold = 0.05
    df, report = load_and_check(spark, config)
    assert any("num_0" in text for text in report.warnings)
    config.data.missing_value_threshold = 0.5
    assert not any("num_0" in text for text in load_and_check(spark, config)[1].warnings)

    found = prepare(df, config)
    numbers, others = found.numerical, found.categorical
    config.data.numerical_columns, config.data.categorical_columns = numbers[1:], [*others, numbers[0]]
    forced = prepare(df, config)
    assert (forced.numerical, forced.categorical) == (numbers[1:], [*others, numbers[0]])
