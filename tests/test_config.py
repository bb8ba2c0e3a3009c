import pytest

from riskframe import config as c


@pytest.mark.parametrize("make", [
    lambda: c.DataConfig(missing_value_threshold=1.5),
    lambda: c.SplitConfig(test_size=0),
    lambda: c.SplitConfig(test_size=.6, validation_size=.4),
    lambda: c.PreprocessingConfig(numerical_impute_strategy="nope"),
    lambda: c.PreprocessingConfig(encode_categorical="hash"),
    lambda: c.PreprocessingConfig(handle_unknown_categorical="keep"),
    lambda: c.PreprocessingConfig(max_categories=0),
    lambda: c.ModelConfig(model_type="forest"),
    lambda: c.ModelConfig(class_imbalance_strategy="smote"),
    lambda: c.CVConfig(n_splits=1),
    lambda: c.TuningConfig(n_iter=0),
    lambda: c.ThresholdConfig(strategy="cost_based"),
    lambda: c.ThresholdConfig(strategy="fixed"),
    lambda: c.ThresholdConfig(strategy="min_recall"),
    lambda: c.ThresholdConfig(search_start=.5, search_stop=.4),
    lambda: c.ThresholdConfig(fixed_threshold=2.0),
    lambda: c.CalibrationConfig(method="spline"),
    lambda: c.CalibrationConfig(calibration_holdout_size=1.0),
    lambda: c.ExplainabilityConfig(top_n_local_features=0),
])
def test_invalid_settings_fail_early(make):
    with pytest.raises(ValueError):
        make()


def test_sections_are_checked_together():
    config = c.Config()
    with pytest.raises(ValueError):
        config.validate()
    config.data.target_column, config.data.id_columns = "y", ["id"]
    config.validate()
    config.split.validation_size = .55
    with pytest.raises(ValueError):
        config.validate()
    config.split.validation_size = .1
    config.validate()
    config.calibration.calibration_holdout_size = .9
    with pytest.raises(ValueError):
        config.validate()


def test_messages_name_the_setting_and_its_values():
    with pytest.raises(ValueError, match=r"SplitConfig.test_size: 0 is not in \(0, 1\)"):
        c.SplitConfig(test_size=0)
    with pytest.raises(ValueError, match="CVConfig.n_splits: None"):
        c.CVConfig(n_splits=None)


def test_sections_do_not_share_defaults():
    c.DataConfig().id_columns.append("k")
    assert c.DataConfig().id_columns == []


def test_threshold_grid_and_arguments():
    grid = c.ThresholdConfig().grid()
    assert len(grid) == 99 and grid[28] == 0.29 and grid[-1] == 0.99
    assert c.ThresholdConfig(strategy="cost_based", cost_fp=1, cost_fn=5).arguments() == {"cost_fp": 1, "cost_fn": 5}


def test_folders_below_a_root():
    a = c.ArtifactConfig.below("/data/", model_name="m")
    assert a.model_dir("v1") == "/data/artifacts/models/m/v1"
    assert a.registry_dir == "/data/artifacts/registry"
