"""Settings of the engine, one section per stage.

A field names the values it takes in its metadata, and one walker checks every section when it is
made. The target, the keys and the features of a table come from the caller or from its schema.
"""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass
from typing import Any

# Names of the accepted options.
NUMERICAL_STRATEGIES = ("mean", "median", "most_frequent", "constant")
CATEGORICAL_STRATEGIES = ("most_frequent", "constant")
ENCODINGS = ("onehot", "ordinal")
ONEHOT_DROPS = (None, "first", "if_binary")
UNKNOWN_CATEGORIES = ("ignore", "error")
MODEL_TYPES = ("logistic_regression", "boosted_trees")
IMBALANCE_STRATEGIES = (None, "balanced", "class_weight", "scale_pos_weight")
VALIDATION_STRATEGIES = ("oof", "holdout")
CALIBRATION_METHODS = ("sigmoid", "isotonic")
CALIBRATION_STRATEGIES = ("prefit", "cv")
#: Threshold strategies, each with the settings it cannot do without.
THRESHOLD_ARGUMENTS: dict[str, tuple[str, ...]] = {
    "maximize_f1": (), "min_recall": ("min_recall",), "min_precision": ("min_precision",),
    "cost_based": ("cost_fp", "cost_fn"), "youden_j": (), "fixed": ("fixed_threshold",),
}
THRESHOLD_STRATEGIES = tuple(THRESHOLD_ARGUMENTS)


def _setting(default: Any, among: tuple | None = None, within: str | None = None) -> Any:
    """A field that takes one of ``among``, or a number in the interval ``within`` such as ``"(0, 1]"``.

    A default that is a list or dict is copied for each section.
    """
    metadata = {"among": among, "within": within}
    if isinstance(default, (list, dict)):
        return dataclasses.field(default_factory=lambda: type(default)(default), metadata=metadata)
    return dataclasses.field(default=default, metadata=metadata)


def _inside(value: float, interval: str) -> bool:
    low, high = (float(end) for end in interval[1:-1].split(","))
    above = value > low if interval[0] == "(" else value >= low
    below = value < high if interval[-1] == ")" else value <= high
    return above and below


class Section:
    """Checks the fields of a section, then what the section says of several fields together."""

    def __post_init__(self) -> None:
        for spec in dataclasses.fields(self):
            value = getattr(self, spec.name)
            among, within = spec.metadata.get("among"), spec.metadata.get("within")
            name = f"{type(self).__name__}.{spec.name}"
            if among is not None and value not in among:
                raise ValueError(f"{name}: no option {value!r}, the options are {among}")
            if within is None or (value is None and spec.default is None):
                continue
            if value is None or not _inside(value, within):
                raise ValueError(f"{name}: {value!r} is not in {within}")
        for holds, problem in self.relations():
            if not holds:
                raise ValueError(f"{type(self).__name__}: {problem}")

    def relations(self) -> list[tuple[bool, str]]:
        """Conditions over several fields, each with what is wrong if it fails."""
        return []


# ---- the table ---------------------------------------------------------------------------


@dataclass
class DataConfig(Section):
    data_path: str = ""
    data_format: str = "csv"
    target_column: str | None = None
    id_columns: list[str] = _setting([])
    excluded_columns: list[str] = _setting([])
    valid_target_values: list[Any] | None = None
    # With one of these the column types are not inferred; together they name every feature.
    numerical_columns: list[str] | None = None
    categorical_columns: list[str] | None = None
    missing_value_threshold: float = _setting(0.4, within="[0, 1]")
    duplicate_check: bool = True


@dataclass
class SplitConfig(Section):
    test_size: float = _setting(0.2, within="(0, 1)")
    validation_size: float = _setting(0.0, within="[0, 1)")
    stratify: bool = True
    random_state: int = 42

    def relations(self) -> list[tuple[bool, str]]:
        return [(self.test_size + self.validation_size < 1, "the test and validation parts leave no row to train on")]


@dataclass
class PreprocessingConfig(Section):
    numerical_impute_strategy: str = _setting("median", NUMERICAL_STRATEGIES)
    numerical_fill_value: float = 0.0
    scale_numerical: bool = True
    categorical_impute_strategy: str = _setting("most_frequent", CATEGORICAL_STRATEGIES)
    categorical_fill_value: str = "missing_value"
    encode_categorical: str = _setting("onehot", ENCODINGS)
    onehot_drop: str | None = _setting(None, ONEHOT_DROPS)
    # What becomes of a category that the training rows do not have.
    handle_unknown_categorical: str = _setting("ignore", UNKNOWN_CATEGORIES)
    # With a limit, more distinct values in one column are an error, never a silent cut.
    max_categories: int | None = _setting(None, within="[1, inf]")
    # Up to so many values in each column the model lists its categories; with more they stay in a table.
    listed_categories: int = _setting(100_000, within="[0, inf]")


# ---- models ------------------------------------------------------------------------------


@dataclass
class ModelConfig(Section):
    model_type: str = _setting("boosted_trees", MODEL_TYPES)
    class_imbalance_strategy: str | None = _setting(None, IMBALANCE_STRATEGIES)
    boosted_trees_params: dict[str, Any] = _setting({"n_estimators": 200, "max_depth": 4, "learning_rate": 0.1})
    logistic_regression_params: dict[str, Any] = _setting({"max_iter": 1000, "C": 1.0})
    random_state: int = 42


@dataclass
class CVConfig(Section):
    n_splits: int = _setting(5, within="[2, inf]")
    random_state: int = 42
    parallelism: int = _setting(4, within="[1, inf]")


@dataclass
class TuningConfig(Section):
    n_iter: int = _setting(50, within="[1, inf]")
    n_splits: int = _setting(5, within="[2, inf]")
    scoring: str = "roc_auc"
    random_state: int = 42
    parallelism: int = _setting(4, within="[1, inf]")
    train_val_gap_warning_threshold: float = 0.10
    param_distributions: dict[str, list[Any]] = _setting({
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [3, 4, 5, 6, 7],
        "learning_rate": [0.01, 0.03, 0.05, 0.1],
        "min_child_weight": [1, 3, 5, 7],
        "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
    })


@dataclass
class CalibrationConfig(Section):
    method: str = _setting("sigmoid", CALIBRATION_METHODS)
    strategy: str = _setting("prefit", CALIBRATION_STRATEGIES)
    calibration_holdout_size: float = _setting(0.25, within="(0, 1)")
    cv_splits: int = _setting(5, within="[2, inf]")
    random_state: int = 42


# ---- decisions and explanations ----------------------------------------------------------


@dataclass
class ThresholdConfig(Section):
    strategy: str = _setting("maximize_f1", THRESHOLD_STRATEGIES)
    min_recall: float | None = None
    min_precision: float | None = None
    cost_fp: float | None = None
    cost_fn: float | None = None
    fixed_threshold: float | None = _setting(None, within="[0, 1]")
    search_start: float = _setting(0.01, within="[0, 1]")
    search_stop: float = _setting(0.99, within="[0, 1]")
    search_step: float = _setting(0.01, within="(0, 1]")
    validation_strategy: str = _setting("oof", VALIDATION_STRATEGIES)
    holdout_size: float = _setting(0.2, within="(0, 1)")

    def relations(self) -> list[tuple[bool, str]]:
        unset = [name for name, value in self.arguments().items() if value is None]
        return [(not unset, f"the strategy {self.strategy} cannot do without {unset}"),
                (self.search_start < self.search_stop, "the search stops before it starts")]

    def arguments(self) -> dict[str, float]:
        """The keyword arguments the chosen strategy takes."""
        return {name: getattr(self, name) for name in THRESHOLD_ARGUMENTS[self.strategy]}

    def grid(self) -> list[float]:
        steps = int(round((self.search_stop - self.search_start) / self.search_step))
        return [round(self.search_start + i * self.search_step, 10) for i in range(steps + 1)]


@dataclass
class ExplainabilityConfig(Section):
    # All rows, unless a sample is asked for.
    global_sample_size: int | None = _setting(None, within="[1, inf]")
    max_display_features: int = _setting(20, within="[1, inf]")
    top_n_local_features: int = _setting(5, within="[1, inf]")
    random_state: int = 42


# ---- folders -----------------------------------------------------------------------------


def _folder(path: str) -> property:
    return property(lambda self: self.under(path))


@dataclass
class ArtifactConfig(Section):
    """Where results go: everything lies below one root."""

    model_name: str = "risk_model"
    root: str = ""

    models_dir = _folder("artifacts/models")
    thresholds_dir = _folder("artifacts/thresholds")
    metadata_dir = _folder("artifacts/metadata")
    registry_dir = _folder("artifacts/registry")
    profile_dir = _folder("reports/eda")
    evaluation_reports_dir = _folder("reports/evaluation")
    calibration_reports_dir = _folder("reports/calibration")
    threshold_reports_dir = _folder("reports/threshold")
    attribution_reports_dir = _folder("reports/attribution")

    @classmethod
    def below(cls, root: str, **changes: Any) -> ArtifactConfig:
        return cls(root=root, **changes)

    def under(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def model_dir(self, version: str) -> str:
        return self.under(self.models_dir, self.model_name, version)

    def threshold_dir(self, version: str) -> str:
        return self.under(self.thresholds_dir, version)

    def metadata_dir_for(self, version: str) -> str:
        return self.under(self.metadata_dir, version)


def _section(kind: type[Section]) -> Any:
    return dataclasses.field(default_factory=kind)


@dataclass
class Config:
    """All sections of a workflow; ``validate`` checks what holds between them."""

    artifacts: ArtifactConfig = _section(ArtifactConfig)
    data: DataConfig = _section(DataConfig)
    split: SplitConfig = _section(SplitConfig)
    preprocessing: PreprocessingConfig = _section(PreprocessingConfig)
    model: ModelConfig = _section(ModelConfig)
    cv: CVConfig = _section(CVConfig)
    tuning: TuningConfig = _section(TuningConfig)
    calibration: CalibrationConfig = _section(CalibrationConfig)
    threshold: ThresholdConfig = _section(ThresholdConfig)
    explainability: ExplainabilityConfig = _section(ExplainabilityConfig)

    def validate(self) -> None:
        missing = [name for name in ("target_column", "id_columns") if not getattr(self.data, name)]
        if missing:
            raise ValueError(f"a workflow needs DataConfig.{' and '.join(missing)}")
        held = self.split.test_size + self.split.validation_size + self.calibration.calibration_holdout_size
        if held >= 1:
            raise ValueError(f"the parts held out of training take {held:g} of the rows, which leaves none")
