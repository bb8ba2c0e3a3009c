import pytest

from riskframe.errors import DataValidationError, SchemaValidationError
from riskframe.operators import quality

ROWS = [
    (25.0, 50000, "salaried", 0), (30.0, 60000, "self-employed", 1), (35.0, 70000, "salaried", 0),
    (40.0, 80000, None, 1), (None, 90000, "salaried", 0),
]
SCHEMA = "age double, income bigint, employment_type string, target int"


@pytest.fixture()
def small(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_clean_report(small):
    report = quality.quality_report(small, "target")
    assert not report.has_errors and report.duplicate_rows == 0
    assert report.missing == {"age": 1, "income": 0, "employment_type": 1, "target": 0}
    assert report.missing_fraction["age"] == pytest.approx(0.2)
    assert report.numerical_columns == ["age", "income"]
    assert report.categorical_columns == ["employment_type"]
    assert {r["target"]: r["n"] for r in report.target_distribution.collect()} == {0: 3, 1: 2}


def test_whitelist_violation_is_an_error_entry(spark):
    rows = [(*ROWS[0][:3], 99), *ROWS[1:]]
    report = quality.quality_report(spark.createDataFrame(rows, SCHEMA), "target", [0, 1])
    assert report.has_errors and "99" in report.errors[0]


def test_non_binary_target_warns(spark):
    rows = [(*r[:3], t) for r, t in zip(ROWS, [0, 1, 2, 0, 1])]
    report = quality.quality_report(spark.createDataFrame(rows, SCHEMA), "target")
    assert any("unique values" in w for w in report.warnings)


def test_duplicates_count_all_but_the_first(spark):
    report = quality.quality_report(spark.createDataFrame([*ROWS, ROWS[0], ROWS[0]], SCHEMA), "target")
    assert report.duplicate_rows == 2
    nulls = spark.createDataFrame([(None, float("nan")), (None, float("nan"))], "a int, b double")
    assert quality.duplicate_count(nulls).first()[0] == 1


def test_missing_target(spark, small):
    with pytest.raises(DataValidationError):
        quality.quality_report(small, "nope")
    with pytest.raises(DataValidationError):
        quality.quality_report(small.limit(0), "target")
    with pytest.raises(DataValidationError):
        quality.require_rows(small.limit(0))
    only_missing = spark.createDataFrame([(1, None), (2, None)], "a int, target int")
    report = quality.quality_report(only_missing, "target")
    assert report.has_errors
    partly = spark.createDataFrame([(1, None), (2, 1), (3, 0)], "a int, target int")
    assert any("missing values" in w for w in quality.quality_report(partly, "target").warnings)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert quality.missing_counts(df).first()["missing_count"] == 2
    assert quality.high_missing(df).count() == 1


def test_overrides_have_to_be_complete(small):
    with pytest.raises(ValueError):
        quality.column_types(small.schema, ["target"], numeric_override=["age"])
    assert quality.column_types(
        small.schema, ["target"], ["age"], ["income", "employment_type"],
    ) == (["age"], ["income", "employment_type"])


def test_schema_check(small):
    schema = quality.FeatureSchema(("age", "income"), ("employment_type",))
    schema.validate(small)
    with pytest.raises(SchemaValidationError):
        schema.validate(small.drop("income"))


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a", "x"), ("b", None)], "p string, q string")
    test = spark.createDataFrame([("a", "y"), ("c", None)], "p string, q string")
    assert sorted(map(tuple, quality.unseen_categories(train, test, ["p", "q"]).collect())) == [
        ("p", "c"), ("q", "y")]
