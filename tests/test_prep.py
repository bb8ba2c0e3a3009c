import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.config import PreprocessingConfig
from riskframe.errors import SchemaValidationError
from riskframe.operators import prep

KINDS = ["salaried", "self-employed", "salaried", "unemployed"] * 2


@pytest.fixture(scope="module")
def small(spark):
    rows = [(25 + 5 * i, 50000 + 10000 * i, KINDS[i], i % 2) for i in range(8)]
    return spark.createDataFrame(rows, "age bigint, income bigint, employment_type string, target int").persist()


def matrix(fitted, df):
    return np.array([r[0] for r in fitted.transform(df).orderBy("age").select(vector_to_array("features")).collect()])


def fit(df, family=prep.LINEAR, **config):
    return prep.fit_preprocessor(df, ["age", "income"], ["employment_type"], PreprocessingConfig(**config), family)


def test_scaling_for_linear_models_only(small):
    x = matrix(fit(small), small)
    assert x[:, :2].mean(axis=0) == pytest.approx([0, 0], abs=1e-12)
    assert x[:, :2].std(axis=0) == pytest.approx([1, 1])
    assert matrix(fit(small, prep.TREE), small)[:, 0].tolist() == [25.0 + 5 * i for i in range(8)]


def test_names_and_map(spark, small):
    fitted = fit(small)
    assert fitted.feature_names == [
        "numerical__age", "numerical__income", "categorical__employment_type_salaried",
        "categorical__employment_type_self-employed", "categorical__employment_type_unemployed"]
    rows = fitted.feature_map(spark).orderBy("slot").collect()
    assert [r["original"] for r in rows] == ["age", "income"] + ["employment_type"] * 3


def test_unseen_and_missing_categories(spark, small):
    fitted = fit(small)
    new = spark.createDataFrame([(1, 1, "freelancer"), (2, 2, None)], "age bigint, income bigint, employment_type string")
    x = matrix(fitted, new)
    assert x[0, 2:].tolist() == [0, 0, 0]
    # The most frequent category fills the gap.
    assert x[1, 2:].tolist() == [1, 0, 0]


def test_missing_column(small):
    with pytest.raises(SchemaValidationError):
        fit(small).transform(small.drop("income"))
    with pytest.raises(ValueError):
        prep.Preprocessor([], [])


def test_statistics_come_from_training_rows(spark, small):
    train = small.where("age < 50")
    fitted = fit(train)
    again = fit(small.where("age < 50"))
    assert np.array_equal(matrix(fitted, small), matrix(again, small))
    far = spark.createDataFrame([(10 ** 6, 10 ** 9, "unemployed", 1)], small.schema)
    assert np.array_equal(matrix(fitted, train.union(far))[:-1], matrix(fitted, train))


@pytest.mark.parametrize("strategy,value", [("mean", 4.0), ("median", 3.0), ("most_frequent", 1.0), ("constant", 0.0)])
def test_numeric_imputation(spark, strategy, value):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0, None, float("nan"))], "age double")
    fitted = prep.fit_preprocessor(
        df, ["age"], [], PreprocessingConfig(numerical_impute_strategy=strategy), prep.TREE)
    x = [r[0][0] for r in fitted.transform(df).select(vector_to_array("features")).collect()]
    assert x == [1.0, 2.0, 4.0, 9.0, value, value]


def test_scaling_counts_imputed_rows(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0, None, None)], "age double")
    fitted = prep.fit_preprocessor(df, ["age"], [])
    x = np.array([r[0][0] for r in fitted.transform(df).select(vector_to_array("features")).collect()])
    raw = np.array([1, 2, 4, 9, 3, 3.0])
    assert x == pytest.approx((raw - raw.mean()) / raw.std())


def test_constant_category_and_drops(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    config = PreprocessingConfig(categorical_impute_strategy="constant", categorical_fill_value="it's none")
    fitted = prep.fit_preprocessor(df, [], ["c"], config)
    assert fitted.feature_names == ["categorical__c_a", "categorical__c_b", "categorical__c_it's none"]
    first = prep.fit_preprocessor(df, [], ["c"], PreprocessingConfig(onehot_drop="if_binary"))
    assert first.feature_names == ["categorical__c_b"]
    x = [r[0] for r in first.transform(df).select(vector_to_array("features")).collect()]
    assert x == [[1.0], [0.0], [0.0]]


def test_ordinal(spark, small):
    fitted = fit(small, prep.TREE, encode_categorical="ordinal")
    new = spark.createDataFrame([(1, 1, "unemployed"), (2, 2, "other")], "age bigint, income bigint, employment_type string")
    assert matrix(fitted, new)[:, 2].tolist() == [2.0, 3.0]


def test_empty_column_is_dropped(spark):
    df = spark.createDataFrame([(1.0, None, None), (2.0, None, None)], "a double, b double, c string")
    assert prep.fit_preprocessor(df, ["a", "b"], ["c"]).feature_names == ["numerical__a"]


def test_too_many_categories_is_an_error(small):
    with pytest.raises(ValueError, match="max_categories"):
        fit(small, max_categories=2)


def test_save_and_load(small, tmp_path):
    fitted = fit(small)
    fitted.save(str(tmp_path / "prep"))
    loaded = prep.FittedPreprocessor.load(str(tmp_path / "prep"))
    assert loaded.slots == fitted.slots and loaded.schema == fitted.schema
    assert np.array_equal(matrix(loaded, small), matrix(fitted, small))


def test_constant_columns_scale_to_zero(spark):
    rows = spark.range(50_000).select((F.lit(1e6) / 3).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    got = prep.scale_statistics(rows, ["x", "y"], {"x": 0.0, "y": 0.0})
    assert got["x"] == (1e6 / 3, 1.0)
    assert got["y"] == pytest.approx((0.5, 0.5))


def test_unknown_categories_stop_scoring_if_asked(spark):
    schema = "x double, c string, d string"
    train = spark.createDataFrame([(1.0, "a", "p"), (2.0, "b", "p"), (3.0, "a", "q"), (4.0, "c", "q")], schema)
    new = spark.createDataFrame([(1.0, "z", "p")], schema)
    for encoding in ("onehot", "ordinal"):
        lenient, strict = (
            prep.fit_preprocessor(train, ["x"], ["c", "d"], PreprocessingConfig(
                encode_categorical=encoding, handle_unknown_categorical=policy)) for policy in ("ignore", "error"))
        assert lenient.feature_names == strict.feature_names
        one, other = ([r["features"].toArray().tolist() for r in fitted.transform(train).orderBy("x").collect()]
                      for fitted in (lenient, strict))
        assert one == other
        assert lenient.transform(new).count() == 1
        with pytest.raises((PySparkException, Py4JJavaError)):
            strict.transform(new).collect()
