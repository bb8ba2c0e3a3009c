"""The registered queries: every operator on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.config import ArtifactConfig, CalibrationConfig, Config, CVConfig, ModelConfig, TuningConfig
from riskframe.functions.columns import kept
from riskframe.functions.local import local_table
from riskframe.operators import (
    attribution, bundle, calibration, metrics, models, prep, profile, quality, scoring, split, threshold, tuning,
)
from riskframe.operators.isotonic import pooled_blocks
from riskframe.operators.prep import FEATURES
from riskframe.plans import package_job, profile_job
from riskframe.session import scratch_path
from riskframe.sources import tables, views
from riskframe.streaming import registry
from riskframe.streaming import scoring as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 42
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CATEGORIES = ["l_returnflag", "l_linestatus"]
DUPLICATE_COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
APPLICANT_NUMBERS = ["n_orders", "total_price", "max_price"]
APPLICANT_CATEGORIES = ["c_nationkey", "c_mktsegment", "last_status"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as bigint and fractions rounded, so that results compare by value."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.LongType)) or (
                isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        columns.append(c.alias(f.name))
    return df.select(*columns)


# Quality


@query
def missing_counts(spark, d):
    return plain(quality.missing_counts(views.lines_nulled(spark, d)))


@query
def missing_report(spark, d):
    return plain(profile.missing_report(views.lines_nulled(spark, d)))


@query
def high_missing(spark, d):
    return plain(quality.high_missing(views.docs(spark, d)))


@query
def high_missing_strict(spark, d):
    return plain(quality.high_missing(views.lines_nulled(spark, d), above=0.1))


@query
def duplicate_count(spark, d):
    return plain(quality.duplicate_count(views.lines_nulled(spark, d).select(*DUPLICATE_COLUMNS)))


@query
def duplicate_count_wide(spark, d):
    """Whole line items, of which every seventh order comes twice."""
    lines = views.table(spark, d, "lineitem")
    return plain(quality.duplicate_count(lines.union(lines.where(F.col("l_orderkey") % 7 == 0))))


@query
def target_distribution(spark, d):
    return plain(quality.target_distribution(views.docs(spark, d), "quality"))


@query
def target_check(spark, d):
    return plain(quality.target_check(views.docs(spark, d), "quality"))


@query
def target_check_whitelist(spark, d):
    return plain(quality.target_check(views.table(spark, d, "lineitem"), "l_returnflag", ["A", "N"]))


@query
def quality_report(spark, d):
    return quality.quality_report(views.docs(spark, d), "quality").table()


@query
def schema_typing(spark, d):
    lines = views.lines_nulled(spark, d)
    numerical, categorical = quality.column_types(lines.schema)
    kinds = local_table(
        spark, [(c, "numerical") for c in numerical] + [(c, "categorical") for c in categorical],
        "column string, kind string")
    return plain(profile.overview(lines).join(F.broadcast(kinds), "column"))


@query
def csv_typing(spark, d):
    """Types and values found in line items that arrive as text, with missing tokens and suffixed numbers."""
    lines = views.table(spark, d, "lineitem")
    text = F.col("l_linenumber").cast("string")
    strings = lines.select(
        F.col("l_orderkey").cast("string").alias("whole"), F.col("l_extendedprice").cast("string").alias("decimal"),
        F.when(F.col("l_linenumber") == 1, F.lit("NA")).otherwise(text).alias("gaps"),
        F.concat(text, F.lit("d")).alias("suffixed"),
        F.when(F.col("l_linenumber") > 1, F.lit("True")).otherwise(F.lit("false")).alias("flag"),
        F.lit("n/a").alias("nothing"))
    typed = tables.type_strings(strings)
    kinds = local_table(spark, [(f.name, f.dataType.simpleString()) for f in typed.schema.fields],
                        "column string, dtype string")
    values = typed.select(*[F.struct(F.col(c).cast("string").alias("text"), F.col(c).try_cast("double").alias("number"))
                            .alias(c) for c in typed.columns])
    found = values.agg(*[F.struct(F.count(f"{c}.text").alias("filled"), F.round(F.sum(f"{c}.number"), 2).alias("total"))
                         .alias(c) for c in typed.columns])
    long = found.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}.filled"),
                 F.when(F.lit(typed.schema[c].dataType.simpleString() in ("bigint", "double")), F.col(f"{c}.total"))
                 .alias("total")) for c in typed.columns])).alias("c")).select("c.*")
    return long.join(kinds, "column")


@query
def unseen_categories(spark, d):
    documents = views.table(spark, d, "documents")
    parts = split.assign_parts(
        documents.select("doc_id", "lang", F.concat_ws("-", "source", "lang").alias("origin")),
        "lang", ["doc_id"], 0.6, seed=SEED)
    return quality.unseen_categories(
        parts.where("part = 'train'"), parts.where("part = 'test'"), ["lang", "origin"])


@query
def profile_workflow(spark, d):
    """The first workflow from a CSV file on: its written tables as rows of (table, key, name, value)."""
    folder = scratch_path(spark, "profile")
    views.docs(spark, d).drop("toxic").write.option("header", True).csv(f"{folder}/input")
    config = Config()
    config.data.data_path, config.data.target_column = f"{folder}/input", "quality"
    profile_job.run(spark, config, f"{folder}/out")

    def rows(name, key, columns):
        table = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/out/{name}")
        return table.select(F.lit(name).alias("table"), F.col(key).alias("key"), F.posexplode(F.array(
            *[F.col(c).cast("string") for c in columns])).alias("place", "value")).select(
            "table", "key", F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place") + 1).alias("name"), "value")

    return (rows("quality_table", "check", ["column", "value", "severity"])
            .union(rows("missing_values", "column", ["missing_count"]))
            .union(rows("overview", "column", ["position", "dtype", "n_rows", "n_columns"]))
            .union(rows("categorical_summary", "column", ["n_unique", "top_value", "top_frequency", "n_missing"]))
            .union(rows("target_distribution", "target", ["n"])).where("value is not null"))


# Profiling


@query
def numeric_summary(spark, d):
    return plain(profile.numeric_summary(views.lines_nulled(spark, d), LINE_NUMBERS), 4)


@query
def categorical_summary(spark, d):
    return plain(profile.categorical_summary(views.lines_nulled(spark, d), LINE_CATEGORIES))


@query
def category_shares(spark, d):
    columns = ["l_suppkey", *LINE_CATEGORIES]
    return plain(profile.category_shares(views.lines_nulled(spark, d), columns))


@query
def histogram30(spark, d):
    return plain(profile.histogram(views.lines_nulled(spark, d), LINE_NUMBERS), 4)


@query
def correlation(spark, d):
    return plain(profile.correlation(views.lines_nulled(spark, d), LINE_NUMBERS))


WIDE_COLUMNS = 48


def _wide_terms(i):
    """Factors of quantity, price, discount and tax, and two moduli of the part key, for the i-th wide column."""
    return i % 7, (i % 5 - 2) / 1000, 100 * (i % 3), 50 * (i % 4 - 1), i + 3, i + 5


@query
def correlation_wide(spark, d):
    """All pairs of many columns with gaps, from one scan of blocked cross products."""
    columns = []
    for i in range(WIDE_COLUMNS):
        q, p, r, t, mod, gap = _wide_terms(i)
        value = (F.lit(float(q)) * F.col("l_quantity") + F.lit(p) * F.col("l_extendedprice")
                 + F.lit(float(r)) * F.col("l_discount") + F.lit(float(t)) * F.col("l_tax") + F.col("l_partkey") % mod)
        columns.append(F.when(F.col("l_partkey") % gap != 0, value).alias(f"w{i}"))
    wide = views.table(spark, d, "lineitem").select(*columns)
    return plain(profile.correlation(wide, wide.columns))


# Projection, split, sampling


@query
def feature_projection(spark, d):
    return plain(split.feature_projection(
        views.applicants(spark, d), "target", ["c_acctbal", "no_such_column"]), 2)


@query
def stratified_split(spark, d):
    parts = split.assign_parts(views.applicants(spark, d), "target", ["c_custkey"], 0.2, seed=SEED)
    return plain(parts.select("c_custkey", "target", "part"))


@query
def three_way_split(spark, d):
    parts = split.assign_parts(views.labelled_docs(spark, d), "label", ["doc_id"], 0.2, 0.15, SEED)
    return plain(parts.select("doc_id", F.col("label").cast("int").alias("label"), "part"))


@query
def split_balance(spark, d):
    parts = split.assign_parts(views.applicants(spark, d), "target", ["c_custkey"], 0.2, seed=SEED)
    return plain(split.part_balance(parts, "part", "target"))


@query
def orders_split(spark, d):
    """A split of the largest keyed table, by order status."""
    orders = views.table(spark, d, "orders")
    parts = split.assign_parts(orders, "o_orderstatus", ["o_orderkey"], 0.2, seed=SEED)
    return plain(split.part_balance(parts, "part", "o_orderstatus"))


@query
def kfold_assignment(spark, d):
    folded = split.assign_folds(views.applicants(spark, d), "target", ["c_custkey"], 5, SEED)
    return plain(folded.select("c_custkey", "target", "fold"))


@query
def kfold_sizes(spark, d):
    folded = split.assign_folds(views.labelled_docs(spark, d), "label", ["doc_id"], 5, SEED)
    return plain(folded.groupBy("fold", F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n")))


@query
def seeded_sample(spark, d):
    return plain(split.sample_rows(views.table(spark, d, "orders"), 500, ["o_orderkey"], SEED), 2)


# Preprocessing


def _lines_with(spark, d, column, fill, dtype):
    lines = views.lines_nulled(spark, d)
    value = prep.filled(lines, column, fill(lines), dtype)
    return plain(lines.select(*LINE_KEYS, value.alias(column)), 4)


def _impute_number(strategy):
    def fill(lines):
        return prep.numeric_fill(lines, ["l_quantity"], strategy)["l_quantity"]
    return lambda spark, d: _lines_with(spark, d, "l_quantity", fill, "double")


for _strategy in ("mean", "median", "most_frequent", "constant"):
    QUERIES[f"impute_{_strategy}"] = _impute_number(_strategy)


@query
def impute_category_mode(spark, d):
    return _lines_with(spark, d, "l_linestatus",
                       lambda lines: prep.modes(lines, ["l_linestatus"])["l_linestatus"], "string")


@query
def impute_category_constant(spark, d):
    return _lines_with(spark, d, "l_linestatus", lambda lines: "missing_value", "string")


@query
def scale_numeric(spark, d):
    lines = views.lines_nulled(spark, d)
    fill = prep.numeric_fill(lines, LINE_NUMBERS, "median")
    moments = prep.scale_statistics(lines, LINE_NUMBERS, fill)
    return plain(lines.select(*LINE_KEYS, *[
        ((prep.filled(lines, c, fill[c], "double") - F.lit(moments[c][0])) / F.lit(moments[c][1])).alias(c)
        for c in LINE_NUMBERS]), 4)


def _applicant_parts(spark, d):
    return split.assign_parts(views.applicants(spark, d), "target", ["c_custkey"], 0.2, seed=SEED)


def _transformed_long(spark, d, config, family=prep.TREE):
    """(c_custkey, transformed, value) of the categorical features, zeros left out."""
    parts = _applicant_parts(spark, d)
    fitted = prep.fit_preprocessor(
        parts.where("part = 'train'"), APPLICANT_NUMBERS, APPLICANT_CATEGORIES, config, family)
    names = F.array(*[F.lit(n) for n in fitted.feature_names])
    values = fitted.transform(parts).select(
        "c_custkey", F.posexplode(vector_to_array(FEATURES)).alias("slot", "value"))
    return values.select("c_custkey", F.element_at(names, F.col("slot") + 1).alias("transformed"), "value").where(
        F.col("transformed").startswith("categorical__") & (F.col("value") != 0))


@query
def onehot_long(spark, d):
    return plain(_transformed_long(spark, d, prep.PreprocessingConfig()))


@query
def onehot_drop_first(spark, d):
    return plain(_transformed_long(spark, d, prep.PreprocessingConfig(onehot_drop="first")))


@query
def ordinal_encode(spark, d):
    return plain(_transformed_long(spark, d, prep.PreprocessingConfig(encode_categorical="ordinal")))


@query
def feature_map(spark, d):
    parts = _applicant_parts(spark, d)
    fitted = prep.fit_preprocessor(
        parts.where("part = 'train'"), APPLICANT_NUMBERS, APPLICANT_CATEGORIES)
    return plain(fitted.feature_map(spark))


@query
def category_dictionary(spark, d):
    """Orders as a category: a dictionary table instead of lists, and sparse vectors from its slots."""
    lines = views.lines_nulled(spark, d)
    fitted = prep.fit_preprocessor(
        lines.where(F.col("l_partkey") % 3 != 0), ["l_quantity"], ["l_orderkey", "l_linestatus"],
        prep.PreprocessingConfig(listed_categories=1000), prep.TREE)
    return plain(fitted.sparse(lines).select(
        *LINE_KEYS, F.col("features.size").alias("n_features"), F.element_at("features.values", 1).alias("quantity"),
        F.array_join(F.col("features.indices").cast("array<string>"), ",").alias("slots")), 4)


# Class weights


@query
def class_ratio(spark, d):
    return plain(models.class_ratio(views.labelled_docs(spark, d)))


@query
def class_weights(spark, d):
    rows = views.labelled_docs(spark, d, "toxic")
    table = [(s, c, w) for s in ("balanced", "scale_pos_weight")
             for c, w in models.class_weights(rows, s).items()]
    return plain(local_table(spark, table, "strategy string, label double, weight double"))


# Metrics on scored rows


def _decided(spark, d):
    return threshold.apply_threshold(views.scored(spark, d), 0.5, "p0", "pred")


@query
def confusion(spark, d):
    return plain(metrics.confusion(_decided(spark, d)))


@query
def prf_metrics(spark, d):
    return plain(metrics.prf_metrics(_decided(spark, d)).select("precision", "recall", "f1"))


def _single_metric(name):
    return lambda spark, d: plain(
        metrics.classification_metrics(views.scored(spark, d), "label", "p0").select(name))


for _name, _metric in (("roc_auc", "roc_auc"), ("average_precision", "pr_auc"),
                       ("brier", "brier_score"), ("log_loss", "log_loss")):
    QUERIES[_name] = _single_metric(_metric)


@query
def all_metrics(spark, d):
    return plain(metrics.classification_metrics(views.scored(spark, d), "label", "p0"))


@query
def grouped_metrics(spark, d):
    """Metrics per group from one pass, as for the folds of a cross-validation."""
    lines = views.table(spark, d, "lineitem")
    rows = lines.select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.round((F.col("l_tax") + F.col("l_discount")) * 5, 4).alias("p"))
    return plain(metrics.classification_metrics(rows, group_cols=["l_linestatus"]))


@query
def single_class_metrics(spark, d):
    """Score metrics are NULL where one class is all there is."""
    rows = views.scored(spark, d).where("label = 0")
    return plain(metrics.classification_metrics(rows, "label", "p0"))


@query
def roc_curve(spark, d):
    points = metrics.roc_curve(views.scored(spark, d), "label", "p0", drop_collinear=False)
    return plain(_finite(points))


@query
def roc_curve_pruned(spark, d):
    return plain(_finite(metrics.roc_curve(views.scored(spark, d), "label", "p0")))


def _finite(points):
    """The start point's infinite threshold as NULL."""
    finite = F.when(F.col("threshold") < F.lit(float("inf")), F.col("threshold"))
    return points.withColumn("threshold", finite)


@query
def pr_curve(spark, d):
    return plain(metrics.pr_curve(views.scored(spark, d), "label", "p0"))


# Thresholds


def _sweep(spark, d):
    return threshold.sweep(views.scored(spark, d), "label", "p0")


@query
def threshold_sweep(spark, d):
    return plain(_sweep(spark, d))


def _selected(strategy, **kw):
    def run(spark, d):
        _, chosen = threshold.choose(views.scored(spark, d), strategy, "label", "p0", **kw)
        return plain(chosen.drop("rationale"))
    return run


for _name, _strategy, _kw in (
    ("threshold_max_f1", "maximize_f1", {}),
    ("threshold_min_recall", "min_recall", {"min_recall": 0.8}),
    ("threshold_min_precision", "min_precision", {"min_precision": 0.33}),
    ("threshold_cost", "cost_based", {"cost_fp": 1.0, "cost_fn": 5.0}),
    ("threshold_youden", "youden_j", {}),
    ("threshold_fixed", "fixed", {"fixed_threshold": 0.425}),
):
    QUERIES[_name] = _selected(_strategy, **_kw)


@query
def apply_threshold(spark, d):
    decided = threshold.apply_threshold(views.scored(spark, d), 0.29, "p1")
    return plain(decided.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n")))


@query
def threshold_tradeoff(spark, d):
    return plain(threshold.tradeoff_table(_sweep(spark, d), 0.304).select(
        "threshold", "precision", "recall", "f1", F.col("selected").cast("int").alias("selected")))


# Calibration on given scores


@query
def calibration_compare(spark, d):
    return plain(calibration.compare(views.scored(spark, d), "p0", "p1").drop("interpretation"))


@query
def reliability_curve(spark, d):
    return plain(calibration.reliability_curve(views.scored(spark, d), "p0", "p1"))


@query
def probability_histogram(spark, d):
    return plain(calibration.probability_histogram(views.scored(spark, d), "p0", "p1"))


@query
def isotonic(spark, d):
    """Distinct scores with their isotonic fit."""
    rows = views.scored(spark, d)
    fitted = calibration.fit_score_calibrator(rows, "p0", "isotonic")
    scores = rows.groupBy("p0").agg(F.count(F.lit(1)).alias("n"))
    return plain(calibration.calibrate_scores(fitted, scores))


@query
def isotonic_ranges(spark, d):
    """The fit of many distinct scores, pooled by ranges: its blocks."""
    scores = views.table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_quantity") > 25).cast("int").alias("label"))
    summed = scores.groupBy("score").agg(F.avg("label").alias("y"), F.count(F.lit(1)).cast("double").alias("w"))
    return plain(pooled_blocks(summed).drop("part"), 5)


@query
def platt(spark, d):
    """Distinct scores with their sigmoid fit."""
    rows = views.scored(spark, d)
    fitted = calibration.fit_score_calibrator(rows, "p0", "sigmoid")
    scores = rows.groupBy("p0").agg(F.count(F.lit(1)).alias("n"))
    return plain(calibration.calibrate_scores(fitted, scores))


@query
def platt_gradient(spark, d):
    """The gradient of the smoothed log loss at the fitted sigmoid: two zeros at the optimum."""
    rows = views.scored(spark, d)
    fitted = calibration.fit_score_calibrator(rows, "p0", "sigmoid")
    totals = rows.agg(F.sum("label").alias("P"), F.sum(1 - F.col("label")).alias("N")).first()
    high, low = (totals["P"] + 1) / (totals["P"] + 2), 1 / (totals["N"] + 2)
    miss = F.col(calibration.CALIBRATED) - F.when(F.col("label") == 1, high).otherwise(low)
    return plain(calibration.calibrate_scores(fitted, rows).agg(
        F.abs(F.avg(miss)).alias("intercept_gradient"), F.abs(F.avg(miss * F.col("p0"))).alias("slope_gradient"),
        F.count(F.lit(1)).alias("n")))


# Models. The training table is the labelled documents; one bundle per data
# folder is fitted and saved, and the scoring queries load it.

DOC_NUMBERS = ["n_chars", "letter_share", "distinct_share"]
DOC_CATEGORIES = ["lang", "source"]
DOC_KEYS = ["doc_id"]
VERSION = "v1"
BOOSTING = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1}
SEARCH_SPACE = {"n_estimators": [5, 10], "max_depth": [2, 3], "learning_rate": [0.1, 0.2]}


def _training(spark, d):
    """Training and test rows of the labelled documents."""
    return split.train_test_split(views.labelled_docs(spark, d), "label", DOC_KEYS, 0.2, SEED)


def _plan(name):
    return models.model_plan(
        name, DOC_NUMBERS, DOC_CATEGORIES, model=ModelConfig(boosted_trees_params=dict(BOOSTING)))


_SAVED: dict[tuple[str, str], tuple[bundle.Bundle, ArtifactConfig]] = {}


def _bundle(spark, d):
    """The bundle of a data folder: fitted, saved and loaded on first use in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SAVED:
        train, _ = _training(spark, d)
        config = Config()
        config.artifacts = ArtifactConfig.below(scratch_path(spark, "bundle"))
        config.data.target_column = "quality"
        plan = _plan("boosted_trees")
        fit = calibration.fit_calibrated(plan, train, DOC_KEYS)
        with kept(fit.calibrated.score(fit.raw.score(fit.calibration_rows))) as rows:
            report = calibration.compare(rows, models.SCORE, calibration.CALIBRATED).first().asDict()
            _, chosen = threshold.choose(rows, "maximize_f1", proba=calibration.CALIBRATED)
        loaded = package_job.save_version(
            spark, plan, fit, chosen.first().asDict(), report, config, VERSION)
        _SAVED[key] = loaded, config.artifacts
    return _SAVED[key]


def _all_docs(spark, d):
    return views.with_text_features(views.table(spark, d, "documents"))


@query
def train_lr(spark, d):
    """(slot, transformed, coefficient), the intercept as slot -1."""
    train, _ = _training(spark, d)
    fitted = _plan("logistic_regression").fit(train)
    rows = [(-1, "intercept", float(fitted.classifier.intercept))]
    rows += [(i, n, float(fitted.classifier.coefficients[i])) for i, n in enumerate(fitted.prep.feature_names)]
    return plain(local_table(spark, rows, "slot int, transformed string, coefficient double"))


@query
def lr_gradient(spark, d):
    """The gradient of the penalised loss per slot at the fitted coefficients: zero at the optimum."""
    train, _ = _training(spark, d)
    fitted = _plan("logistic_regression").fit(train)
    scored = fitted.prep.transform(fitted.score(train))
    names = F.array(*[F.lit(n) for n in fitted.prep.feature_names])
    weights = F.array(*[F.lit(float(w)) for w in fitted.classifier.coefficients])
    miss = F.col(models.SCORE) - F.col("label")
    cells = scored.select(
        F.posexplode(F.transform(vector_to_array(FEATURES), lambda x: x * miss)).alias("slot", "g"))
    sums = cells.groupBy("slot").agg(F.sum("g").alias("g"))
    return plain(sums.select(
        F.element_at(names, F.col("slot") + 1).alias("transformed"),
        F.abs(F.round(F.col("g") + F.element_at(weights, F.col("slot") + 1), 3)).alias("gradient")))


@query
def train_gbt(spark, d):
    train, _ = _training(spark, d)
    return plain(_plan("boosted_trees").fit(train).score(_all_docs(spark, d)).select("doc_id", "p"))


@query
def cv_metrics(spark, d):
    train, _ = _training(spark, d)
    return plain(models.cross_validate(
        _plan("boosted_trees"), train, DOC_KEYS, CVConfig(n_splits=3)).fold_metrics)


@query
def oof_scores(spark, d):
    train, _ = _training(spark, d)
    return plain(models.validation_scores(
        _plan("logistic_regression"), train, DOC_KEYS, CVConfig(n_splits=3)))


@query
def oof_coverage(spark, d):
    """Each training row is scored once, by the model of its own fold."""
    train, _ = _training(spark, d)
    result = models.cross_validate(
        _plan("logistic_regression"), train, DOC_KEYS, CVConfig(n_splits=3))
    return plain(result.oof.select(
        "doc_id", "fold", F.col("label").cast("int").alias("label"),
        F.col("p").between(0, 1).cast("int").alias("scored")))


@query
def holdout_scores(spark, d):
    train, _ = _training(spark, d)
    return plain(models.validation_scores(
        _plan("logistic_regression"), train, DOC_KEYS, strategy="holdout", holdout_size=0.25))


@query
def model_comparison(spark, d):
    train, _ = _training(spark, d)
    entries = []
    for name in ("logistic_regression", "boosted_trees"):
        result = models.cross_validate(_plan(name), train, DOC_KEYS, CVConfig(n_splits=3))
        validation = metrics.classification_metrics(result.oof) if name == "boosted_trees" else None
        entries.append(models.ComparisonEntry(name, result.summary(), result.seconds, validation))
    return plain(models.comparison(entries).drop("training_time_seconds", "limitations"))


@query
def random_search(spark, d):
    train, _ = _training(spark, d)
    config = TuningConfig(n_iter=3, n_splits=3, param_distributions=SEARCH_SPACE)
    result = tuning.random_search(_plan("boosted_trees"), train, DOC_KEYS, config)
    return plain(tuning.top_candidates(result))


def _calibrated(name, method, strategy):
    def run(spark, d):
        train, _ = _training(spark, d)
        config = CalibrationConfig(method=method, strategy=strategy, cv_splits=3)
        fit = calibration.fit_calibrated(_plan(name), train, DOC_KEYS, config)
        return plain(fit.calibrated.score(_all_docs(spark, d)).select("doc_id", calibration.CALIBRATED))
    return run


QUERIES["calibrate_prefit"] = _calibrated("boosted_trees", "sigmoid", "prefit")
QUERIES["calibrate_isotonic"] = _calibrated("logistic_regression", "isotonic", "prefit")
QUERIES["calibrate_cv"] = _calibrated("logistic_regression", "sigmoid", "cv")


@query
def final_test(spark, d):
    """The saved model on the test rows, decided by its threshold."""
    _, test = _training(spark, d)
    loaded, _ = _bundle(spark, d)
    decided = loaded.predict(test)
    return plain(metrics.classification_metrics(
        decided, "label", calibration.CALIBRATED, "prediction"))


# Attribution


@query
def shap_long(spark, d):
    loaded, _ = _bundle(spark, d)
    return plain(loaded.attributor(spark).long(_all_docs(spark, d), DOC_KEYS))


@query
def shap_additivity(spark, d):
    """Attributions plus the expected value are the log-odds of the raw model, for every row."""
    loaded, _ = _bundle(spark, d)
    explainer = loaded.attributor(spark)
    rows = explainer.impacts(loaded.raw.score(_all_docs(spark, d)))
    total = F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x) + F.lit(explainer.expected_value)
    gap = F.abs(total - F.ln(F.col("p") / (1 - F.col("p"))))
    return plain(rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(gap > 1e-9).alias("n_apart")))


@query
def shap_global(spark, d):
    loaded, _ = _bundle(spark, d)
    return plain(loaded.attributor(spark).importance(_all_docs(spark, d)))


@query
def shap_global_sample(spark, d):
    loaded, _ = _bundle(spark, d)
    return plain(attribution.explain_global(
        loaded.attributor(spark), _all_docs(spark, d), DOC_KEYS, 500, SEED).importance)


@query
def shap_swarm(spark, d):
    loaded, _ = _bundle(spark, d)
    return plain(loaded.attributor(spark).swarm(_all_docs(spark, d), DOC_KEYS, 20))


@query
def shap_local_topn(spark, d):
    loaded, _ = _bundle(spark, d)
    rows = scoring.explain(_all_docs(spark, d), loaded, DOC_KEYS, top_n=3)
    return plain(rows.select(
        "doc_id", "prediction_probability", "prediction", "threshold_used",
        F.inline_outer("top_features")))


# Scoring jobs


@query
def score_batch(spark, d):
    loaded, _ = _bundle(spark, d)
    return plain(scoring.score(_all_docs(spark, d), loaded, DOC_KEYS))


def _document_stream(spark, d):
    schema = views.table(spark, d, "documents").schema
    return views.with_text_features(stream.feature_stream(spark, f"{d}/documents.parquet", schema))


def _drained(spark, rows, name):
    """Runs a stream over the files that are there and returns what it wrote."""
    out = scratch_path(spark, name)
    stream.write_stream(rows, out, f"{out}-progress").awaitTermination()
    return spark.read.parquet(out)


@query
def score_stream(spark, d):
    loaded, _ = _bundle(spark, d)
    rows = stream.score_stream(_document_stream(spark, d), loaded, DOC_KEYS)
    return plain(_drained(spark, rows, "scored"))


@query
def explain_stream(spark, d):
    loaded, _ = _bundle(spark, d)
    rows = stream.explain_stream(_document_stream(spark, d), loaded, DOC_KEYS, top_n=3)
    return plain(_drained(spark, rows, "explained").select(
        "doc_id", "prediction_probability", "prediction", F.inline("top_features")))


@query
def stream_parity(spark, d):
    """A stream and a batch give every document the same score."""
    loaded, _ = _bundle(spark, d)
    streamed = _drained(spark, stream.score_stream(_document_stream(spark, d), loaded, DOC_KEYS), "parity")
    batch = scoring.score(_all_docs(spark, d), loaded, DOC_KEYS)
    apart = bundle.reload_differences(plain(batch), plain(streamed))
    return plain(streamed.agg(F.count(F.lit(1)).alias("n"), F.lit(apart).alias("n_apart")))


@query
def reload_parity(spark, d):
    """A bundle saved and loaded once more gives every document the same score."""
    loaded, _ = _bundle(spark, d)
    copy = ArtifactConfig.below(scratch_path(spark, "copy"))
    bundle.save_bundle(spark, VERSION, loaded.calibrated, loaded.raw, loaded.threshold_document,
                       loaded.metadata, copy)
    again = bundle.load_bundle(spark, VERSION, copy)
    docs = _all_docs(spark, d)
    apart = bundle.reload_differences(
        scoring.score(docs, loaded, DOC_KEYS), scoring.score(docs, again, DOC_KEYS))
    return plain(docs.agg(F.count(F.lit(1)).alias("n"), F.lit(apart).alias("n_apart")))


@query
def model_registry(spark, d):
    """The registry entry beside the row and class counts of the tables that the bundle is for."""
    loaded, artifacts = _bundle(spark, d)
    entry = bundle.model_info(spark, artifacts.registry_dir, loaded.version).drop("packaged_at_utc")
    target = views.docs(spark, d).select("quality")
    counts = target.agg(
        F.count(F.lit(1)).alias("n_documents"), F.count("quality").alias("n_labelled"),
        *[F.count_if(F.col("quality") == c).alias(f"n_class_{c}") for c in (0, 1)])
    return plain(entry.crossJoin(F.broadcast(counts)))


# What SQL can state of fitted models: whose rows they see and score, and that their results agree with definitions.
# Each flag is computed another way than the operator computes it, and is 0 where both agree.


def _apart(one, other, tolerance=1e-9):
    both = F.abs(one - other) > tolerance
    return F.coalesce(both, (one.isNull() != other.isNull())).cast("bigint")


@query
def holdout_rows(spark, d):
    """The rows that a hold-out scores, with their labels."""
    train, _ = _training(spark, d)
    rows = models.validation_scores(
        _plan("logistic_regression"), train, DOC_KEYS, strategy="holdout", holdout_size=0.25)
    return rows.select("doc_id", F.col("label").cast("bigint").alias("label"),
                       (~F.col("p").between(0, 1)).cast("bigint").alias("unscored"))


def _rank_metrics(rows, group):
    """ROC area by mean ranks and Brier score of ``label, p`` per group."""
    ranks = Window.partitionBy(*group).orderBy("p")
    ties = Window.partitionBy(*group, "p")
    ranked = rows.withColumn("mean_rank", F.rank().over(ranks) + (F.count(F.lit(1)).over(ties) - 1) / 2)
    one = F.col("label") == 1
    sums = ranked.groupBy(*group).agg(
        F.count_if(one).alias("positives"), F.count_if(~one).alias("negatives"),
        F.sum(F.when(one, F.col("mean_rank"))).alias("ranks"), F.avg(F.pow(F.col("p") - F.col("label"), 2)).alias("brier"))
    P, N = F.col("positives"), F.col("negatives")
    return sums.select(*group, "positives", "negatives", ((F.col("ranks") - P * (P + 1) / 2) / (P * N)).alias("area"), "brier")


@query
def cv_recounted(spark, d):
    """Fold metrics of a boosted model against mean ranks and squares of its out-of-fold rows."""
    train, _ = _training(spark, d)
    result = models.cross_validate(_plan("boosted_trees"), train, DOC_KEYS, CVConfig(n_splits=3))
    own = _rank_metrics(result.oof, ["fold"])
    joined = own.join(result.fold_metrics.select("fold", "roc_auc", "brier_score"), "fold")
    return joined.select(
        F.col("fold").cast("bigint").alias("fold"), "positives", "negatives",
        _apart(F.col("area"), F.col("roc_auc")).alias("area_apart"), _apart(F.col("brier"), F.col("brier_score")).alias("brier_apart"))


@query
def search_recounted(spark, d):
    """The winner's out-of-fold rows give the score that a random search reports; ranks follow the scores."""
    train, _ = _training(spark, d)
    config = TuningConfig(n_iter=3, n_splits=3, param_distributions=SEARCH_SPACE)
    result = tuning.random_search(_plan("boosted_trees"), train, DOC_KEYS, config)
    folds = split.assign_folds(train, "label", DOC_KEYS, 3, config.random_state).select("doc_id", "fold")
    own = _rank_metrics(result.oof.join(folds, "doc_id"), ["fold"]).agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.avg("area").alias("area"))
    better = F.count_if(F.col("mean_test_score") > result.best_score).alias("better")
    table = result.cv_results.agg(F.count(F.lit(1)).alias("n_candidates"), better, F.count_distinct("params").alias("n_distinct"))
    return own.join(F.broadcast(table), F.lit(True)).select(
        "positives", "negatives", "n_candidates", "n_distinct", "better",
        _apart(F.col("area"), F.lit(result.best_score)).alias("score_apart"))


@query
def final_test_recounted(spark, d):
    """The saved model's test metrics against counts of its decided rows."""
    _, test = _training(spark, d)
    loaded, _ = _bundle(spark, d)
    with kept(loaded.predict(test)) as decided:
        found = metrics.classification_metrics(decided, "label", calibration.CALIBRATED, "prediction").first()
        own = _rank_metrics(decided.withColumn("p", F.col(calibration.CALIBRATED)), [])
        hit = (F.col(calibration.CALIBRATED) >= loaded.threshold)
        counts = decided.agg(F.count_if(hit & (F.col("label") == 1)).alias("tp"), F.count_if(hit & (F.col("label") == 0)).alias("fp"))
        row, n = own.first(), counts.first()
    apart = [int(n["tp"] != found["tp"] or n["fp"] != found["fp"]), int(abs(row["area"] - found["roc_auc"]) > 1e-9),
             int(abs(row["brier"] - found["brier_score"]) > 1e-9)]
    return local_table(spark, [(row["positives"], row["negatives"], *apart)],
                       "positives bigint, negatives bigint, counts_apart bigint, area_apart bigint, brier_apart bigint")


def _score_flags(rows, loaded):
    low, high = scoring.RISK_LABELS
    hit = F.col("probability") >= loaded.threshold
    return rows.select(
        "doc_id", "model_version", (hit.cast("int") != F.col("prediction")).cast("bigint").alias("decision_apart"),
        (F.when(hit, high).otherwise(low) != F.col("risk_label")).cast("bigint").alias("label_apart"))


@query
def score_batch_rows(spark, d):
    """Every document is scored once, decided by the threshold and named by the decision."""
    loaded, _ = _bundle(spark, d)
    return _score_flags(scoring.score(_all_docs(spark, d), loaded, DOC_KEYS), loaded)


@query
def score_stream_rows(spark, d):
    """The same of a stream."""
    loaded, _ = _bundle(spark, d)
    return _score_flags(_drained(spark, stream.score_stream(_document_stream(spark, d), loaded, DOC_KEYS), "flagged"), loaded)


def _explained_flags(spark, d, rows):
    """(doc_id, rank) of explained features: signs, order, and input values are checked."""
    cells = rows.select("doc_id", F.posexplode("top_features").alias("place", "f"))
    inputs = _all_docs(spark, d)
    values = inputs.select(F.col("doc_id").alias("__id"), F.map_from_arrays(
        F.array(*[F.lit(c) for c in DOC_NUMBERS + DOC_CATEGORIES]),
        F.array(*[F.col(c).cast("string") for c in DOC_NUMBERS + DOC_CATEGORIES])).alias("inputs"))
    before = F.lag(F.abs("f.impact")).over(Window.partitionBy("doc_id").orderBy("place"))
    cells = cells.withColumn("unordered", F.coalesce(before < F.abs("f.impact"), F.lit(False)))
    return cells.join(values, F.col("doc_id") == F.col("__id")).select(
        "doc_id", (F.col("place") + 1).cast("bigint").alias("rank"), F.col("unordered").cast("bigint").alias("unordered"),
        ((F.col("f.impact") > 0) != (F.col("f.direction") == "higher_risk")).cast("bigint").alias("sign_apart"),
        (~F.col("f.value").eqNullSafe(F.col("inputs")[F.col("f.feature")])).cast("bigint").alias("value_apart"))


@query
def explained_rows(spark, d):
    loaded, _ = _bundle(spark, d)
    return _explained_flags(spark, d, scoring.explain(_all_docs(spark, d), loaded, DOC_KEYS, top_n=3))


@query
def explained_stream_rows(spark, d):
    loaded, _ = _bundle(spark, d)
    return _explained_flags(spark, d, _drained(
        spark, stream.explain_stream(_document_stream(spark, d), loaded, DOC_KEYS, top_n=3), "flagged"))


@query
def importance_recounted(spark, d):
    """Global importance of each feature against its definition on the attributions of all rows."""
    loaded, _ = _bundle(spark, d)
    explainer = loaded.attributor(spark)
    docs = _all_docs(spark, d)
    slots = loaded.raw.prep.feature_map(spark).select("slot", "original")
    total = F.sum(F.abs("shap")) / docs.count()
    own = explainer.long(docs, DOC_KEYS).join(F.broadcast(slots), "slot").groupBy("original").agg(total.alias("own"))
    found = explainer.importance(docs).join(own, F.col("feature") == F.col("original"), "left")
    return found.select("feature", _apart(F.col("mean_abs_shap"), F.coalesce("own", F.lit(0.0))).alias("apart"))


@query
def calibrated_rows(spark, d):
    """Calibrated scores of all documents per method: none missing or outside [0, 1], and in the order of the raw scores."""
    train, _ = _training(spark, d)
    out = None
    for name, method in (("boosted_trees", "sigmoid"), ("logistic_regression", "isotonic")):
        fit = calibration.fit_calibrated(_plan(name), train, DOC_KEYS, CalibrationConfig(method=method))
        rows = fit.calibrated.score(fit.raw.score(_all_docs(spark, d), "raw"))
        # Falling steps along the raw score, whose ties are one step.
        steps = rows.groupBy("raw").agg(F.min(calibration.CALIBRATED).alias("lo"), F.max(calibration.CALIBRATED).alias("hi"),
                                        F.count(F.lit(1)).alias("n"))
        buckets = steps.withColumn("bucket", F.floor(F.col("raw") * 16))
        step = F.lag("hi").over(Window.partitionBy("bucket").orderBy("raw"))
        flags = buckets.withColumn("falls", F.coalesce(step > F.col("lo") + 1e-12, F.lit(False))).agg(
            F.sum("n").alias("n"), F.count_if("falls").alias("n_falling"),
            F.count_if((F.col("lo") < 0) | (F.col("hi") > 1) | F.col("lo").isNull()).alias("n_outside"))
        flags = flags.select(F.lit(method).alias("method"), "*")
        out = flags if out is None else out.union(flags)
    return out


@query
def stream_registry(spark, d):
    """Documents in two files: a version is registered between their micro-batches, and the second one runs twice."""
    loaded, _ = _bundle(spark, d)
    folder = scratch_path(spark, "followed")
    artifacts = ArtifactConfig.below(f"{folder}/artifacts")
    docs = _all_docs(spark, d)
    schema = docs.schema
    for version, rest, at in (("v1", 0, "2001"), ("v2", 1, "2002"), (None, None, None)):
        if version:
            record = {**loaded.metadata, "model_version": version, "packaged_at_utc": at}
            bundle.save_bundle(spark, version, loaded.calibrated, loaded.raw, loaded.threshold_document, record, artifacts)
            docs.where(F.col("doc_id") % 2 == rest).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        else:
            # As after a failure between the write and the commit of the last batch.
            commit = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/progress/commits/1")
            commit.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commit, False)
        files = stream.feature_stream(spark, f"{folder}/in", schema)
        registry.follow_registry(files, artifacts, DOC_KEYS, f"{folder}/out", f"{folder}/progress").awaitTermination()
    return plain(registry.read_results(spark, f"{folder}/out").select("doc_id", "model_version", "batch_id"))
