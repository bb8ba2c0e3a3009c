import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.config import ModelConfig
from riskframe.errors import AttributionError
from riskframe.operators import attribution, models
from conftest import NUMBERS


@pytest.fixture(scope="module")
def fitted(training):
    plan = models.model_plan("boosted_trees", NUMBERS, ["category"], model=ModelConfig(
        boosted_trees_params={"n_estimators": 5, "max_depth": 3, "learning_rate": .3}))
    return plan.fit(training)


@pytest.fixture(scope="module")
def explainer(spark, fitted):
    return attribution.Attributor(fitted, spark)


def shapley(o, z, value):
    """The definition: weighted marginal contributions over all subsets."""
    d = len(z)
    out = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for size in range(d):
            weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
            for chosen in itertools.combinations(others, size):
                rest = np.prod([o[j] if j in chosen else z[j] for j in others])
                out[i] += weight * rest * (o[i] - z[i])
    return value * out


@given(st.lists(st.tuples(st.integers(0, 1), st.floats(0, 1)), min_size=1, max_size=7), st.floats(-3, 3))
@settings(max_examples=150, deadline=None)
def test_leaf_shares_match_the_definition(pairs, value):
    o, z = np.array([p[0] for p in pairs], float), np.array([p[1] for p in pairs])
    got = attribution.leaf_shares(o[None, :], z, value)[0]
    assert got == pytest.approx(shapley(o, z, value), abs=1e-12)
    # Efficiency: the shares add up to the leaf's value less its expectation.
    assert got.sum() == pytest.approx(value * (o.prod() - z.prod()), abs=1e-12)


def node(tree, id, cover, prediction, left=-1, right=-1, feature=-1, values=(), categories=-1):
    return dict(tree=tree, id=id, cover=cover, prediction=prediction, left=left, right=right,
                feature=feature, values=list(values), categories=categories)


def test_boxes_of_a_hand_made_tree():
    nodes = [
        node(0, 0, 10.0, 0, 1, 2, 0, [0.5]), node(0, 1, 6.0, 1.0),
        node(0, 2, 4.0, 0, 3, 4, 1, [0.0], 2), node(0, 3, 1.0, -1.0), node(0, 4, 3.0, 2.0),
    ]
    boxes = attribution.tree_boxes(nodes, {0: 0.5})
    assert boxes.base == pytest.approx(2 * .5 * (.6 * 1 - .1 + .3 * 2))
    x = np.array([[0.5, 0.0], [0.6, 0.0], [0.6, 1.0]])
    shares = boxes.shares(x)
    assert shares.sum(axis=1) + boxes.base == pytest.approx([1.0, -1.0, 2.0])
    # Feature 1 given feature 0 unknown or known, averaged over both orders.
    assert shares[2, 1] == pytest.approx(.5 * ((2 - 1.25) + .4 * (2 - 1.25)))


def test_paths_with_many_features_take_the_direct_route(monkeypatch):
    rng = np.random.default_rng(2)
    depth, nodes = 6, []
    for d in range(depth):
        nodes.append(node(0, 2 * d, 2.0 ** (depth - d), 0, 2 * d + 1, 2 * d + 2, d, [0.5]))
        nodes.append(node(0, 2 * d + 1, 2.0 ** (depth - d - 1), float(d)))
    nodes.append(node(0, 2 * depth, 1.0, 9.0))
    boxes = attribution.tree_boxes(nodes, {0: 1.0})
    x = rng.random((20, depth))
    table = boxes.shares(x)
    monkeypatch.setattr(attribution, "TABLE_FEATURES", 2)
    del boxes.tables
    assert boxes.shares(x) == pytest.approx(table, abs=1e-12)


def test_attributions_add_up_to_the_log_odds(training, fitted, explainer):
    sums = explainer.long(training, ["row_id"]).groupBy("row_id").agg(F.sum("shap").alias("s"))
    gap = sums.join(fitted.score(training), "row_id").agg(F.max(F.abs(
        F.col("s") + explainer.expected_value - F.ln(F.col("p") / (1 - F.col("p")))))).first()[0]
    assert gap < 1e-9


def test_importance_sums_mean_absolute_shares_over_children(training, explainer):
    slots = {r["slot"]: r for r in explainer.slot_importance(training).collect()}
    rows = explainer.importance(training).collect()
    got = {r["feature"]: r["mean_abs_shap"] for r in rows}
    assert set(got) == {*NUMBERS, "category"}
    want = sum(r["mean_abs_shap"] for r in slots.values() if r["original"] == "category")
    assert got["category"] == pytest.approx(want)
    assert [r["mean_abs_shap"] for r in rows] == sorted(got.values(), reverse=True)
    assert len(slots) == len(explainer.slots) and {r["original"] for r in slots.values()} == set(got)


def test_impacts_are_signed_sums(training, explainer):
    row = training.where("row_id = 7")
    by_slot = explainer.long(row, ["row_id"]).collect()
    want = [sum(r["shap"] for r in by_slot if explainer.slots[r["slot"]][1] == c) for c in explainer.originals]
    assert explainer.impacts(row).first()["impacts"] == pytest.approx(want)


def test_top_features(spark, training, explainer):
    impacts = F.array(*[F.lit(v) for v in (0.1, -0.5, 0.5, 0.0, 0.25)])
    row = spark.range(1).select(explainer.top_features(impacts, 3).alias("t")).first()["t"]
    assert [(r["feature"], r["impact"], r["direction"]) for r in row] == [
        ("num_1", -0.5, "lower_risk"), ("num_2", 0.5, "higher_risk"), ("category", 0.25, "higher_risk")]


def test_global_report(training, explainer):
    report = attribution.explain_global(explainer, training, ["row_id"], 50)
    assert report.summary["n_samples_explained"] == 50
    assert report.summary["n_original_features"] == 5
    assert len(report.summary["top_10_features"]) == 5
    again = attribution.explain_global(explainer, training, ["row_id"], 50)
    assert again.summary["top_10_features"] == report.summary["top_10_features"]


def test_swarm(training, explainer):
    rows = explainer.swarm(training, ["row_id"], 2)
    assert rows.select("slot").distinct().count() == 2 and rows.count() == 600


def test_only_trees(spark, training):
    linear = models.model_plan("logistic_regression", NUMBERS, ["category"]).fit(training)
    with pytest.raises(AttributionError):
        attribution.Attributor(linear, spark)


def test_attribution_runs_once_per_row(training, explainer):
    for df in (explainer.long(training, ["row_id"]), explainer.swarm(training, ["row_id"], 3), explainer.importance(training)):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_model_without_any_split(spark, training):
    plan = models.model_plan("boosted_trees", NUMBERS, ["category"], model=ModelConfig(
        boosted_trees_params={"n_estimators": 2, "max_depth": 1, "min_child_weight": 10_000}))
    flat = attribution.Attributor(plan.fit(training), spark)
    assert flat.long(training, ["row_id"]).count() == 0
    assert flat.impacts(training).first()["impacts"] == [0.0] * 5
    assert {r["mean_abs_shap"] for r in flat.importance(training).collect()} == {0.0}
