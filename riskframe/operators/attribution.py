"""Attribution of tree models: exact path-dependent Shapley values in log-odds.

The fitted trees are turned into boxes, one per leaf: an interval (or a set of
categories) per feature on the path. For a leaf with value v, whose path uses the
features P, let o_i be 1 if the row meets the box on feature i and z_i the
product of cover ratios along the edges on i. Its share for feature i is

    v (o_i - z_i) * integral over u in [0, 1] of prod over j != i of ((1-u) z_j + u o_j)

which sums the Shapley weights over all subsets of P. The integrand is a
polynomial of degree |P| - 1, so Gauss-Legendre quadrature is exact. As o_j is 0
or 1, the shares are tabulated per leaf for all patterns of o, and rows only look
them up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.errors import AttributionError
from riskframe.functions.columns import quoted
from riskframe.functions.local import local_table
from riskframe.operators.calibration import CALIBRATED, CalibratedModel
from riskframe.operators.models import FittedModel
from riskframe.operators.prep import FEATURES, TREE, helper_columns
from riskframe.operators.split import sample_rows
from riskframe.operators.threshold import apply_threshold
from riskframe.session import scratch_path

# Paths with more features than this are summed per row instead of tabulated.
TABLE_FEATURES = 10

GLOBAL_NOTE = (
    "Attributions are those of the uncalibrated tree model in log-odds; they describe the model, "
    "not causes. The importance of a category column is the sum over its encoded categories."
)
LOCAL_NOTE = (
    "The probability comes from the calibrated model. The impacts come from the uncalibrated model's "
    "log-odds: they rank what moved the model, are no causal claim and do not add up to the calibrated "
    "probability. higher_risk and lower_risk take class 1 as the higher risk. This supports a decision "
    "and does not make one."
)


@dataclass
class Leaf:
    """A leaf as a box: features, bounds or categories, cover products and value."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cats: list[frozenset | None]
    z: np.ndarray
    value: float


def leaf_shares(o: np.ndarray, z: np.ndarray, value: float) -> np.ndarray:
    """Shares per feature for rows of met conditions ``o`` (rows x features)."""
    d = len(z)
    nodes, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    shares = np.zeros(o.shape)
    for u, w in zip((nodes + 1) / 2, weights / 2):
        terms = (1 - u) * z + u * o
        # Products over all other features, from both ends, as a term may be zero.
        left = np.cumprod(np.hstack([np.ones((len(o), 1)), terms[:, :-1]]), axis=1)
        right = np.cumprod(np.hstack([np.ones((len(o), 1)), terms[:, :0:-1]]), axis=1)[:, ::-1]
        shares += w * left * right
    return value * (o - z) * shares


@dataclass
class TreeBoxes:
    """All leaves of a boosted model and the sum of their expected values."""

    leaves: list[Leaf]
    base: float
    used: list[int]

    @cached_property
    def tables(self) -> list[np.ndarray | None]:
        """Shares per leaf for every pattern of met conditions; made once per Python worker."""
        made: list[np.ndarray | None] = []
        for leaf in self.leaves:
            d = len(leaf.features)
            patterns = (np.arange(2 ** d)[:, None] >> np.arange(d)) & 1 if d <= TABLE_FEATURES else None
            made.append(None if patterns is None else leaf_shares(patterns.astype(float), leaf.z, leaf.value))
        return made

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Shapley values (rows x used features) of rows given as used features."""
        at = {slot: i for i, slot in enumerate(self.used)}
        out = np.zeros((len(x), len(self.used)))
        for leaf, table in zip(self.leaves, self.tables):
            columns = [at[s] for s in leaf.features]
            d = len(columns)
            met = np.empty((len(x), d), dtype=bool)
            for j, c in enumerate(columns):
                value = x[:, c]
                met[:, j] = (value > leaf.low[j]) & (value <= leaf.high[j])
                if leaf.cats[j] is not None:
                    met[:, j] &= np.isin(value, list(leaf.cats[j]))
            if table is None:
                out[:, columns] += leaf_shares(met.astype(float), leaf.z, leaf.value)
            else:
                out[:, columns] += table[met @ (1 << np.arange(d))]
        return out


def tree_boxes(nodes: Sequence[dict[str, Any]], weights: dict[int, float]) -> TreeBoxes:
    """Boxes from node records (tree, id, cover, prediction, left, right, feature, values, categories).

    Values are doubled: the log-odds of a boosted classifier are twice its sum.
    """
    trees: dict[int, dict[int, dict[str, Any]]] = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["id"]] = n
    leaves: list[Leaf] = []
    base = 0.0
    for t, by_id in sorted(trees.items()):
        stack: list[tuple[int, dict[int, tuple], float]] = [(0, {}, 1.0)]
        while stack:
            node_id, box, reach = stack.pop()
            n = by_id[node_id]
            if n["left"] < 0:
                value = 2.0 * weights[t] * n["prediction"]
                base += value * reach
                if box and value:
                    used = sorted(box)
                    leaves.append(Leaf(
                        np.array(used), np.array([box[f][0] for f in used]), np.array([box[f][1] for f in used]),
                        [box[f][2] for f in used], np.array([box[f][3] for f in used]), value))
                continue
            f = n["feature"]
            low, high, cats, z = box.get(f, (-np.inf, np.inf, None, 1.0))
            for side in ("left", "right"):
                child = by_id[n[side]]
                ratio = child["cover"] / n["cover"]
                lo, hi, members = low, high, cats
                if n["categories"] < 0:
                    cut = n["values"][0]
                    lo, hi = (lo, min(hi, cut)) if side == "left" else (max(lo, cut), hi)
                else:
                    chosen = frozenset(n["values"])
                    if side == "right":
                        chosen = frozenset(map(float, range(n["categories"]))) - chosen
                    members = chosen if members is None else members & chosen
                stack.append((n[side], {**box, f: (lo, hi, members, z * ratio)}, reach * ratio))
    used = sorted({int(s) for leaf in leaves for s in leaf.features})
    return TreeBoxes(leaves, base, used)


def read_boxes(model: FittedModel, spark: SparkSession) -> TreeBoxes:
    """The boxes of a fitted tree model, from its saved node table.

    A model has at most trees x 2^depth nodes, which the driver already holds.
    """
    if model.family != TREE or not hasattr(model.classifier, "treeWeights"):
        raise AttributionError("only a fitted tree classifier can be attributed")
    uri = scratch_path(spark, "trees")
    model.classifier.write().save(uri)
    node = "nodeData"
    rows = spark.read.parquet(f"{uri}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{node}.id").alias("id"),
        F.col(f"{node}.impurityStats")[0].alias("cover"), F.col(f"{node}.prediction").alias("prediction"),
        F.col(f"{node}.leftChild").alias("left"), F.col(f"{node}.rightChild").alias("right"),
        F.col(f"{node}.split.featureIndex").alias("feature"),
        F.col(f"{node}.split.leftCategoriesOrThreshold").alias("values"),
        F.col(f"{node}.split.numCategories").alias("categories"),
    ).collect()
    weights = dict(enumerate(model.classifier.treeWeights))
    return tree_boxes([r.asDict() for r in rows], weights)


class Attributor:
    """Adds attributions of an uncalibrated tree model to rows, batch or stream."""

    def __init__(self, model: FittedModel, spark: SparkSession, boxes: TreeBoxes | None = None):
        self.model = model
        self.boxes = boxes or read_boxes(model, spark)
        self.expected_value = self.boxes.base
        self.slots = model.prep.slots
        self.originals = list(model.prep.schema.names)
        # Boxes are shipped to each executor once.
        self._shared = spark.sparkContext.broadcast(self.boxes)

    def _udf(self, by_original: bool):
        shared = self._shared
        fold = None
        if by_original:
            # Signed sum over the encoded children of each original feature.
            fold = np.zeros((len(self.boxes.used), len(self.originals)))
            for i, slot in enumerate(self.boxes.used):
                fold[i, self.originals.index(self.slots[slot][1])] = 1.0

        @F.pandas_udf("array<double>")
        def attribute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            boxes = shared.value
            for values in batches:
                if not len(values):
                    yield pd.Series([], dtype=object)
                    continue
                shares = boxes.shares(np.stack(values.to_numpy()))
                yield pd.Series(list(shares if fold is None else shares @ fold))

        return attribute

    def _with_used(self, df: DataFrame) -> DataFrame:
        """Preprocessed rows with the slots that the trees use as an array."""
        prepared = self.model.prep.transform(df)
        used = VectorSlicer(inputCol=FEATURES, outputCol="__used", indices=self.boxes.used)
        return used.transform(prepared).withColumn("__used", vector_to_array("__used"))

    def _attributed(self, df: DataFrame, output: str, by_original: bool) -> DataFrame:
        if not self.boxes.used:
            size = len(self.originals) if by_original else 0
            return df.withColumn(output, F.array_repeat(F.lit(0.0), size))
        prepared = self._with_used(df)
        out = prepared.withColumn(output, self._udf(by_original)("__used"))
        return out.drop("__used", FEATURES, *helper_columns(out))

    def long(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """(keys, slot, shap) for the slots the trees use; every other slot has value 0."""
        out = self._attributed(df, "__shap", False)
        if not self.boxes.used:
            out = out.where(F.lit(False))
        # A plain explode lets the optimizer filter on the array's size, which would
        # run the attribution twice; the arrays are never empty.
        slots = F.array(*[F.lit(s) for s in self.boxes.used]) if self.boxes.used else F.array().cast("array<int>")
        return out.select(*[F.col(quoted(k)) for k in keys], F.posexplode_outer("__shap").alias("__i", "shap")).select(
            *[F.col(quoted(k)) for k in keys], F.element_at(slots, F.col("__i") + 1).alias("slot"), "shap")

    def swarm(self, df: DataFrame, keys: Sequence[str], max_display: int = 20) -> DataFrame:
        """(keys, slot, transformed, value, shap) for the slots with the largest mean |shap|.

        The top slots are found first, so the rows that leave the attribution hold
        no others.
        """
        if not self.boxes.used:
            raise AttributionError("the trees use no feature")
        top = self.slot_importance(df).orderBy(F.col("mean_abs_shap").desc(), "slot").limit(max_display)
        shown = [r["slot"] for r in top.collect() if r["slot"] in set(self.boxes.used)]
        out = self._with_used(df).withColumn("__shap", self._udf(False)("__used"))
        at = {slot: i for i, slot in enumerate(self.boxes.used)}
        names = self.model.prep.feature_names
        cells = F.array(*[F.struct(
            F.lit(s).alias("slot"), F.lit(names[s]).alias("transformed"),
            F.col("__used")[at[s]].alias("value"), F.col("__shap")[at[s]].alias("shap")) for s in shown])
        return out.select(*[F.col(quoted(k)) for k in keys], F.inline_outer(cells))

    def bar(self, df: DataFrame, max_display: int = 20) -> DataFrame:
        """The original features with the largest importance."""
        return self.importance(df).limit(max_display)

    def slot_importance(self, df: DataFrame) -> DataFrame:
        """(slot, transformed, original, mean_abs_shap) for every slot."""
        means = self.long(df, []).groupBy("slot").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
        # One row per slot on both sides.
        return self.model.prep.feature_map(df.sparkSession).join(F.broadcast(means), "slot", "left").withColumn(
            "mean_abs_shap", F.coalesce("mean_abs_shap", F.lit(0.0)))

    def importance(self, df: DataFrame) -> DataFrame:
        """(feature, mean_abs_shap): mean |shap| per slot, summed over an original's slots."""
        names = local_table(df.sparkSession, [(i, c) for i, c in enumerate(self.originals)],
                            "position int, feature string")
        sums = self.slot_importance(df).groupBy("original").agg(F.sum("mean_abs_shap").alias("mean_abs_shap"))
        return (
            names.join(F.broadcast(sums), F.col("feature") == F.col("original"), "left")
            .select("feature", F.coalesce("mean_abs_shap", F.lit(0.0)).alias("mean_abs_shap"), "position")
            .orderBy(F.col("mean_abs_shap").desc(), "position").drop("position")
        )

    def impacts(self, df: DataFrame, output: str = "impacts") -> DataFrame:
        """Adds the signed impact per original feature, as an array in schema order."""
        return self._attributed(df, output, True)

    def top_features(self, impacts: Column, top_n: int, values: Column | None = None) -> Column:
        """The ``top_n`` impacts by size as structs, within the row and without a shuffle."""
        names = F.array(*[F.lit(c) for c in self.originals])
        ordered = F.array_sort(F.transform(impacts, lambda v, i: F.struct(
            (-F.abs(v)).alias("size"), i.alias("position"), v.alias("impact"))))

        def entry(item):
            impact = F.round(item["impact"], 6)
            parts = [
                F.element_at(names, item["position"] + 1).alias("feature"), impact.alias("impact"),
                F.when(item["impact"] > 0, "higher_risk").otherwise("lower_risk").alias("direction"),
            ]
            if values is not None:
                parts.append(F.element_at(values, item["position"] + 1).alias("value"))
            return F.struct(*parts)

        return F.transform(F.slice(ordered, 1, top_n), entry)


@dataclass
class GlobalReport:
    importance: DataFrame
    summary: dict[str, Any]


def explain_global(attributor: Attributor, df: DataFrame, keys: Sequence[str], sample_size: int | None = None,
                   seed: int = 42) -> GlobalReport:
    """Importance of the original features over a seeded sample of rows, or all of them."""
    rows = df if sample_size is None else sample_rows(df, sample_size, keys, seed)
    importance = attributor.importance(rows).persist()
    top = importance.limit(10).collect()
    return GlobalReport(importance, {
        "n_samples_explained": rows.count(),
        "n_transformed_features": len(attributor.slots),
        "n_original_features": len(attributor.originals),
        "expected_value": attributor.expected_value,
        "top_10_features": [r.asDict() for r in top],
        "note": GLOBAL_NOTE,
    })


def explain_rows(attributor: Attributor, calibrated: CalibratedModel, df: DataFrame, threshold: float,
                 keys: Sequence[str], top_n: int = 5, with_values: bool = True) -> DataFrame:
    """(keys, prediction_probability, prediction, threshold_used, top_features, explanation_note).

    Every row is explained on its own, so this is a projection for tables and streams.
    """
    attributor.model.prep.schema.require(df)
    scored = apply_threshold(calibrated.score(df, CALIBRATED), threshold, CALIBRATED)
    out = attributor.impacts(scored, "__impacts")
    values = F.array(*[F.col(quoted(c)).cast("string") for c in attributor.originals]) if with_values else None
    return out.select(
        *[F.col(quoted(k)) for k in keys],
        F.round(CALIBRATED, 6).alias("prediction_probability"), "prediction",
        F.lit(float(threshold)).alias("threshold_used"),
        attributor.top_features(F.col("__impacts"), top_n, values).alias("top_features"),
        F.lit(LOCAL_NOTE).alias("explanation_note"),
    )
