"""Preprocessing fitted on training rows: impute, scale, encode, assemble.

A fitted preprocessor is a Spark ML ``PipelineModel``: one projection with the
fitted statistics as literals, then string indexing, encoding and assembling. It
saves, loads and runs on streams like any other Spark ML model.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.config import PreprocessingConfig
from riskframe.functions.columns import is_missing, kept, nan_to_null, quoted, to_long
from riskframe.functions.local import local_table
from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.categories import WidePreprocessor
from riskframe.operators.quality import FeatureSchema
from riskframe.sources.sinks import read_json, write_json

logger = logging.getLogger(__name__)

FEATURES = "features"
LINEAR, TREE = "linear", "tree"


def modes(df: DataFrame, columns: Sequence[str], as_type: str = "string") -> dict[str, Any]:
    """Most frequent non-missing value per column, the smallest one on ties."""
    if not columns:
        return {}
    rows = category_counts(df, columns, as_type).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()
    found = {r["column"]: r["mode"] for r in rows}
    return {c: found.get(c) for c in columns}


def numeric_fill(df: DataFrame, columns: Sequence[str], strategy: str,
                 constant: float = 0.0) -> dict[str, float | None]:
    """Fill value per numeric column; None where a column has no value at all."""
    if not columns:
        return {}
    if strategy == "constant":
        return {c: float(constant) for c in columns}
    df = nan_to_null(df)
    if strategy == "median":
        return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    if strategy == "most_frequent":
        return modes(df, columns, "double")
    row = df.agg(*[F.avg(F.col(quoted(c)).cast("double")).alias(f"a{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: row[f"a{i}"] for i, c in enumerate(columns)}


def filled(df: DataFrame, column: str, value: Any, dtype: str):
    """The column with its missing values replaced."""
    present = F.when(~is_missing(df, column), F.col(quoted(column)).cast(dtype))
    return present if value is None else F.coalesce(present, F.lit(value).cast(dtype))


def scale_statistics(df: DataFrame, columns: Sequence[str],
                     fill: dict[str, float | None]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation after imputation; a zero deviation counts as 1.

    The imputed moments follow from those of the present values and the number of
    missing ones, so one aggregation does.
    """
    if not columns:
        return {}
    terms = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        value = filled(df, c, None, "double")
        terms += [F.count(value).alias(f"n{i}"), F.avg(value).alias(f"m{i}"), F.var_pop(value).alias(f"v{i}"),
                  F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
    row = df.agg(*terms).first()
    found = {}
    for i, c in enumerate(columns):
        n, mean, var = row[f"n{i}"], row[f"m{i}"] or 0.0, row[f"v{i}"] or 0.0
        gaps, value = row["rows"] - n, fill[c] or 0.0
        seen = {row[f"lo{i}"], row[f"hi{i}"], value if gaps else row[f"lo{i}"]} - {None}
        if len(seen) == 1:
            # One value throughout: its moments are known without rounding.
            found[c] = (seen.pop(), 1.0)
            continue
        both = (n * mean + gaps * value) / row["rows"]
        spread = (n * (var + (mean - both) ** 2) + gaps * (value - both) ** 2) / row["rows"]
        # Below this the spread is rounding error of the mean.
        noise = row["rows"] * (2.0 ** -52 * both) ** 2
        found[c] = (both, math.sqrt(spread) if spread > noise else 1.0)
    return found


def category_counts(df: DataFrame, columns: Sequence[str], as_type: str = "string") -> DataFrame:
    """(column, value, n) of the non-missing values of all columns, from one shuffle."""
    return (
        to_long(df, columns, as_type=as_type).where("value is not null")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def category_lists(
    df: DataFrame, columns: Sequence[str], max_categories: int | None = None, listed: int | None = None,
) -> dict[str, tuple[str | None, list[str]]] | None:
    """Mode and categories per column; None if a column has more than ``listed`` of them.

    With ``max_categories`` more values in a column are an error. Values are read only when their number is known.
    """
    if not columns:
        return {}
    with kept(category_counts(df, columns)) as counts:
        stats = counts.groupBy("column").agg(
            F.count(F.lit(1)).alias("d"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()
        for r in stats:
            if max_categories is not None and r["d"] > max_categories:
                raise ValueError(
                    f"column {r['column']!r} has {r['d']} categories, more than max_categories={max_categories}")
        if listed is not None and any(r["d"] > listed for r in stats):
            return None
        found: dict[str, tuple[str | None, list[str]]] = {c: (None, []) for c in columns}
        found.update({r["column"]: (r["mode"], []) for r in stats})
        for r in counts.select("column", "value").collect():
            found[r["column"]][1].append(r["value"])
    return found


@dataclass
class FittedPreprocessor:
    """The fitted stages plus which slot of the vector comes from which feature."""

    model: PipelineModel
    schema: FeatureSchema
    slots: list[tuple[str, str]] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        self.schema.require(df)
        return self.model.transform(df)

    @property
    def feature_names(self) -> list[str]:
        return [name for name, _ in self.slots]

    def feature_map(self, spark: SparkSession) -> DataFrame:
        """(slot, transformed, original), exact, from the fitted category lists."""
        return local_table(spark, [(i, t, o) for i, (t, o) in enumerate(self.slots)],
                           "slot int, transformed string, original string")

    def document(self) -> dict[str, Any]:
        return {
            "numerical": list(self.schema.numerical),
            "categorical": list(self.schema.categorical),
            "slots": [list(s) for s in self.slots],
        }

    def save(self, uri: str) -> None:
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{uri}/model")
        write_json(spark, self.document(), f"{uri}/features")

    @classmethod
    def load(cls, uri: str) -> "FittedPreprocessor":
        return cls.of(PipelineModel.load(f"{uri}/model"),
                      read_json(SparkSession.active(), f"{uri}/features"))

    @classmethod
    def of(cls, model: PipelineModel, document: dict[str, Any]) -> "FittedPreprocessor":
        schema = FeatureSchema(tuple(document["numerical"]), tuple(document["categorical"]))
        return cls(model, schema, [tuple(s) for s in document["slots"]])


class Preprocessor(Estimator):
    """Unfitted preprocessing of the given columns for a linear or a tree model.

    ``fit`` reads statistics from the frame it is given and from nothing else, so
    fitting it on training rows keeps test rows out. Afterwards ``fitted`` holds
    the slot map.
    """

    def __init__(self, numerical: Sequence[str], categorical: Sequence[str],
                 config: PreprocessingConfig | None = None, family: str = LINEAR):
        super().__init__()
        if not numerical and not categorical:
            raise ValueError("neither numerical nor categorical features are given")
        if family not in (LINEAR, TREE):
            raise ValueError(f"unknown model family {family!r}")
        self.schema = FeatureSchema(tuple(numerical), tuple(categorical))
        self.config = config or PreprocessingConfig()
        self.family = family
        self.fitted: FittedPreprocessor | None = None

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        self.fitted = self.fit_map(dataset)
        return self.fitted.model

    def fit_map(self, train: DataFrame) -> FittedPreprocessor | WidePreprocessor:
        self.schema.require(train)
        with kept(train, self.schema.names) as rows:
            return self.fit_rows(rows)

    def fit_rows(self, train: DataFrame) -> FittedPreprocessor | WidePreprocessor:
        """The fit itself: one pass for moments, two for medians, one for categories.

        A column of more than ``listed_categories`` values makes it a ``WidePreprocessor``, whose categories are a table.
        """
        config = self.config
        numeric = numeric_fill(train, self.schema.numerical, config.numerical_impute_strategy,
                               config.numerical_fill_value)
        lists = category_lists(train, self.schema.categorical, config.max_categories, config.listed_categories)
        if lists is None:
            known = [c for c in self.schema.numerical if numeric[c] is not None]
            scaled = self.family == LINEAR and config.scale_numerical
            scale = scale_statistics(train, known, numeric) if scaled else {}
            return WidePreprocessor.fit(train, self.schema, numeric, scale, config)
        constant = config.categorical_impute_strategy == "constant"
        category = {c: config.categorical_fill_value if constant else lists[c][0] for c in self.schema.categorical}
        dropped = [c for c, v in {**numeric, **category}.items() if v is None]
        if dropped:
            logger.warning("columns without any training value are dropped: %s", dropped)
        numerical = [c for c in self.schema.numerical if c not in dropped]
        categorical = [c for c in self.schema.categorical if c not in dropped]

        scale = {}
        if self.family == LINEAR and config.scale_numerical:
            scale = scale_statistics(train, numerical, numeric)
        projection = SQLTransformer(statement=_projection_sql(numerical, categorical, numeric, category, scale))
        stages: list[Any] = [projection]
        slots = [(f"numerical__{c}", c) for c in numerical]
        inputs = [_number_column(i) for i in range(len(numerical))]

        if categorical:
            labels = [lists[c][1] for c in categorical]
            if constant:
                # The fill is a category if a training row needs it.
                gaps = train.agg(*[F.count_if(is_missing(train, c)).alias(f"g{i}")
                                   for i, c in enumerate(categorical)]).first()
                labels = [list({*values, category[c]}) if gaps[f"g{i}"] else values
                          for i, (c, values) in enumerate(zip(categorical, labels))]
            raw = [_text_column(i) for i in range(len(categorical))]
            indexed = [_index_column(i) for i in range(len(categorical))]
            # Sorted categories; an unseen one gets the index after the last, or stops the scoring.
            known_only = config.handle_unknown_categorical == "error"
            indexer = StringIndexer(
                inputCols=raw, outputCols=indexed, handleInvalid="error" if known_only else "keep",
                stringOrderType="alphabetAsc",
            ).fit(local_table(train.sparkSession, list(itertools.zip_longest(*labels)),
                              ", ".join(f"{c} string" for c in raw)))
            labels = indexer.labelsArray
            stages.append(indexer)
            if config.encode_categorical == "ordinal":
                inputs += indexed
                slots += [(f"categorical__{c}", c) for c in categorical]
            else:
                encoded = [_onehot_column(i) for i in range(len(categorical))]
                # The index of unseen categories, if there is one, is the last one and is
                # dropped: they become all zeros.
                stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=not known_only,
                                            handleInvalid="error").fit(indexer.transform(projection.transform(train))))
                for i, c in enumerate(categorical):
                    values = list(labels[i])
                    first = config.onehot_drop == "first" or (
                        config.onehot_drop == "if_binary" and len(values) == 2)
                    if first and len(values) == 1:
                        continue
                    if first:
                        kept = VectorSlicer(inputCol=encoded[i], outputCol=f"{encoded[i]}_kept",
                                            indices=list(range(1, len(values))))
                        stages.append(kept)
                        values = values[1:]
                        inputs.append(f"{encoded[i]}_kept")
                    else:
                        inputs.append(encoded[i])
                    slots += [(f"categorical__{c}_{v}", c) for v in values]
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error"))
        return FittedPreprocessor(PipelineModel(stages), self.schema, slots)


def _number_column(i: int) -> str:
    return f"__num{i}"


def _text_column(i: int) -> str:
    return f"__cat{i}"


def _index_column(i: int) -> str:
    return f"__idx{i}"


def _onehot_column(i: int) -> str:
    return f"__hot{i}"


def _projection_sql(numerical, categorical, numeric, category, scale) -> str:
    """The fitted imputation and scaling as one SELECT over ``__THIS__``."""
    items = ["*"]
    for i, c in enumerate(numerical):
        value = f"cast({quoted(c)} as double)"
        # NaN counts as missing.
        value = f"coalesce(if(isnan({value}), null, {value}), double('{numeric[c]!r}'))"
        if c in scale:
            mean, deviation = scale[c]
            value = f"({value} - double('{mean!r}')) / double('{deviation!r}')"
        items.append(f"{value} AS {_number_column(i)}")
    for i, c in enumerate(categorical):
        fill = str(category[c]).replace("\\", "\\\\").replace("'", "\\'")
        items.append(f"coalesce(cast({quoted(c)} as string), '{fill}') AS {_text_column(i)}")
    return f"SELECT {', '.join(items)} FROM __THIS__"


def helper_columns(df: DataFrame) -> list[str]:
    """Intermediate columns of the fitted stages."""
    return [c for c in df.columns if c.startswith(("__num", "__cat", "__idx", "__hot"))]


def fit_preprocessor(train: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                     config: PreprocessingConfig | None = None, family: str = LINEAR,
                     ) -> FittedPreprocessor | WidePreprocessor:
    """Fits on training rows only. Never hand this a frame that holds test rows."""
    return Preprocessor(numerical, categorical, config, family).fit_map(train)
