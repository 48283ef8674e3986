"""Fitting and scoring tree classifiers.

Trees and forests are grown on the table's cells (``operators/growth.py``). The estimator of
``build_model``, for those who want one in a ``pyspark.ml`` pipeline, fits with ``pyspark.ml``; its labels
are {0, 1}: index 0 is the positive class (-1), so majority ties go to it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import isqrt

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, functions as F

from profilespark.functions.exprs import union_results, with_weight
from profilespark.operators.diagnostics import prediction_table
from profilespark.operators.growth import GrownModel, cells_of, fit_of, grow
from profilespark.operators.metrics import accuracy
from profilespark.operators.selection import MutualInformationSelector
from profilespark.spec import FAMILIES, SEED, WEIGHT, TableSpec

LABEL = "_label"
# Split points that a tree looks at per feature: one per value up to MAX_BINS values; a feature with
# more values is cut at as many quantiles (see ``with_whole_sample``, which allows more).
MIN_BINS, MAX_BINS = 32, 1024
# pyspark.ml squares the bins as a 32-bit number.
MOST_BINS = 46_340
# The deepest tree pyspark.ml grows; stands for "no limit".
MAX_DEPTH = 30


def with_label(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(LABEL, ((F.col(spec.target) - spec.positive) / (spec.negative - spec.positive)).cast("double"))


def build_classifier(family: str, params: Mapping[str, object], weighted: bool = True, bins: int | None = None) -> Estimator:
    """Classifier stage from a parameter record (names without prefix).

    ``min_samples_split`` has no counterpart in ``pyspark.ml``.
    """
    depth = params.get("max_depth")
    shared = dict(
        featuresCol="features", labelCol=LABEL, seed=SEED, leafCol="leaf", impurity=params.get("criterion", "gini"),
        maxDepth=MAX_DEPTH if depth is None else int(depth), minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        maxBins=min(MAX_BINS, max(MIN_BINS, bins or 0)),
    )
    if weighted:
        shared["weightCol"] = WEIGHT
    if family == FAMILIES[0]:
        return DecisionTreeClassifier(**shared)
    if family == FAMILIES[1]:
        columns = params.get("max_features", "sqrt")
        return RandomForestClassifier(
            numTrees=int(params.get("n_estimators", 100)), bootstrap=bool(params.get("bootstrap", True)),
            featureSubsetStrategy="all" if columns is None else str(columns), **shared,
        )
    raise ValueError(f"No model family is named {family!r}; there are {list(FAMILIES)}.")


def with_whole_sample(classifier: Estimator, rows: int) -> Estimator:
    """The classifier with bins enough that split points are looked for in all of the given rows.

    ``pyspark.ml`` takes them from a sample of as many rows as the square of the bins (10,000 at least),
    which may miss rare values. Bins that no value needs cost nothing.
    """
    return classifier.setMaxBins(max(classifier.getMaxBins(), min(MOST_BINS, isqrt(rows) + 1)))


def split_parameters(parameters: Mapping[str, object]) -> tuple[int | str, dict[str, object]]:
    """Selector k and classifier parameters from one prefixed parameter record."""
    classifier = {n.removeprefix("classifier__"): v for n, v in parameters.items() if n.startswith("classifier__")}
    return parameters.get("feature_selection__k", "all"), classifier


def build_model(family: str, parameters: Mapping[str, object], spec: TableSpec, weighted: bool = True, rows: int = 0) -> Pipeline:
    """Selector and classifier in one estimator, for as many rows; only the classifier sees the weights."""
    k, params = split_parameters(parameters)
    classifier = with_whole_sample(build_classifier(family, params, weighted, spec.bins), rows)
    return Pipeline(stages=[MutualInformationSelector(spec=spec, k=k), classifier])


def fit_selected(family: str, parameters: Mapping[str, object], df: DataFrame, spec: TableSpec, features: Sequence[str],
                 weighted: bool = True) -> GrownModel:
    """Fit a parameter record on features that are already chosen, on the table's cells."""
    df, spec = with_weight(df, spec, weighted)
    _, params = split_parameters(parameters)
    fitted = fit_of(family, params, [spec.features.index(f) for f in features])
    (growth,) = grow(cells_of(df, spec, 1, F.lit(1)), [fitted])
    return GrownModel.of(growth, fitted, spec)


def fit(family: str, parameters: Mapping[str, object], df: DataFrame, spec: TableSpec, weighted: bool = True) -> GrownModel:
    """Fit (or refit) a parameter record on all given rows: selection first, then the classifier."""
    k, _ = split_parameters(parameters)
    df, spec = with_weight(df, spec, weighted)
    selector = MutualInformationSelector(spec=spec, k=k).fit(df)
    return fit_selected(family, parameters, df, spec, selector.selected, weighted)


def predict(model: GrownModel, df: DataFrame, name: str) -> DataFrame:
    """Label and P(positive class) per row, as a prediction table keyed by the row key."""
    spec = model.spec
    keep = [c for c in ("outer_fold", "split") if c in df.columns]
    weight = F.col(WEIGHT).cast("double") if WEIGHT in df.columns else F.lit(1.0)
    return prediction_table(
        model.score(df).select(
            F.lit(name).alias("model"), *keep, spec.key, weight.alias(WEIGHT),
            F.col(spec.target).alias("y_true"), "y_pred", "phishing_probability",
        )
    )


def fit_candidates(configurations: list[tuple[str, float, dict[str, object]]], dev: DataFrame, test: DataFrame,
                   spec: TableSpec, weighted: bool) -> tuple[DataFrame, dict[str, GrownModel]]:
    """Fit each family's chosen configuration; held-out accuracy per family."""
    test, _ = with_weight(test, spec, weighted)
    models = {name: fit(name, parameters, dev, spec, weighted) for name, _, parameters in configurations}
    scored = union_results([predict(model, test, name) for name, model in models.items()])
    return accuracy(scored, ["model"]).withColumnRenamed("accuracy", "test_accuracy"), models
