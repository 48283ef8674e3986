"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.spec import HIGH_CONFIDENCE, POSITIVE, WEIGHT, TableSpec


def split_features_target(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, features, target and a weight that defaults to 1.0."""
    key = [spec.key] if spec.key else []
    weight = F.col(spec.weight).cast("double") if spec.weight else F.lit(1.0)
    return df.select(*key, *spec.features, spec.target, weight.alias("sample_weight"))


def with_weight(df: DataFrame, spec: TableSpec, weighted: bool = True) -> tuple[DataFrame, TableSpec]:
    """The table with exactly one weight column, under the usual name, and its spec.

    Weights are 1.0 where the spec names none, the table lacks the column, or they are not wanted.
    """
    given = spec.weight if weighted and spec.weight in df.columns else None
    weight = F.col(given).cast("double") if given else F.lit(1.0)
    old = [c for c in (spec.weight, WEIGHT) if c in df.columns and c not in spec.features]
    return df.withColumn("_weight", weight).drop(*old).withColumnRenamed("_weight", WEIGHT), spec.with_(weight=WEIGHT)


def binarize_label(label: Column, positive: int = POSITIVE) -> Column:
    return (label == positive).cast("int")


def predicted_confidence(pred: Column, probability: Column, positive: int = POSITIVE) -> Column:
    """Probability of the class that was predicted."""
    return F.when(pred == positive, probability).otherwise(F.lit(1.0) - probability)


def error_type(truth: Column, pred: Column, positive: int = POSITIVE) -> Column:
    is_positive, said_positive = truth == positive, pred == positive
    return (
        F.when(is_positive & said_positive, "true_positive_phishing")
        .when(~is_positive & ~said_positive, "true_negative_legitimate")
        .when(is_positive, "false_negative")
        .otherwise("false_positive")
    )


def high_confidence_error(truth: Column, pred: Column, confidence: Column, threshold: float = HIGH_CONFIDENCE) -> Column:
    return (truth != pred) & (confidence >= F.lit(threshold))


def direction(contribution: Column) -> Column:
    return (
        F.when(contribution > 0, "increases_phishing_probability")
        .when(contribution < 0, "decreases_phishing_probability")
        .otherwise("no_effect")
    )


def label_name(label: Column, names: Mapping[int, str]) -> Column:
    """Display name of a label, the label itself where none is given."""
    text = label.cast("string")
    if not names:
        return text
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, label), text)


def safe_ratio(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    """Ratio that gives ``default`` (or NULL) on an empty denominator."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def rename_and_fill(importance: DataFrame, model: str) -> DataFrame:
    """One model's importance rows under their display names, missing spread as 0."""
    return (
        importance.where(F.trim(F.col("model")) == model.strip())
        .withColumnsRenamed({"mean_importance": "importance_mean", "std_importance_across_folds": "importance_std"})
        .fillna({"importance_std": 0.0})
    )


def union_results(tables: list[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Stack per-model tables of one schema; of no tables, a table without rows and columns."""
    if not tables:
        return (spark or SparkSession.active()).createDataFrame([], "struct<>")
    stacked, *rest = tables
    for table in rest:
        stacked = stacked.unionByName(table)
    return stacked
