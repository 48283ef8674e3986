"""Error analysis of prediction tables and the paired test between model families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from profilespark.functions.exprs import error_type, high_confidence_error, predicted_confidence, safe_ratio
from profilespark.operators.metrics import outcome_masses, prediction_mass
from profilespark.spec import FAMILIES, HIGH_CONFIDENCE, TableSpec


def prediction_table(scored: DataFrame, threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Add confidence, correctness, error type and the confidently-wrong flag to scored rows."""
    truth, pred = F.col("y_true"), F.col("y_pred")
    with_confidence = scored.withColumn("predicted_confidence", predicted_confidence(pred, F.col("phishing_probability")))
    return with_confidence.withColumns(
        {
            "correct": truth == pred,
            "error_type": error_type(truth, pred),
            "high_confidence_error": high_confidence_error(truth, pred, F.col("predicted_confidence"), threshold),
        }
    )


def error_summary(predictions: DataFrame, threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Masses and weighted error rates per model; confidently wrong rows are counted unweighted."""
    flagged = F.count_if("high_confidence_error").alias("high_confidence_errors")
    masses = outcome_masses(predictions, ["model"], flagged)
    wrong = F.col("fn") + F.col("fp")
    return masses.select(
        "model",
        F.col("n_rows").alias("unique_profiles"),
        F.col("mass").alias("retained_weighted_instances"),
        F.col("tp").alias("true_positive_phishing_mass"),
        F.col("fn").alias("false_negative_mass"),
        F.col("fp").alias("false_positive_mass"),
        F.col("tn").alias("true_negative_legitimate_mass"),
        safe_ratio(F.col("fn"), F.col("tp") + F.col("fn"), default=None).alias("weighted_false_negative_rate"),
        safe_ratio(F.col("fp"), F.col("fp") + F.col("tn"), default=None).alias("weighted_false_positive_rate"),
        safe_ratio(wrong, F.col("mass"), default=None).alias("weighted_error_rate"),
        "high_confidence_errors",
        F.lit(threshold).alias("high_confidence_threshold"),
    )


def error_by_feature_value(predictions: DataFrame, table: DataFrame, spec: TableSpec) -> DataFrame:
    """Error mass and rates per (model, feature, value) for all features in one job."""
    features = table.select(spec.key, *spec.features)
    # One row per key, or an error: a key that occurs twice would count its predictions twice.
    once = F.when(F.count(F.lit(1)) == 1, F.lit(True)).otherwise(F.raise_error(F.lit("A row key occurs more than once in the feature table.")).cast("boolean"))
    features = features.groupBy(spec.key).agg(once.alias("_once"), *[F.first(f).alias(f) for f in spec.features]).where("_once").drop("_once")
    long = predictions.join(features, spec.key, "left").withColumn("_mass", prediction_mass(predictions))
    long = long.unpivot(
        ["model", "_mass", "correct", "error_type", "high_confidence_error", "phishing_probability"],
        list(spec.features), "feature", "feature_value",
    )
    wrong = F.sum(F.when(~F.col("correct"), F.col("_mass")).otherwise(F.lit(0.0)))
    cells = long.groupBy("model", "feature", "feature_value").agg(
        F.count(F.lit(1)).alias("unique_profiles"),
        F.sum("_mass").alias("weighted_instances"),
        wrong.alias("weighted_errors"),
        F.count_if(F.col("error_type") == "false_negative").alias("false_negatives"),
        F.count_if(F.col("error_type") == "false_positive").alias("false_positives"),
        F.count_if("high_confidence_error").alias("high_confidence_errors"),
        F.avg("phishing_probability").alias("mean_phishing_probability"),
    )
    return cells.withColumn("weighted_error_rate", safe_ratio(F.col("weighted_errors"), F.col("weighted_instances")))


def fold_pivot(fold_scores: DataFrame, by: Sequence[str] = (), metric: str = "accuracy",
               families: Sequence[str] = FAMILIES) -> DataFrame:
    """Fold x family scores; folds without every family are dropped."""
    wide = fold_scores.groupBy(*by, "outer_fold").pivot("model", list(families)).agg(F.first(metric))
    return wide.dropna(subset=list(families))


def _exact_p(statistic: Column, n: Column) -> Column:
    """P(W <= statistic) * 2 over all 2^n sign patterns, by the subset-sum recurrence."""
    size = F.call_function("div", n * (n + 1), F.lit(2))
    zero = F.lit(0.0)
    start = F.transform(F.sequence(F.lit(0).cast("bigint"), size), lambda s: F.when(s == 0, F.lit(1.0)).otherwise(zero))

    def add_rank(ways: Column, rank: Column) -> Column:
        return F.transform(
            ways, lambda w, s: w + F.when(s >= rank, F.get(ways, (s - rank).cast("int"))).otherwise(zero)
        )

    ways = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n), start, add_rank)
    tail = F.aggregate(F.slice(ways, 1, (statistic + 1).cast("int")), zero, lambda a, x: a + x)
    return F.least(F.lit(1.0), 2.0 * tail / F.pow(F.lit(2.0), n))


def _normal_two_sided(z: Column) -> Column:
    """2 * P(Z > |z|) by the power series of the normal distribution function."""
    x = F.abs(z)
    init = F.struct(x.alias("term"), x.alias("total"))
    step = lambda acc, k: F.struct(
        (acc["term"] * x * x / (2 * k + 1)).alias("term"),
        (acc["total"] + acc["term"] * x * x / (2 * k + 1)).alias("total"),
    )
    series = F.aggregate(F.sequence(F.lit(1), F.lit(200)), init, step, lambda acc: acc["total"])
    inner = series * F.exp(-x * x / 2) / F.sqrt(F.lit(2 * 3.141592653589793))
    return F.greatest(F.lit(0.0), F.lit(1.0) - 2 * inner)


def wilcoxon_paired(pairs: DataFrame, by: Sequence[str] = (), families: Sequence[str] = FAMILIES) -> DataFrame:
    """Two-sided signed-rank test per group of paired fold scores.

    ``pairs`` has one column per family and one row per fold. Exact when there
    are neither zero nor tied differences, else the tie-corrected normal
    approximation; all differences (almost) zero gives statistic 0 and p 1.
    """
    first, second = families
    by = list(by)
    # Differences closer than the noise of a stored score are ties.
    diff = F.round(F.col(f"`{second}`") - F.col(f"`{first}`"), 12)
    moved = pairs.select(*by, diff.alias("d"), F.abs(diff).alias("a"))
    groups = by or [F.lit(0)]
    nonzero = moved.where("a > 0")
    tied = Window.partitionBy(*groups, "a")
    order = Window.partitionBy(*groups).orderBy("a")
    # One row per fold: n is the number of outer folds.
    ranked = nonzero.withColumns({"t": F.count(F.lit(1)).over(tied), "low": F.rank().over(order)}).withColumn(
        "r", F.col("low") + (F.col("t") - 1) / 2.0
    )
    tests = ranked.groupBy(*by).agg(
        F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("w_plus"),
        F.sum(F.when(F.col("d") < 0, F.col("r")).otherwise(0.0)).alias("w_minus"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("t") * F.col("t") - 1).alias("ties"),
        F.max("t").alias("max_t"),
    )
    overview = moved.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.avg("d").alias("mean_paired_difference_rf_minus_dt"),
        (F.max("a") <= 1e-8).alias("_all_equal"),
    )
    if by:
        joined = overview.join(tests, by, "left")
    else:
        joined = overview.withColumn("_k", F.lit(0)).join(tests.withColumn("_k", F.lit(0)), "_k", "left").drop("_k")
    statistic = F.least("w_plus", "w_minus")
    n = F.col("n")
    spread = F.sqrt((n * (n + 1) * (2 * n + 1) - F.col("ties") / 2.0) / 24.0)
    z = F.try_divide(statistic - n * (n + 1) / 4.0, spread)
    exact = (F.col("max_t") == 1) & (n == F.col("sample_size"))
    return joined.where("sample_size > 0").select(
        *by,
        F.lit("Wilcoxon signed-rank").alias("test"),
        F.when(F.col("_all_equal"), F.lit(0.0)).otherwise(statistic).alias("statistic"),
        F.when(F.col("_all_equal"), F.lit(1.0)).when(exact, _exact_p(statistic, n)).otherwise(_normal_two_sided(z)).alias("p_value"),
        "sample_size",
        "mean_paired_difference_rf_minus_dt",
    )
