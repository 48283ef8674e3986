"""Hyper-parameter candidates, their cross-validated scores, and the choice among them.

Candidate and score tables hold one row per candidate and split: their size is
set by the search space, never by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.functions.ranking import hash_key
from profilespark.spec import K_VALUES, SEED

N_OUTER = 10
N_INNER = 5
RANDOM_ITERATIONS = 30 * len(K_VALUES)

# The two search spaces.
DECISION_TREE_SPACE = {
    "feature_selection__k": list(K_VALUES),
    "classifier__criterion": ["gini", "entropy"],
    "classifier__max_depth": [None, 3, 5, 7, 9, 12],
    "classifier__min_samples_split": [2, 4, 6, 8],
    "classifier__min_samples_leaf": [1, 2, 4],
}
RANDOM_FOREST_SPACE = {
    "feature_selection__k": list(K_VALUES),
    "classifier__n_estimators": [100, 200, 400, 600, 800],
    "classifier__criterion": ["gini", "entropy"],
    "classifier__max_depth": [None, 5, 10, 15, 20, 30],
    "classifier__min_samples_split": [2, 4, 6, 10],
    "classifier__min_samples_leaf": [1, 2, 4],
    "classifier__max_features": ["sqrt", "log2", 0.5, None],
    "classifier__bootstrap": [True, False],
}

# Seconds of a candidate on a split.
TIMES = ("fit_time", "score_time")
K = "feature_selection__k"
DEPTH = "classifier__max_depth"
# Complexity of "all features" and "no depth limit" when candidates are compared.
UNLIMITED = 999


def _values(values: Sequence[object]) -> Column:
    """Array literal; lists that mix numbers and words become text."""
    kinds = {type(v) for v in values if v is not None}
    mixed = len(kinds) > 1
    return F.array(*[F.lit(str(v) if mixed and v is not None else v) for v in values])


def grid_candidates(spark: SparkSession, space: Mapping[str, Sequence[object]]) -> DataFrame:
    """Every combination, numbered from 1: names in alphabetical order, the last varies fastest."""
    names = sorted(space)
    size, strides = 1, {}
    for name in reversed(names):
        strides[name] = size
        size *= len(space[name])
    place = lambda n: F.call_function("div", F.col("id"), F.lit(strides[n])) % F.lit(len(space[n]))
    return spark.range(size).select(
        (F.col("id") + 1).alias("candidate_id"),
        *[F.get(_values(space[n]), place(n).cast("int")).alias(n) for n in names],
    )


def random_candidates(spark: SparkSession, space: Mapping[str, Sequence[object]], n_iter: int = RANDOM_ITERATIONS,
                      seed: int = SEED) -> DataFrame:
    """``n_iter`` combinations without replacement, in seeded hash order."""
    grid = grid_candidates(spark, space).withColumnRenamed("candidate_id", "grid_id")
    drawn = grid.withColumn("_key", hash_key(seed, F.col("grid_id"))).orderBy("_key").limit(n_iter)
    order = Window.partitionBy(F.lit(0)).orderBy("_key")  # n_iter rows
    return drawn.select(F.row_number().over(order).cast("bigint").alias("candidate_id"), "grid_id", *sorted(space))


def cv_results(scores: DataFrame, splits: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population spread and min-rank per candidate, split scores side by side.

    Split scores are added in split order, so equal scores give equal means. Where the
    scores carry ``fit_time`` and ``score_time``, their mean and spread come along.
    """
    by = list(by)
    timed = [t for t in TIMES if t in scores.columns]
    times = scores.groupBy(*by, "candidate_id").agg(
        *[f(t).alias(f"{name}_{t}") for t in timed for name, f in (("mean", F.avg), ("std", F.stddev_pop))]
    ) if timed else None
    wide = scores.groupBy(*by, "candidate_id").pivot("split", list(splits)).agg(F.first("score"))
    names = [f"split{i}_test_score" for i in range(len(splits))]
    wide = wide.select(*by, "candidate_id", *[F.col(f"`{s}`").alias(n) for s, n in zip(splits, names)])
    n = F.lit(float(len(splits)))
    total = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    wide = wide.withColumn("mean_test_score", total / n)
    off = [F.col(c) - F.col("mean_test_score") for c in names]
    spread = sum((d * d for d in off[1:]), off[0] * off[0])
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("mean_test_score").desc())
    results = wide.withColumn("std_test_score", F.sqrt(spread / n)).withColumn("rank_test_score", F.rank().over(order))
    return results.join(times, [*by, "candidate_id"]) if timed else results


def _complexity(value: Column) -> Column:
    """Number behind a k or a depth; "all" and no limit come last."""
    return F.coalesce(value.try_cast("int"), F.lit(UNLIMITED))


def one_se_rule(results: DataFrame, n_splits: int, by: Sequence[str] = ()) -> DataFrame:
    """Flag the simplest candidate within one standard error of the best mean.

    Simplest: fewest features, then smallest depth, then highest mean, then
    first. Among equal best means the first candidate sets the threshold.
    """
    group = Window.partitionBy(*(by or [F.lit(0)]))
    best = group.orderBy(F.col("mean_test_score").desc(), "candidate_id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    threshold = F.first("mean_test_score").over(best) - F.first("std_test_score").over(best) / F.sqrt(F.lit(float(n_splits)))
    near = results.withColumn("threshold", threshold).withColumn("_near", F.col("mean_test_score") >= F.col("threshold"))
    simplest = group.orderBy(
        F.col("_near").desc(), _complexity(F.col(K)), _complexity(F.col(DEPTH)),
        F.col("mean_test_score").desc(), "candidate_id",
    )
    return near.withColumn("selected_by_one_se", F.row_number().over(simplest) == 1).drop("_near")


def parameters_json(names: Sequence[str]) -> Column:
    """Parameters as JSON text with sorted names, missing values kept as null."""
    return F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})


def compact_search_results(chosen: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """One row per candidate: id, flag, rank, scores, parameters as JSON and as columns, times where they were taken."""
    times = [f"{s}_{t}" for t in TIMES for s in ("mean", "std") if f"mean_{t}" in chosen.columns]
    splits = sorted(c for c in chosen.columns if c.startswith("split") and c.endswith("_test_score"))
    return chosen.select(
        "candidate_id", "selected_by_one_se", "rank_test_score", "mean_test_score", "std_test_score",
        parameters_json(parameters).alias("params"),
        *[F.col(p).alias(f"param_{p}") for p in sorted(parameters)], *splits, *times,
    )


def fold_scores(chosen: DataFrame, metrics: DataFrame, n_features: int) -> DataFrame:
    """Per (model, outer fold): what the inner search chose and how it did on the held-out fold."""
    search = chosen.groupBy("model", "outer_fold").agg(
        F.max(F.when(F.col("selected_by_one_se"), F.col(K).cast("string"))).alias("selected_k"),
        F.max(F.when(F.col("selected_by_one_se"), F.col("mean_test_score"))).alias("inner_selected_accuracy"),
        F.max("mean_test_score").alias("inner_max_accuracy"),
    )
    count = F.least(F.coalesce(F.col("selected_k").try_cast("int"), F.lit(n_features)), F.lit(n_features))
    return search.withColumn("selected_feature_count", count).join(metrics, ["model", "outer_fold"])


def nested_summary(scores: DataFrame) -> DataFrame:
    """Mean and sample spread of the outer-fold metrics per model."""
    columns = {
        "accuracy": "accuracy", "phishing_precision": "phishing_precision",
        "phishing_recall": "phishing_recall", "roc_auc": "roc_auc",
    }
    aggregates = [
        f(c).alias(f"{n}_{s}") for n, c in columns.items() for f, s in ((F.avg, "mean"), (F.stddev_samp, "std"))
    ]
    return scores.groupBy("model").agg(
        *aggregates,
        F.avg("selected_feature_count").alias("mean_selected_features"),
        F.stddev_samp("selected_feature_count").alias("std_selected_features"),
    ).orderBy(F.round("accuracy_mean", 12).desc(), "model")


def best_family(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.round("accuracy_mean", 12).desc(), "model").limit(1)


def candidate_best_table(chosen: DataFrame, parameters: Sequence[str], metric: str) -> DataFrame:
    """Per family: score of the chosen candidate, best score seen, parameters as JSON."""
    flagged = F.col("selected_by_one_se")
    return chosen.groupBy("model").agg(
        F.max(F.when(flagged, F.col("mean_test_score"))).alias("development_cv_score"),
        F.lit(metric).alias("development_cv_metric"),
        F.max("mean_test_score").alias("max_development_cv_score"),
        F.max(F.when(flagged, parameters_json(parameters))).alias("parameters"),
    )


def final_best_parameters(chosen: DataFrame, parameters: Sequence[str], metric: str, family: str) -> DataFrame:
    """One wide row for the chosen family."""
    group = Window.partitionBy("model")
    return chosen.where(F.col("model") == family).withColumn("_max", F.max("mean_test_score").over(group)).where(
        "selected_by_one_se"
    ).select(
        "model", F.col("mean_test_score").alias("development_cv_score"), F.lit(metric).alias("development_cv_metric"),
        F.col("_max").alias("max_development_cv_score"), *sorted(parameters),
    )


def hyperparameter_heatmap(results: DataFrame, depths: Sequence[int | None]) -> DataFrame:
    """Best mean score per (k, depth): k numeric then "all", depths numeric then "None"."""
    names = [str(d) for d in sorted(d for d in set(depths) if d is not None)] + (["None"] if None in depths else [])
    labelled = results.select(
        F.col(K).cast("string").alias("k"), F.coalesce(F.col(DEPTH).cast("string"), F.lit("None")).alias("depth"),
        "mean_test_score",
    )
    wide = labelled.groupBy("k").pivot("depth", names).agg(F.max("mean_test_score"))
    return wide.select("k", *[F.col(f"`{n}`").alias(f"depth_{n}") for n in names]).orderBy(_complexity(F.col("k")))


def report_top_n(results: DataFrame, n: int = 10) -> DataFrame:
    """Every candidate among the n best ranks, ties kept."""
    return results.where(F.col("rank_test_score") <= n)


def score_pivot(results: DataFrame, rows: str, columns: str, values: Sequence[object]) -> DataFrame:
    """Mean score by two parameters; rows without a value are left out, as a pivot table does."""
    wide = results.where(F.col(rows).isNotNull()).groupBy(rows).pivot(columns, list(values)).agg(F.avg("mean_test_score"))
    return wide.select(rows, *[F.col(f"`{v}`").alias(f"{columns}_{v}") for v in values])


def best_rows(results: DataFrame, n: int = 10) -> DataFrame:
    """First n candidates by rank."""
    return results.orderBy("rank_test_score", "candidate_id").limit(n)


def selection_optimism(search_scores: DataFrame, outer_scores: DataFrame) -> DataFrame:
    """Per trial: best searched score, mean nested score and their difference.

    ``search_scores``: trial, candidate_id, split, score over the whole table;
    ``outer_scores``: trial, outer_fold, score of the nested procedure.
    """
    means = search_scores.groupBy("trial", "candidate_id").agg(F.avg("score").alias("mean"))
    searched = means.groupBy("trial").agg(F.max("mean").alias("non_nested_score"))
    nested = outer_scores.groupBy("trial").agg(F.avg("score").alias("nested_score"))
    return searched.join(nested, "trial").withColumn("difference", F.col("non_nested_score") - F.col("nested_score"))


def mean_optimism(trials: DataFrame) -> DataFrame:
    return trials.agg(
        F.avg("non_nested_score").alias("average_non_nested_score"), F.avg("nested_score").alias("average_nested_score"),
        F.avg("difference").alias("average_difference"),
    )
