"""Weighted metrics over prediction tables.

A prediction table holds ``y_true``, ``y_pred``, ``phishing_probability`` and,
optionally, ``sample_weight``; ``by`` names the columns to report by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from profilespark.functions.exprs import safe_ratio
from profilespark.functions.ranking import running_totals, unit_digits
from profilespark.session import materialize
from profilespark.spec import FAMILIES, NEGATIVE, POSITIVE, WEIGHT

METRICS = ("macro_f1", "phishing_precision", "phishing_recall", "accuracy", "roc_auc")


def prediction_mass(predictions: DataFrame) -> Column:
    return F.col(WEIGHT).cast("double") if WEIGHT in predictions.columns else F.lit(1.0)


def _sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def outcome_masses(predictions: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """True/false positive/negative mass, row counts and ``extra`` aggregates in one pass."""
    w, truth, pred = prediction_mass(predictions), F.col("y_true"), F.col("y_pred")
    pos, said = truth == POSITIVE, pred == POSITIVE
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(w).alias("mass"),
        _sum_where(pos & said, w).alias("tp"), _sum_where(pos & ~said, w).alias("fn"),
        _sum_where(~pos & said, w).alias("fp"), _sum_where(~pos & ~said, w).alias("tn"),
        F.count_if(pos | said).alias("_seen_pos"), F.count_if(~pos | ~said).alias("_seen_neg"),
        *extra,
    )


def _f1(hit: str) -> Column:
    return safe_ratio(2 * F.col(hit), 2 * F.col(hit) + F.col("fp") + F.col("fn"))


def accuracy_column() -> Column:
    return safe_ratio(F.col("tp") + F.col("tn"), F.col("mass"), default=None)


def macro_f1_column() -> Column:
    """Plain mean of the F1 of every label that occurs as truth or prediction."""
    pos = F.when(F.col("_seen_pos") > 0, _f1("tp")).otherwise(F.lit(0.0))
    neg = F.when(F.col("_seen_neg") > 0, _f1("tn")).otherwise(F.lit(0.0))
    labels = (F.col("_seen_pos") > 0).cast("int") + (F.col("_seen_neg") > 0).cast("int")
    return (pos + neg) / labels


def precision_column() -> Column:
    return safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))


def recall_column() -> Column:
    return safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))


def accuracy(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return outcome_masses(predictions, by).select(*by, accuracy_column().alias("accuracy"))


def macro_f1(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return outcome_masses(predictions, by).select(*by, macro_f1_column().alias("macro_f1"))


def precision(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return outcome_masses(predictions, by).select(*by, precision_column().alias("phishing_precision"))


def recall(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    return outcome_masses(predictions, by).select(*by, recall_column().alias("phishing_recall"))


def score_masses(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positive and negative mass per distinct score, with running totals from the lowest score.

    One pass over the predictions, pre-aggregated before the shuffle.
    """
    w, pos = prediction_mass(predictions), F.col("y_true") == POSITIVE
    cells = predictions.groupBy(*by, F.col("phishing_probability").alias("score")).agg(
        _sum_where(pos, w).alias("pos"), _sum_where(~pos, w).alias("neg"), F.lit(1).cast("bigint").alias("at")
    )
    return running_totals(cells, by, unit_digits(F.col("score")), "score", ["pos", "neg", "at"])


def roc_auc(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact weighted AUC: ties count half; NULL where only one class is present."""
    ranked = score_masses(predictions, by)
    return ranked.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0)), F.sum("pos") * F.sum("neg")
        ).alias("roc_auc")
    )


def roc_curve(predictions: DataFrame, by: Sequence[str], drop_collinear: bool = True) -> DataFrame:
    """(fpr, tpr, threshold) from the highest score down, starting at (0, 0) with a NULL threshold."""
    by = list(by)
    ranked = score_masses(predictions, by)
    totals = ranked.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("at").alias("points"))
    below_totals = ranked.join(F.broadcast(totals), by)  # one row per curve
    if drop_collinear:
        # Going down, the next point is the next lower score: the one before it in running order.
        lower = ranked.select(*by, (F.col("cum_at") + 1).alias("cum_at"), F.col("pos").alias("_pos"), F.col("neg").alias("_neg"))
        bends = (
            F.col("_pos").isNull() | (F.col("cum_at") == F.col("points"))
            | (F.col("pos") != F.col("_pos")) | (F.col("neg") != F.col("_neg")) | (F.col("points") <= 2)
        )
        below_totals = below_totals.join(lower, [*by, "cum_at"], "left").where(bends)
    point = below_totals.select(
        *by,
        F.try_divide(F.col("N") - F.col("cum_neg") + F.col("neg"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("P") - F.col("cum_pos") + F.col("pos"), F.col("P")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = totals.select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold"))
    return start.unionByName(point)


def confusion_matrix(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """All four cells per group, empty ones included, with their share of the true class."""
    masses = outcome_masses(predictions, by)
    actual = {POSITIVE: ("tp", "fn"), NEGATIVE: ("fp", "tn")}
    cells = [
        F.struct(
            F.lit(truth).alias("y_true"), F.lit(pred).alias("y_pred"), F.col(cell).alias("mass"),
            (100.0 * safe_ratio(F.col(cell), F.col(row[0]) + F.col(row[1]))).alias("row_percentage"),
        )
        for truth, row in actual.items() for pred, cell in zip((POSITIVE, NEGATIVE), row)
    ]
    return masses.select(*by, F.inline(F.array(*cells)))


def collapse_predictions(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """A prediction table with one weighted row per distinct (truth, label, score), written once."""
    cells = predictions.groupBy(*by, "y_true", "y_pred", "phishing_probability").agg(
        F.sum(prediction_mass(predictions)).alias(WEIGHT)
    )
    return materialize(cells, "outcomes")


def classification_metrics(predictions: DataFrame, by: Sequence[str]) -> DataFrame:
    """The five metrics in one row per group, from one pass over the predictions."""
    by = list(by)
    predictions = collapse_predictions(predictions, by)
    columns = {
        "macro_f1": macro_f1_column(), "phishing_precision": precision_column(),
        "phishing_recall": recall_column(), "accuracy": accuracy_column(),
    }
    masses = outcome_masses(predictions, by).select(*by, *[c.alias(n) for n, c in columns.items()])
    return masses.join(roc_auc(predictions, by), by, "left").select(*by, *METRICS)


def final_metrics_table(predictions: DataFrame, cv_scores: DataFrame, experiment: str) -> DataFrame:
    """One row per model from a prediction table with a train/test ``split`` column.

    ``cv_scores``: ``model, development_cv_score`` of the frozen configuration.
    """
    metrics = classification_metrics(predictions, ["model", "split"])
    at = lambda split, name: F.max(F.when(F.col("split") == split, F.col(name)))
    wide = metrics.groupBy("model").agg(
        at("train", "accuracy").alias("train_accuracy"), at("test", "accuracy").alias("test_accuracy"),
        at("test", "phishing_precision").alias("test_phishing_precision"),
        at("test", "phishing_recall").alias("test_phishing_recall"),
        at("test", "macro_f1").alias("test_macro_f1"), at("test", "roc_auc").alias("test_roc_auc"),
    )
    scores = cv_scores.select("model", F.col("development_cv_score").alias("development_cv_accuracy"))
    return wide.join(scores, "model").select(
        F.lit(experiment).alias("experiment"), "model", "development_cv_accuracy", "train_accuracy", "test_accuracy",
        "test_phishing_precision", "test_phishing_recall", "test_macro_f1", "test_roc_auc",
    )


def evaluation_summary(metrics: DataFrame, predictions: DataFrame, parameters: DataFrame | None = None,
                       run_name: str = "", weighted: bool = True) -> DataFrame:
    """One row per model: metrics, row counts and masses of both sides, frozen parameters."""
    sides = predictions.groupBy("model").agg(
        F.count_if(F.col("split") == "train").alias("train_observations"),
        F.count_if(F.col("split") == "test").alias("test_observations"),
        _sum_where(F.col("split") == "train", prediction_mass(predictions)).alias("train_weighted_mass"),
        _sum_where(F.col("split") == "test", prediction_mass(predictions)).alias("test_weighted_mass"),
    )
    summary = metrics.join(sides, "model").withColumns(
        {"run_name": F.lit(run_name), "weighted": F.lit(weighted)}
    )
    return summary if parameters is None else summary.join(parameters, "model")


def fold_boxplot_stats(fold_scores: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers, outliers and axis range of the outer-fold accuracies.

    One row per model over as many scores as there are outer folds.
    """
    scores = fold_scores.where(F.col("model").isin(*families)).select("model", F.col("accuracy").cast("double").alias("a"))
    quartiles = scores.groupBy("model").agg(F.expr("percentile(a, array(0.25d, 0.5d, 0.75d))").alias("q")).select(
        "model", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("a").between(low, high)
    boxes = scores.join(F.broadcast(quartiles), "model").groupBy("model", "q1", "median", "q3").agg(
        F.least(F.first("q1"), F.min(F.when(inside, F.col("a")))).alias("whisker_low"),
        F.greatest(F.first("q3"), F.max(F.when(inside, F.col("a")))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
        F.min("a").alias("_min"), F.max("a").alias("_max"),
    )
    everything = Window.partitionBy(F.lit(0))  # one row per model
    lowest, highest = F.min("_min").over(everything), F.max("_max").over(everything)
    margin = F.greatest(F.lit(0.004), (highest - lowest) * 0.08)
    return boxes.select(
        "model", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers",
        (lowest - margin).alias("axis_low"), (highest + margin).alias("axis_high"),
    )
