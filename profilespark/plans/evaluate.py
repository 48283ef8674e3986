"""Held-out evaluation of the frozen configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.functions.exprs import union_results, with_weight
from profilespark.operators.diagnostics import error_summary
from profilespark.operators.metrics import confusion_matrix, evaluation_summary, final_metrics_table, roc_curve
from profilespark.operators.models import fit_candidates, predict
from profilespark.operators.quality import align_features
from profilespark.session import materialize
from profilespark.spec import TableSpec

Configuration = tuple[str, float, dict[str, object]]


def evaluate_holdout(dev: DataFrame, test: DataFrame, spec: TableSpec, final: Configuration,
                     candidates: list[Configuration], experiment: str, weighted: bool) -> dict[str, DataFrame]:
    """Refit every family's configuration, score both sides with the selected one, and report."""
    spark = SparkSession.active()
    name, cv_score, parameters = final
    if name not in {c[0] for c in candidates}:
        raise ValueError(f"Selected model {name!r} is missing from the candidate parameters.")
    # The weights are settled here, once: every fit and figure below reads the same column.
    test, _ = with_weight(align_features(test, spec), spec, weighted)
    dev, spec = with_weight(dev, spec, weighted)
    accuracies, models = fit_candidates(candidates, dev, test, spec, weighted)
    # One scan of each side; everything below reads this written table.
    scored = materialize(
        union_results([predict(models[name], side.withColumn("split", F.lit(s)), name) for s, side in (("train", dev), ("test", test))]),
        "predictions",
    )
    cv = spark.createDataFrame([(name, float(cv_score))], "model string, development_cv_score double")
    metrics = final_metrics_table(scored, cv, experiment)
    text = {k: "None" if v is None else str(v) for k, v in parameters.items()}
    frozen = spark.createDataFrame([(name, text)], "model string, frozen_parameters map<string,string>")
    held_out = scored.where("split = 'test'").drop("split")
    return {
        "test_metrics": metrics,
        "candidate_test_metrics": accuracies,
        "test_predictions": held_out,
        "error_summary": error_summary(held_out),
        "confusion_matrix": confusion_matrix(held_out, ["model"]),
        "roc_curve": roc_curve(held_out, ["model"]),
        "evaluation_summary": evaluation_summary(metrics, scored, frozen, experiment, weighted),
    }
