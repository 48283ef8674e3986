"""One experiment from its source table to its explanations, every stage handing over through files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from profilespark.plans.evaluate import evaluate_holdout
from profilespark.plans.explain import explain
from profilespark.plans.prepare import prepare
from profilespark.plans.select_model import SearchPlan, select_model
from profilespark.sources import tables
from profilespark.spec import TableSpec


def run_experiment(source: DataFrame, folder: str, treatment: str, plan: SearchPlan | None = None,
                   weighted: bool | None = None) -> dict[str, DataFrame]:
    """Prepare, search, evaluate and explain one duplicate treatment (raw, exact or weighted).

    ``source`` holds features and target. Weights come from the weighted treatment alone; they are used
    where it made some, unless ``weighted`` says otherwise. Returns the written tables of all stages.
    """
    spark = source.sparkSession
    prepared = prepare(source, TableSpec.infer(source), treatment, f"{folder}/prepared")
    dev, test = (tables.split_table(prepared, side) for side in ("train", "test"))
    spec = TableSpec.infer(dev, key="row_id")
    weighted = spec.weight is not None if weighted is None else weighted

    chosen = tables.write_tables(select_model(dev, spec, plan, weighted), f"{folder}/selection", csv=False)
    handed = {
        name: tables.write_table(tables.parquet_scan(spark, chosen[name]), f"{folder}/handed/{name}", csv=True)
        for name in ("candidate_best_parameters", "final_best_parameters", "permutation_importance_summary") if name in chosen
    }
    candidates = tables.configurations(tables.read_candidate_configs(spark, handed["candidate_best_parameters"]))
    (final,) = tables.configurations(tables.read_final_config(spark, handed["final_best_parameters"]))

    evaluated = evaluate_holdout(dev, test, spec, final, candidates, treatment, weighted)
    written = chosen | tables.write_tables(evaluated, f"{folder}/evaluation")
    if "permutation_importance_summary" in handed:
        importance = tables.read_importance_summary(spark, handed["permutation_importance_summary"])
        explained = explain(dev, test, spec, final[0], final[2], importance, weighted=weighted)
        written |= tables.write_tables({f"explanation_{n}": t for n, t in explained.items()}, f"{folder}/explanation")
    return {"prepared": prepared} | {name: tables.parquet_scan(spark, path) for name, path in written.items()}
