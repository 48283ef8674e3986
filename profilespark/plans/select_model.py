"""Nested cross-validation of both families, the choice between them, and the final searches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from profilespark.functions.exprs import union_results, with_weight
from profilespark.operators import search
from profilespark.operators.cross_validation import search_scores, selections
from profilespark.operators.diagnostics import error_by_feature_value, error_summary, fold_pivot, prediction_table, wilcoxon_paired
from profilespark.operators.eda import mutual_information
from profilespark.operators.importance import REPEATS, importance_summary, permutation_importance
from profilespark.operators.metrics import classification_metrics
from profilespark.operators.growth import TREES_AT_A_TIME, Fit, Growth, cells_of, fit_of, grow, score_by
from profilespark.operators.models import split_parameters
from profilespark.operators.selection import feature_ranking_topn, selected_feature_table
from profilespark.operators.splits import inner_folds, stratified_kfold
from profilespark.operators.trees import predicted_label
from profilespark.session import materialize
from profilespark.spec import FAMILIES, HIGH_CONFIDENCE, SEED, WEIGHT, TableSpec


@dataclass(frozen=True)
class SearchPlan:
    """How wide to search. The defaults are the full spaces."""

    spaces: Mapping[str, Mapping[str, Sequence[object]]] = field(
        default_factory=lambda: dict(zip(FAMILIES, (search.DECISION_TREE_SPACE, search.RANDOM_FOREST_SPACE)))
    )
    n_outer: int = search.N_OUTER
    n_inner: int = search.N_INNER
    n_iter: int = search.RANDOM_ITERATIONS
    repeats: int = REPEATS
    seed: int = SEED
    at_a_time: int = TREES_AT_A_TIME

    def candidates(self, spark: SparkSession, family: str, seed: int) -> DataFrame:
        """The whole grid for trees, a random draw of it for forests."""
        if family == FAMILIES[0]:
            return search.grid_candidates(spark, self.spaces[family])
        return search.random_candidates(spark, self.spaces[family], self.n_iter, seed)


Choice = tuple[DataFrame, dict[int, dict]]


def run_searches(cells: DataFrame, spec: TableSpec, families: Sequence[str], plan: SearchPlan, seeds: Mapping[int, int]) -> dict[str, Choice]:
    """Per family the scored candidates of every group of cells with the one-standard-error choice flagged, and the choices' parameters.

    ``seeds`` holds the groups and what their candidates are drawn by. All families and groups are searched together.
    """
    spark = SparkSession.active()
    drawn = {f: {group: plan.candidates(spark, f, seed) for group, seed in seeds.items()} for f in families}
    records = {f: {group: [r.asDict() for r in c.collect()] for group, c in groups.items()} for f, groups in drawn.items()}
    scores = search_scores(cells, spec, records, plan.n_inner, plan.seed, plan.at_a_time)
    found = {}
    for family in families:
        names = sorted(plan.spaces[family])
        results = search.cv_results(scores.where(F.col("model") == family), range(1, plan.n_inner + 1), ["group"])
        schema = StructType([*next(iter(drawn[family].values())).schema, StructField("group", IntegerType())])
        listed = spark.createDataFrame([(*c.values(), group) for group, rows in records[family].items() for c in rows], schema)
        chosen = search.one_se_rule(results.join(listed, ["group", "candidate_id"]), plan.n_inner, ["group"])
        chosen = materialize(chosen.withColumn("model", F.lit(family)), "search")
        best = {r["group"]: {n: r[n] for n in names} for r in chosen.where("selected_by_one_se").select("group", *names).collect()}
        found[family] = (chosen, best)
    return found


def nested_cells(folded: DataFrame, spec: TableSpec, plan: SearchPlan) -> DataFrame:
    """Cells of every outer training set (the groups, from 1) by inner fold; fold 0 is the outer fold that is held out.

    One pass over the table: a row carries its inner folds as one array, and copies meet the counts on the map side.
    """
    rows = inner_folds(folded, spec.target, spec.key, plan.n_outer, plan.n_inner, plan.seed)
    copies = rows.select(*spec.features, spec.target, *([spec.weight] if spec.weight else []), F.posexplode("inner_folds").alias("place", "fold"))
    return cells_of(copies, spec, plan.n_inner, F.coalesce("fold", F.lit(0)), F.col("place") + 1)


def _held_out_predictions(folded: DataFrame, spec: TableSpec, growth: Growth, models: Mapping[int, tuple[str, int]]) -> DataFrame:
    """Every row's prediction by the fit that held out its fold; ``models`` names the (family, outer fold) of each fit."""
    spark = SparkSession.active()
    named = spark.createDataFrame([(f, *m) for f, m in models.items()], "fit int, model string, outer_fold int")
    named = named.join(growth.fits.select("fit", "features"), "fit")
    every = F.array(*[F.col(f).cast("double") for f in spec.features])
    rows = folded.select("outer_fold", spec.key, F.col(WEIGHT).cast("double").alias(WEIGHT), F.col(spec.target).alias("y_true"), every.alias("all"))
    rows = rows.join(F.broadcast(named), "outer_fold").withColumn("x", F.transform("features", lambda i: F.get("all", i)))  # a row per family and fold
    found = rows.join(growth.held_out().select("fit", "x", F.col("probability").alias("phishing_probability")), ["fit", "x"])
    return prediction_table(found.select(
        "model", "outer_fold", spec.key, WEIGHT, "y_true", predicted_label(F.col("phishing_probability")).alias("y_pred"), "phishing_probability"))


def _importance(folded: DataFrame, spec: TableSpec, growth: Growth, models: Mapping[int, Fit], family: str, plan: SearchPlan) -> DataFrame:
    """Permutation importance of every outer fold's model on its held-out rows, all folds together.

    Rows are told apart at every split point of any fold's model; what a model does not split on is exactly 0.
    """
    spark = SparkSession.active()
    splits = growth.nodes.where(F.col("place").isNotNull()).join(F.broadcast(growth.fits.select("fit", "features")), "fit")
    # One row per split point of a model.
    used = [(r["fit"], spec.features[r["feature"]], r["cut"]) for r in splits.select("fit", F.get("features", F.col("place")).alias("feature"), "cut").distinct().collect()]
    fold_of = {f.fit: p for p, f in models.items()}
    points: dict[str, set[float]] = {}
    for fit, feature, cut in used:
        if fit in fold_of:
            points.setdefault(feature, set()).add(cut)
    scores = permutation_importance(
        folded.where(F.col("outer_fold").isin(list(models))), spec, {f: sorted(points[f]) for f in spec.features if f in points},
        lambda cells: score_by(cells, "outer_fold", models, growth.nodes, spec), family, plan.repeats, plan.seed)
    split_on = spark.createDataFrame(sorted({(fold_of[f], feature) for f, feature, _ in used if f in fold_of}) or [], "outer_fold int, feature string")
    taken = spark.createDataFrame([(p, spec.features[i]) for p, f in models.items() for i in f.features], "outer_fold int, feature string")
    scores = scores.join(F.broadcast(split_on.withColumn("_split", F.lit(True))), ["outer_fold", "feature"], "left").join(
        F.broadcast(taken.withColumn("selected", F.lit(True))), ["outer_fold", "feature"], "left")
    exact = {c: F.when(F.col("_split"), F.col(c)).otherwise(0.0) for c in ("importance_mean", "importance_std")}
    return scores.withColumns(exact).select("model", "outer_fold", "feature", "importance_mean", "importance_std", F.coalesce("selected", F.lit(False)).alias("selected"))


def nested_cv(folded: DataFrame, spec: TableSpec, families: Sequence[str], plan: SearchPlan,
              weighted: bool = True) -> dict[str, DataFrame]:
    """Search on every outer training set, then score, predict and permute on its held-out fold.

    All outer folds are searched together: their training sets are groups of one table of counted cells. The choices
    are refitted together as well, with the held-out profiles on their way. Results are written as they are made.
    """
    folded, spec = with_weight(folded, spec, weighted)
    cells = nested_cells(folded, spec, plan)
    outer = range(1, plan.n_outer + 1)
    searches, models, fits = [], {}, []
    for family, (chosen, best) in run_searches(cells, spec, families, plan, {p: plan.seed + p for p in outer}).items():
        searches.append(chosen.select(
            "model", F.col("group").alias("outer_fold"), F.col(search.K).cast("string").alias(search.K), "selected_by_one_se", "mean_test_score"))
        picked = selections(cells, spec, plan.n_inner, sorted({str(b[search.K]) for b in best.values()}))
        for p in outer:
            k, params = split_parameters(best[p])
            models[len(fits)] = (family, p)
            fits.append(fit_of(family, params, picked[(p, 0, str(k))], fit=len(fits), group=p))
    predictions, importances = [], []
    for growth in grow(cells, fits, plan.seed, plan.at_a_time):
        grown = [f for f in fits if f.fit in {r["fit"] for r in growth.fits.select("fit").collect()}]
        predictions.append(materialize(_held_out_predictions(folded, spec, growth, {f.fit: models[f.fit] for f in grown}), "oof"))
        for family in families if plan.repeats else []:
            own = {models[f.fit][1]: f for f in grown if models[f.fit][0] == family}
            if own:
                importances.append(materialize(_importance(folded, spec, growth, own, family, plan), "importance"))
    tables = {"oof_predictions": union_results(predictions)}
    if importances:
        tables["permutation_importance"] = union_results(importances)
    metrics = classification_metrics(tables["oof_predictions"], ["model", "outer_fold"])
    tables["fold_scores"] = materialize(
        search.fold_scores(union_results(searches), metrics, len(spec.features)), "fold-scores"
    )
    return tables


def run_configuration(table: DataFrame, spec: TableSpec, plan: SearchPlan, metric: str, weighted: bool) -> DataFrame:
    """One row that records how a run was set up."""
    return table.agg(F.count(F.lit(1)).alias("development_rows"), F.sum(spec.mass).alias("development_weighted_instances")).withColumns({
        "input_features": F.lit(len(spec.features)),
        "feature_selection_k_values": F.array(*[F.lit(str(k)) for k in next(iter(plan.spaces.values()))[search.K]]),
        "random_state": F.lit(plan.seed),
        "primary_scoring": F.lit(metric),
        "random_forest_random_iterations": F.lit(plan.n_iter),
        "outer_folds": F.lit(plan.n_outer),
        "final_inner_folds": F.lit(plan.n_inner),
        "compute_permutation_importance": F.lit(plan.repeats > 0),
        "permutation_repeats": F.lit(plan.repeats),
        "high_confidence_threshold": F.lit(HIGH_CONFIDENCE),
        "sample_weighting_enabled": F.lit(weighted),
        "selection_rule": F.lit("one_standard_error"),
    })


def select_model(table: DataFrame, spec: TableSpec, plan: SearchPlan | None = None, weighted: bool = True) -> dict[str, DataFrame]:
    """Every table of the model-selection stage for one prepared development table.

    ``table`` holds key, features, target and perhaps a weight. The weight is settled here, once:
    every fit, score and report below reads the same column.
    """
    plan = plan or SearchPlan()
    table, spec = with_weight(table, spec, weighted)
    metric = "weighted_accuracy" if weighted else "accuracy"
    folded = materialize(stratified_kfold(table, spec.target, spec.key, plan.n_outer, plan.seed), "outer-folds", ["outer_fold"])
    families = [f for f in FAMILIES if f in plan.spaces]
    nested = nested_cv(folded, spec, families, plan, weighted)
    scores, predictions = nested["fold_scores"], nested["oof_predictions"]
    summary = search.nested_summary(scores)
    best = search.best_family(summary).first()["model"]

    final = cells_of(stratified_kfold(table, spec.target, spec.key, plan.n_inner, plan.seed, "inner_fold"), spec, plan.n_inner, F.col("inner_fold"))
    searches = run_searches(final, spec, families, plan, {0: plan.seed})
    chosen, parameters = searches[best][0].drop("group"), searches[best][1][0]
    names = sorted(plan.spaces[best])
    features = selected_feature_table(mutual_information(table, spec), spec, parameters[search.K])
    depths = plan.spaces[best][search.DEPTH]
    tables = {
        "run_config": run_configuration(table, spec, plan, metric, weighted),
        "fold_scores": scores,
        "model_summary": summary,
        "oof_predictions": predictions,
        "error_summary": error_summary(predictions),
        "error_by_feature_value": error_by_feature_value(predictions.drop("outer_fold"), table, spec),
        "candidate_best_parameters": union_results([
            search.candidate_best_table(rows.drop("group"), sorted(plan.spaces[f]), metric) for f, (rows, _) in searches.items()
        ]),
        "final_search_results": search.compact_search_results(chosen, names),
        "final_best_parameters": search.final_best_parameters(chosen, names, metric, best),
        "hyperparameter_heatmap": search.hyperparameter_heatmap(chosen, depths),
        "final_selected_features": features,
        "feature_ranking": feature_ranking_topn(features, spec),
    }
    if set(families) == set(FAMILIES):
        tables["statistical_tests"] = wilcoxon_paired(fold_pivot(scores))
    if plan.repeats:
        tables["permutation_importance_summary"] = importance_summary(nested["permutation_importance"])
    tables["results_summary"] = results_summary(tables, table, best, weighted)
    return tables


def results_summary(tables: dict[str, DataFrame], table: DataFrame, best: str, weighted: bool) -> DataFrame:
    """One row that sums the run up."""
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(WEIGHT).cast("double")).alias("weighted_instances"))
    final = tables["final_best_parameters"].select(
        F.col("model").alias("selected_model"), F.col(search.K).cast("string").alias("selected_k"),
        F.col("development_cv_score").alias("development_cv_accuracy"),
        F.col("max_development_cv_score").alias("max_development_cv_accuracy"),
    )
    nested = tables["model_summary"].where(F.col("model") == best).select(
        F.col("model").alias("selected_model"), F.col("accuracy_mean").alias("nested_cv_accuracy_mean"),
        F.col("accuracy_std").alias("nested_cv_accuracy_std"),
    )
    one_row = final.join(nested, "selected_model").join(size.withColumn("selected_model", F.lit(best)), "selected_model")
    if "statistical_tests" in tables:
        p = tables["statistical_tests"].select(F.lit(best).alias("selected_model"), F.col("p_value").alias("wilcoxon_p_value"))
        one_row = one_row.join(p, "selected_model", "left")
    return one_row.withColumn("sample_weighting_enabled", F.lit(weighted))
