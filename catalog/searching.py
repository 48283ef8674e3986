"""Candidates, cross-validated scores and the choice among them.

Scores come from the prediction table (see ``inputs``): candidates share
operating points, so many of them tie exactly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.cleaning import _write_csv, kfold_sql
from catalog.measuring import BY, METRICS_SQL
from catalog.registry import query, r, rounded, sql_round
from profilespark.functions.exprs import union_results
from profilespark.operators import cross_validation, metrics, search
from profilespark.operators.splits import repeated_kfold_sums
from profilespark.session import materialize
from profilespark.sources import tables
from profilespark.spec import FAMILIES

TREE, FOREST = FAMILIES
TREE_NAMES, FOREST_NAMES = sorted(search.DECISION_TREE_SPACE), sorted(search.RANDOM_FOREST_SPACE)
SPLITS = range(1, i.N_SPLITS + 1)
SPLIT_NAMES = [f"split{n}_test_score" for n in range(i.N_SPLITS)]
SPLIT_SQL = ", ".join(f"{sql_round(n)} {n}" for n in SPLIT_NAMES)


def _results(spark, d, family, outer=False):
    by = ["outer_fold"] if outer else []
    scored = search.cv_results(i.search_scores(spark, d, family, outer), SPLITS, by)
    return scored.join(F.broadcast(i.candidates(spark, family)), "candidate_id")


def _chosen(spark, d, family, outer=False):
    rows = search.one_se_rule(_results(spark, d, family, outer), i.N_SPLITS, ["outer_fold"] if outer else [])
    return rows.withColumn("model", F.lit(family))


@query(f"""select candidate_id, {', '.join(f'g.{n}' for n in TREE_NAMES)}, {sql_round('mean_test_score')} mean_test_score
           from tree_grid g join tree_results using (candidate_id)""", "tree_grid", "tree_results")
def grid_candidates(spark, d):
    return rounded(_results(spark, d, TREE).select("candidate_id", *TREE_NAMES, "mean_test_score"), "mean_test_score")


@query(f"""select candidate_id, grid_id, {', '.join(f'cast(g.{n} as int) {n}' if n.endswith('bootstrap') else f'g.{n}' for n in FOREST_NAMES)},
             {sql_round('mean_test_score')} mean_test_score from forest_draw g join forest_results using (candidate_id)""", "forest_draw", "forest_results")
def random_candidates(spark, d):
    rows = _results(spark, d, FOREST).withColumn("classifier__bootstrap", F.col("classifier__bootstrap").cast("int"))
    return rounded(rows.select("candidate_id", "grid_id", *FOREST_NAMES, "mean_test_score"), "mean_test_score")


@query(f"""select model, outer_fold, {sql_round('sum(case when y_true=y_pred then sample_weight else 0 end)/sum(sample_weight)')} score
           from predictions group by all""", "predictions")
def weighted_accuracy_scorer(spark, d):
    rows = i.predictions(spark, d).drop("sample_weight")
    weights = i.weighted_orders(spark, d).select("row_id", "sample_weight")
    return rounded(cross_validation.weighted_accuracy(rows, weights, "row_id", BY), "score")


@query(f"""select candidate_id, {SPLIT_SQL}, {sql_round('mean_test_score')} mean_test_score, {sql_round('std_test_score')} std_test_score,
           cast(rank_test_score as int) rank_test_score from tree_results""", "tree_results")
def cv_results(spark, d):
    rows = search.cv_results(i.search_scores(spark, d, TREE), SPLITS)
    return rounded(rows, *SPLIT_NAMES, "mean_test_score", "std_test_score")


def _one_se(rows):
    chosen = rows.select("model", "outer_fold", "candidate_id", "mean_test_score", "threshold", search.K, search.DEPTH,
                         F.col("selected_by_one_se").cast("int").alias("selected_by_one_se"))
    return rounded(chosen, "mean_test_score", "threshold")


ONE_SE_SQL = f"""candidate_id, {sql_round('mean_test_score')} mean_test_score, {sql_round('threshold')} threshold,
  feature_selection__k, classifier__max_depth, cast(selected_by_one_se as int) selected_by_one_se"""


@query(f"""select '{TREE}' model, cast(outer_fold as int) outer_fold, {ONE_SE_SQL} from tree_fold_chosen
  union all select '{FOREST}', cast(outer_fold as int), {ONE_SE_SQL} from forest_fold_chosen""", "tree_fold_chosen", "forest_fold_chosen")
def one_se_rule(spark, d):
    return union_results([_one_se(_chosen(spark, d, f, True)) for f in FAMILIES])


FOLD_SCORES = f"""select model, cast(outer_fold as int) outer_fold, selected_k, cast(least(coalesce(try_cast(selected_k as int), 6), 6) as int) selected_feature_count,
    inner_selected_accuracy, inner_max_accuracy, macro_f1, phishing_precision, phishing_recall, accuracy, roc_auc
  from (select model, outer_fold, max(cast(feature_selection__k as varchar)) filter (selected_by_one_se) selected_k,
          max(mean_test_score) filter (selected_by_one_se) inner_selected_accuracy, max(mean_test_score) inner_max_accuracy
        from (select '{TREE}' model, outer_fold, feature_selection__k, selected_by_one_se, mean_test_score from tree_fold_chosen
              union all select '{FOREST}', outer_fold, feature_selection__k, selected_by_one_se, mean_test_score from forest_fold_chosen)
        group by model, outer_fold)
  join ({METRICS_SQL}) using (model, outer_fold)"""
SCORE_NAMES = ("inner_selected_accuracy", "inner_max_accuracy", "macro_f1", "phishing_precision", "phishing_recall", "accuracy", "roc_auc")


def _fold_scores(spark, d):
    searched = union_results([
        _chosen(spark, d, f, True).select("model", "outer_fold", search.K, "selected_by_one_se", "mean_test_score") for f in FAMILIES
    ])
    return search.fold_scores(searched, metrics.classification_metrics(i.predictions(spark, d), BY), len(i.ORDER_FEATURES))


@query(f"select model, outer_fold, selected_k, selected_feature_count, {', '.join(f'{sql_round(n)} {n}' for n in SCORE_NAMES)} from ({FOLD_SCORES})",
       "predictions", "tree_fold_chosen", "forest_fold_chosen")
def fold_scores(spark, d):
    return rounded(_fold_scores(spark, d), *SCORE_NAMES)


SUMMARY_METRICS = ("accuracy", "phishing_precision", "phishing_recall", "roc_auc")
SUMMARY = f"""select model, {', '.join(f'avg({m}) {m}_mean, stddev_samp({m}) {m}_std' for m in SUMMARY_METRICS)},
    avg(selected_feature_count) mean_selected_features, stddev_samp(selected_feature_count) std_selected_features
  from ({FOLD_SCORES}) group by model"""
SUMMARY_NAMES = [f"{m}_{s}" for m in SUMMARY_METRICS for s in ("mean", "std")] + ["mean_selected_features", "std_selected_features"]
SUMMARY_ROUNDED = ", ".join(f"{sql_round(n)} {n}" for n in SUMMARY_NAMES)
FOLD_INPUTS = ("predictions", "tree_fold_chosen", "forest_fold_chosen")


@query(f"select model, {SUMMARY_ROUNDED} from ({SUMMARY})", *FOLD_INPUTS)
def nested_cv_summary(spark, d):
    return rounded(search.nested_summary(_fold_scores(spark, d)), *SUMMARY_NAMES)


@query(f"select model, {SUMMARY_ROUNDED} from ({SUMMARY}) order by accuracy_mean desc, model limit 1", *FOLD_INPUTS)
def best_model_family(spark, d):
    return rounded(search.best_family(search.nested_summary(_fold_scores(spark, d))), *SUMMARY_NAMES)


def json_sql(names: list[str], text: set[str]) -> str:
    """JSON text of the parameters, names sorted, words quoted."""
    def value(n: str) -> str:
        quoted = f"'\"'||{n}||'\"'" if n in text else f"cast({n} as varchar)"
        return f"coalesce({quoted}, 'null')"

    return "'{'||" + "||','||".join(f"'\"{n}\":'||{value(n)}" for n in sorted(names)) + "||'}'"


TREE_TEXT = {"feature_selection__k", "classifier__criterion"}
FOREST_TEXT = TREE_TEXT | {"classifier__max_features"}
TREE_JSON, FOREST_JSON = json_sql(TREE_NAMES, TREE_TEXT), json_sql(FOREST_NAMES, FOREST_TEXT)
BEST = " union all ".join(
    f"""select '{model}' model, max(mean_test_score) filter (selected_by_one_se) development_cv_score, 'weighted_accuracy' development_cv_metric,
        max(mean_test_score) max_development_cv_score, max({text}) filter (selected_by_one_se) parameters from {source}"""
    for model, text, source in ((TREE, TREE_JSON, "tree_chosen"), (FOREST, FOREST_JSON, "forest_chosen"))
)
BEST_ROUNDED = f"""model, {sql_round('development_cv_score')} development_cv_score, development_cv_metric,
  {sql_round('max_development_cv_score')} max_development_cv_score, parameters"""


def _best_table(spark, d):
    return union_results([
        search.candidate_best_table(_chosen(spark, d, f), names, "weighted_accuracy") for f, names in zip(FAMILIES, (TREE_NAMES, FOREST_NAMES))
    ])


@query(f"select {BEST_ROUNDED} from ({BEST})", "tree_chosen", "forest_chosen")
def candidate_best_table(spark, d):
    return rounded(_best_table(spark, d), "development_cv_score", "max_development_cv_score")


@query(f"""select candidate_id, cast(selected_by_one_se as int) selected_by_one_se, cast(rank_test_score as int) rank_test_score,
  {sql_round('mean_test_score')} mean_test_score, {sql_round('std_test_score')} std_test_score, {TREE_JSON} params,
  {', '.join(f'{n} param_{n}' for n in TREE_NAMES)}, {SPLIT_SQL} from tree_chosen""", "tree_chosen")
def compact_search_results(spark, d):
    table = search.compact_search_results(_chosen(spark, d, TREE), TREE_NAMES)
    return rounded(table.withColumn("selected_by_one_se", F.col("selected_by_one_se").cast("int")), *SPLIT_NAMES, "mean_test_score", "std_test_score")


FINAL = f"""select '{TREE}' model, mean_test_score development_cv_score, 'weighted_accuracy' development_cv_metric, m max_development_cv_score,
  {', '.join(TREE_NAMES)} from (select *, max(mean_test_score) over () m from tree_chosen) where selected_by_one_se"""


def _final_parameters(spark, d):
    return search.final_best_parameters(_chosen(spark, d, TREE), TREE_NAMES, "weighted_accuracy", TREE)


@query(f"""select model, {sql_round('development_cv_score')} development_cv_score, development_cv_metric,
  {sql_round('max_development_cv_score')} max_development_cv_score, {', '.join(TREE_NAMES)} from ({FINAL})""", "tree_chosen")
def final_best_parameters(spark, d):
    return rounded(_final_parameters(spark, d), "development_cv_score", "max_development_cv_score")


DEPTHS = search.DECISION_TREE_SPACE[search.DEPTH]
DEPTH_NAMES = [str(x) for x in sorted(x for x in DEPTHS if x is not None)] + ["None"]


@query("select feature_selection__k k, " + ", ".join(
    f"{sql_round(f'''max(mean_test_score) filter (coalesce(cast(classifier__max_depth as varchar),'None')='{n}')''')} depth_{n}" for n in DEPTH_NAMES
) + " from tree_chosen group by feature_selection__k", "tree_chosen")
def hyperparameter_heatmap(spark, d):
    return rounded(search.hyperparameter_heatmap(_results(spark, d, TREE), DEPTHS), *[f"depth_{n}" for n in DEPTH_NAMES])


@query(f"""select candidate_id, cast(rank_test_score as int) rank_test_score, {sql_round('mean_test_score')} mean_test_score
           from tree_results where rank_test_score<=10""", "tree_results")
def report_top_n(spark, d):
    top = search.report_top_n(search.cv_results(i.search_scores(spark, d, TREE), SPLITS))
    return rounded(top.select("candidate_id", "rank_test_score", "mean_test_score"), "mean_test_score")


SPLIT_SIZES = search.DECISION_TREE_SPACE["classifier__min_samples_split"]


@query("select classifier__max_depth, " + ", ".join(
    f"{sql_round(f'avg(mean_test_score) filter (classifier__min_samples_split={n})')} classifier__min_samples_split_{n}" for n in SPLIT_SIZES
) + " from tree_chosen where classifier__max_depth is not null group by classifier__max_depth", "tree_chosen")
def score_pivot(spark, d):
    pivot = search.score_pivot(_results(spark, d, TREE), search.DEPTH, "classifier__min_samples_split", SPLIT_SIZES)
    return rounded(pivot, *[c for c in pivot.columns if c != search.DEPTH])


@query(f"""select candidate_id, cast(rank_test_score as int) rank_test_score, {sql_round('mean_test_score')} mean_test_score
           from tree_results order by rank_test_score, candidate_id limit 10""", "tree_results")
def best_rows(spark, d):
    top = search.best_rows(search.cv_results(i.search_scores(spark, d, TREE), SPLITS))
    return rounded(top.select("candidate_id", "rank_test_score", "mean_test_score"), "mean_test_score")


# --- I17: how optimistic the searched score is, over repeated trials --------------------------------------------------

TRIALS = range(100)
N_TRIAL_SPLITS = 4


def _trial_scores(spark, d):
    rows = i.predictions(spark, d).where(F.col("model") == TREE)
    histogram = repeated_kfold_sums(rows, "row_id", TRIALS, ["p1000"], i.masses(), N_TRIAL_SPLITS, "split")
    by = ["trial", "split"]
    at = i.candidates(spark, TREE).select("candidate_id", i.operating_point(F.col("candidate_id")).alias("threshold"))
    scores = i.threshold_scores(histogram, by).join(F.broadcast(at), "threshold").select(*by, "candidate_id", "score")
    return materialize(scores, "trial-scores")  # read for the search and for each held-out fold


def _outer_scores(scores):
    """Per trial and fold: the score there of the candidate that is best on the other folds."""
    totals = scores.groupBy("trial", "candidate_id").agg(F.sum("score").alias("total"))
    others = scores.join(F.broadcast(totals), ["trial", "candidate_id"]).withColumn("rest", F.round(F.col("total") - F.col("score"), 12))
    best = F.max_by("score", F.struct(F.col("rest"), -F.col("candidate_id")))
    return others.groupBy("trial", F.col("split").alias("outer_fold")).agg(best.alias("score"))


TRIAL_COPIES = f"(select *, 0 z from order_profiles cross join (select unnest(range({len(TRIALS)})) trial))"
TRIAL_ROWS = f"select trial, row_id, fold from ({kfold_sql(TRIAL_COPIES, N_TRIAL_SPLITS, 'trial', 'fold', 'trial', 'z')})"
TRIAL_SQL = f"""with dealt as (select t.trial, t.fold split, p.* from ({TRIAL_ROWS}) t join predictions p using (row_id) where model='{TREE}'),
  h as (select trial, split, p1000, sum(case when y_true=-1 then sample_weight else 0 end) pos, sum(case when y_true=-1 then 0 else sample_weight end) neg
        from dealt group by all),
  s as (select trial, split, candidate_id, sum(case when p1000>=t then pos else neg end)/sum(pos+neg) score
        from h cross join (select candidate_id, 300+(candidate_id*37)%400 t from tree_grid) group by all),
  searched as (select trial, max(m) non_nested_score from (select trial, candidate_id, avg(score) m from s group by all) group by trial),
  nested as (select trial, avg(score) nested_score from (
      select *, row_number() over (partition by trial, split order by round(total-score,12) desc, candidate_id) place
      from (select *, sum(score) over (partition by trial, candidate_id) total from s)) where place=1 group by trial)"""


@query(f"""{TRIAL_SQL} select trial, {sql_round('non_nested_score')} non_nested_score, {sql_round('nested_score')} nested_score,
  {sql_round('non_nested_score-nested_score')} difference from searched join nested using (trial)""", "order_profiles", "predictions", "tree_grid")
def selection_optimism(spark, d):
    scores = _trial_scores(spark, d)
    return rounded(search.selection_optimism(scores, _outer_scores(scores)), "non_nested_score", "nested_score", "difference")


@query(f"""{TRIAL_SQL} select {sql_round('avg(non_nested_score)')} average_non_nested_score, {sql_round('avg(nested_score)')} average_nested_score,
  {sql_round('avg(non_nested_score-nested_score)')} average_difference from searched join nested using (trial)""", "order_profiles", "predictions", "tree_grid")
def mean_optimism(spark, d):
    scores = _trial_scores(spark, d)
    means = search.mean_optimism(search.selection_optimism(scores, _outer_scores(scores)))
    return rounded(means, *means.columns)


# --- A9, A10: the parameter files written by a search and read back --------------------------------------------------

@query(f"""select model, {sql_round('development_cv_score')} development_cv_score, k, criterion, depth from (
  select '{TREE}' model, mean_test_score development_cv_score, feature_selection__k k, classifier__criterion criterion, cast(classifier__max_depth as varchar) depth
  from tree_chosen where selected_by_one_se
  union all select '{FOREST}', mean_test_score, feature_selection__k, classifier__criterion, cast(classifier__max_depth as varchar)
  from forest_chosen where selected_by_one_se)""", "tree_chosen", "forest_chosen")
def read_candidate_configs(spark, d):
    read = tables.read_candidate_configs(spark, _write_csv(spark, _best_table(spark, d), "candidates"))
    at = lambda n: F.try_element_at("parameters", F.lit(n))
    return read.select("model", r("development_cv_score").alias("development_cv_score"), at(search.K).alias("k"),
                       at("classifier__criterion").alias("criterion"), at(search.DEPTH).alias("depth"))


@query(f"""select '{TREE}' model, {sql_round('mean_test_score')} development_cv_score, name, "value" from tree_chosen,
  lateral (select unnest([{', '.join(f"'{n}'" for n in TREE_NAMES)}]) "name", unnest([{', '.join(f'cast({n} as varchar)' for n in TREE_NAMES)}]) "value")
  where selected_by_one_se""", "tree_chosen")
def read_final_config(spark, d):
    read = tables.read_final_config(spark, _write_csv(spark, _final_parameters(spark, d), "final"))
    return read.select("model", r("development_cv_score").alias("development_cv_score"), F.explode("parameters").alias("name", "value"))
