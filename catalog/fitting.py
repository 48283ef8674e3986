"""Model fitting over whole tables, compared with trees grown in SQL.

Folds and repeats are those of the full plan; the search spaces hold fewer values of every parameter.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import growing, inputs as i
from catalog.cleaning import holdout_sql, kfold_sql
from catalog.exploring import DOCS_MI, k_best_sql
from catalog.measuring import METRICS_SQL
from catalog.registry import query, rounded, sql_round
from catalog.searching import SCORE_NAMES
from profilespark.operators import cross_validation, models, search, splits
from profilespark.operators.importance import importance_summary, permutation_importance
from profilespark.operators.selection import MutualInformationSelector
from profilespark.operators.trees import thresholds
from profilespark.plans import evaluate, explain, select_model
from profilespark.session import materialize, scratch_path
from profilespark.sources import tables
from profilespark.spec import FAMILIES, WEIGHT

TREE, FOREST = FAMILIES
TREE_PARAMETERS = {
    "feature_selection__k": 3, "classifier__criterion": "gini", "classifier__max_depth": 3,
    "classifier__min_samples_split": 2, "classifier__min_samples_leaf": 1,
}
FOREST_PARAMETERS = {**TREE_PARAMETERS, "classifier__n_estimators": 8, "classifier__max_features": "sqrt", "classifier__bootstrap": True}
ORDER_FOREST = {
    "feature_selection__k": 4, "classifier__criterion": "entropy", "classifier__max_depth": 4, "classifier__min_samples_split": 20, "classifier__min_samples_leaf": 5,
    "classifier__n_estimators": 10, "classifier__max_features": "log2", "classifier__bootstrap": True,
}
#: Every parameter takes several values; a tree over these features is at most LEVELS deep.
TREE_SPACE = {
    "feature_selection__k": [2, 4, "all"], "classifier__criterion": ["gini", "entropy"], "classifier__max_depth": [None, 2, 4],
    "classifier__min_samples_split": [2, 8], "classifier__min_samples_leaf": [1, 4],
}
FOREST_SPACE = {
    "feature_selection__k": [3, "all"], "classifier__n_estimators": [4, 6], "classifier__criterion": ["gini", "entropy"],
    "classifier__max_depth": [None, 3], "classifier__min_samples_split": [2, 4], "classifier__min_samples_leaf": [1, 2],
    "classifier__max_features": ["sqrt", "0.5", None], "classifier__bootstrap": [True, False],
}
LEVELS = 7
PLAN = select_model.SearchPlan(spaces={TREE: TREE_SPACE, FOREST: FOREST_SPACE}, n_iter=4)
SPEC = i.DOCS.with_(weight=WEIGHT)


def _documents(spark, d):
    return materialize(i.document_quality(spark, d).withColumn(WEIGHT, (F.col("row_id") % 3 + 1).cast("double")), "documents")


def _sides(spark, d):
    split = splits.stratified_holdout(_documents(spark, d), SPEC.target, "row_id")
    written = materialize(split, "split")
    return (written.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def tree_sql(source: str, train: str = "true", weight: str = "w", features=i.DOC_FEATURES, k: int | None = 3, depth: int = 3) -> str:
    """``row_id, y_true, y_pred`` of a tree grown in SQL, level by level, on the training rows of a table of small integers.

    The best cut of a node has the largest gini gain, the earlier feature and then the lower cut where several do.
    """
    chosen = "true" if k is None else f"feature in (select feature from ({k_best_sql(mi_sql(source, train), features)}) where place<={k})"
    cuts = ", ".join(f"('{f}', {n}, {c})" for n, (f, c) in enumerate((f, c) for f in features for c in (-0.5, 0.5)))
    gini = lambda a, b: f"(1-pow(({a})/(({a})+({b})),2)-pow(({b})/(({a})+({b})),2))"
    levels = []
    for level in range(depth):
        levels.append(f"""
  sums{level} as (
    select n.node, c.feature, c.ord, c.cut, count(*) filter (value<=cut) rows_l, count(*) filter (value>cut) rows_r,
      sum(case when value<=cut and y=-1 then w else 0 end) al, sum(case when value<=cut and y<>-1 then w else 0 end) bl,
      sum(case when value>cut and y=-1 then w else 0 end) ar, sum(case when value>cut and y<>-1 then w else 0 end) br
    from node{level} n join train using (row_id) join long using (row_id) join cuts c using (feature) group by all),
  gains{level} as (
    select *, {gini('al+ar', 'bl+br')}-(al+bl)/(al+bl+ar+br)*{gini('al', 'bl')}-(ar+br)/(al+bl+ar+br)*{gini('ar', 'br')} gain
    from sums{level} where rows_l>0 and rows_r>0),
  best{level} as (
    select * from (select *, row_number() over (partition by node order by round(gain,12) desc, ord) place from gains{level})
    where place=1 and gain>1e-12),
  node{level + 1} as (
    select n.row_id, case when b.node is null then n.node else 2*n.node+(case when value>cut then 1 else 0 end) end node
    from node{level} n left join best{level} b using (node) left join long on long.row_id=n.row_id and long.feature=b.feature)""")
    unpivoted = " union all ".join(f"select row_id, '{f}' feature, {f} value from data" for f in features)
    return f"""
with data as (select *, cast({weight} as double) w, Result y from {source}),
  train as (select row_id, w, y from data where {train}),
  long as ({unpivoted}),
  cuts as (select * from (values {cuts}) c(feature, ord, cut) where {chosen}),
  node0 as (select row_id, 1 node from data),{",".join(levels)},
  leaves as (select node, sum(case when y=-1 then w else 0 end) a, sum(case when y<>-1 then w else 0 end) b from node{depth} join train using (row_id) group by node)
select row_id, y y_true, cast(case when a>=b then -1 else 1 end as int) y_pred from node{depth} join leaves using (node) join data using (row_id)"""


def mi_sql(source: str, where: str = "true") -> str:
    """The selector's scores on the rows it is fitted on."""
    return DOCS_MI if source == "document_quality" and where == "true" else DOCS_MI.replace("document_quality", f"(select * from {source} where {where})")


TRAIN = "split='train'"
SPLIT_DOCUMENTS = f"(select q.*, q.row_id%3+1 weight, h.split from document_quality q join ({holdout_sql('document_quality')}) h using (row_id))"
WEIGHTED_DOCUMENTS = "(select *, row_id%3+1 weight from document_quality)"


@query(f"""select row_id, {', '.join(f"case when '{f}' in (select feature from ({k_best_sql(DOCS_MI, i.DOC_FEATURES)}) where place<=3) then cast({f} as double) end {f}" for f in i.DOC_FEATURES)}
           from document_quality""", "document_quality")
def mutual_information_selector(spark, d):
    """Every row's packed values, back under the names of the selected features."""
    rows = i.document_quality(spark, d)
    model = MutualInformationSelector(spec=i.DOCS, k=3).fit(rows)
    packed = model.transform(rows).withColumn("values", vector_to_array(model.getOrDefault("outputCol") if model.hasParam("outputCol") else "features"))
    at = {f: n for n, f in enumerate(model.selected)}
    return packed.select("row_id", *[(F.get("values", F.lit(at[f])) if f in at else F.lit(None).cast("double")).alias(f) for f in i.DOC_FEATURES])


@query(tree_sql(WEIGHTED_DOCUMENTS, weight="weight"), "document_quality")
def decision_tree(spark, d):
    rows = _documents(spark, d)
    return models.predict(models.fit(TREE, TREE_PARAMETERS, rows, SPEC), rows, TREE).select("row_id", "y_true", "y_pred")


@query(tree_sql("(select *, 1 weight from order_profiles)", weight="weight", features=i.ORDER_FEATURES, k=None), "order_profiles")
def decision_tree_orders(spark, d):
    """A tree over every order and all features."""
    rows = materialize(i.order_profiles(spark, d), "orders")
    model = models.fit(TREE, {**TREE_PARAMETERS, "feature_selection__k": "all"}, rows, i.ORDERS, weighted=False)
    return models.predict(model, rows, TREE).select("row_id", "y_true", "y_pred")


def _predicted(table):
    return rounded(table.select("row_id", "y_true", "y_pred", F.col("phishing_probability").alias("p")), "p", digits=9)


def _predicted_sql(statement: str) -> str:
    return statement.replace("y_pred, p from", f"y_pred, {sql_round('p', 9)} p from")


@query(_predicted_sql(growing.fit_sql(WEIGHTED_DOCUMENTS, FOREST_PARAMETERS, "weight")), "document_quality")
def random_forest(spark, d):
    """A forest on drawn rows and features; SQL draws the same."""
    rows = _documents(spark, d)
    return _predicted(models.predict(models.fit(FOREST, FOREST_PARAMETERS, rows, SPEC), rows, FOREST))


@query(_predicted_sql(growing.fit_sql("order_profiles", ORDER_FOREST, features=i.ORDER_FEATURES)), "order_profiles")
def random_forest_orders(spark, d):
    """A forest over every order: profiles of very many rows draw by the expansion of the distribution."""
    rows = materialize(i.order_profiles(spark, d), "orders")
    return _predicted(models.predict(models.fit(FOREST, ORDER_FOREST, rows, i.ORDERS, weighted=False), rows, FOREST))


@query(tree_sql(WEIGHTED_DOCUMENTS, weight="weight"), "document_quality")
def forest_without_bootstrap(spark, d):
    """A forest of equal trees: nothing is drawn, and every feature is looked at."""
    rows = _documents(spark, d)
    return models.predict(models.fit(FOREST, WHOLE_FOREST, rows, SPEC), rows, FOREST).select("row_id", "y_true", "y_pred")


def _candidates_sql(*parameters) -> str:
    """Held-out accuracy of models grown on the training side."""
    sides = " union all ".join(f"select '{m}' model, y_true, y_pred, row_id from ({growing.fit_sql(SPLIT_DOCUMENTS, p, 'weight', TRAIN)})" for m, p in zip(FAMILIES, parameters))
    return f"""select model, sum(case when y_true=y_pred then row_id%3+1 else 0 end)/cast(sum(row_id%3+1) as double) test_accuracy
      from ({sides}) join {SPLIT_DOCUMENTS} s using (row_id) where s.split='test' group by model"""


WHOLE_FOREST = {**FOREST_PARAMETERS, "classifier__bootstrap": False, "classifier__max_features": None}


@query(_candidates_sql(TREE_PARAMETERS, WHOLE_FOREST), "document_quality")
def fit_candidates_without_bootstrap(spark, d):
    """Held-out accuracy of both families where nothing is drawn."""
    dev, test = _sides(spark, d)
    return models.fit_candidates([(TREE, 0.0, TREE_PARAMETERS), (FOREST, 0.0, WHOLE_FOREST)], dev, test, SPEC, True)[0]


@query(f"select row_id, cast(case when y_pred=-1 then 0 else 1 end as double) label_index from ({tree_sql(WEIGHTED_DOCUMENTS, weight='weight')})", "document_quality")
def selector_and_classifier(spark, d):
    """Selection and classifier as one estimator."""
    rows = _documents(spark, d)
    fitted = models.build_model(TREE, TREE_PARAMETERS, SPEC, rows=rows.count()).fit(models.with_label(rows, SPEC))
    return fitted.transform(rows).select("row_id", F.col("prediction").alias("label_index"))


@query(f"""select 'weighted' model, * from ({tree_sql(WEIGHTED_DOCUMENTS, weight='weight')})
           union all select 'unweighted', * from ({tree_sql(WEIGHTED_DOCUMENTS, weight='1')})""", "document_quality")
def weighted_fit(spark, d):
    """The same parameters with and without weights, side by side."""
    rows = _documents(spark, d)
    fits = {"weighted": models.fit(TREE, TREE_PARAMETERS, rows, SPEC), "unweighted": models.fit(TREE, TREE_PARAMETERS, rows, SPEC, False)}
    scored = [models.predict(m, rows, name) for name, m in fits.items()]
    return scored[0].unionByName(scored[1]).select("model", "row_id", "y_true", "y_pred")


DEEP_TREE = {**TREE_PARAMETERS, "classifier__max_depth": None, "classifier__min_samples_split": 30}


@query(_predicted_sql(growing.fit_sql(WEIGHTED_DOCUMENTS, DEEP_TREE, "weight", levels=LEVELS)), "document_quality")
def minimum_split_as_cut(spark, d):
    """A tree of any depth whose small nodes are not split."""
    rows = _documents(spark, d)
    return _predicted(models.predict(models.fit(TREE, DEEP_TREE, rows, SPEC), rows, TREE))


@query(f"""select t.row_id, t.y_true, t.y_pred from ({growing.fit_sql(SPLIT_DOCUMENTS, TREE_PARAMETERS, 'weight', TRAIN)}) t
           join {SPLIT_DOCUMENTS} s using (row_id) where s.split='test'""", "document_quality")
def refit_frozen(spark, d):
    """A configuration refitted on the development side, read on the held-out one."""
    dev, test = _sides(spark, d)
    return models.predict(models.fit(TREE, TREE_PARAMETERS, dev, SPEC), test, TREE).select("row_id", "y_true", "y_pred")


@query(_candidates_sql(TREE_PARAMETERS, FOREST_PARAMETERS), "document_quality")
def fit_candidates(spark, d):
    dev, test = _sides(spark, d)
    chosen = [(TREE, 0.0, TREE_PARAMETERS), (FOREST, 0.0, FOREST_PARAMETERS)]
    return models.fit_candidates(chosen, dev, test, SPEC, True)[0]


FOLD_ROWS = f"""rows_ as materialized (select 0 grp, row_id, {', '.join(i.DOC_FEATURES)}, Result y, cast(weight as double) w, inner_fold fold
  from ({kfold_sql(WEIGHTED_DOCUMENTS, 5, '42', 'inner_fold')}))"""


def _scores_sql(candidates, draws: bool) -> str:
    return f"""with {FOLD_ROWS},{growing.search_sql('', {0: candidates}, 5, LEVELS, draws).replace('rows_ as materialized (select * from rows_),', '', 1)}
select candidate_id, split, {sql_round('score', 9)} score from scores"""


def _cv_scores(spark, d, family, candidates):
    folded = materialize(splits.stratified_kfold(_documents(spark, d), SPEC.target, "row_id", 5, out="inner_fold"), "folds")
    return rounded(cross_validation.cv_scores(folded, SPEC, family, [row.asDict() for row in candidates.collect()], 5), "score", digits=9)


@query(_scores_sql(growing.grid(TREE_SPACE), False), "document_quality")
def cv_scores(spark, d):
    """Every tree of a grid over all parameters on five splits."""
    return _cv_scores(spark, d, TREE, search.grid_candidates(spark, TREE_SPACE))


@query(_scores_sql(growing.draw(FOREST_SPACE, 8, 42), True), "document_quality")
def cv_scores_forests(spark, d):
    """Forests drawn from a space over all parameters on five splits."""
    return _cv_scores(spark, d, FOREST, search.random_candidates(spark, FOREST_SPACE, 8))


def _nested_tables(source: str, weight: str) -> str:
    """Both families' searches on ten outer training sets, the choices refitted, and all held-out predictions."""
    found = {TREE: ("t_", {p: growing.grid(TREE_SPACE) for p in range(1, 11)}), FOREST: ("f_", {p: growing.draw(FOREST_SPACE, PLAN.n_iter, 42 + p) for p in range(1, 11)})}
    parts = [growing.nested_rows(source, weight, 10, 5)]
    for prefix, candidates in found.values():
        parts += [growing.search_sql(prefix, candidates, 5, LEVELS, prefix == "f_"), growing.chosen_sql(prefix), growing.refit_sql(f"{prefix}r_", f"{prefix}picked", LEVELS, prefix == "f_")]
    key = growing.key_of(i.DOC_FEATURES)
    each = " union all ".join(f"""select '{family}' model, grp outer_fold, row_id, y y_true, w sample_weight, p phishing_probability, case when p>=0.5 then -1 else 1 end y_pred
      from rows_ join {prefix}r_predicted r on r.fit=grp and r.key={key} where fold=0""" for family, (prefix, _) in found.items())
    chosen = " union all ".join(f"select '{family}' model, grp outer_fold, feature_selection__k, selected_by_one_se, mean_test_score from {prefix}picked" for family, (prefix, _) in found.items())
    return ",".join(parts) + f", predictions as materialized ({each}), all_picked as materialized ({chosen})"


NESTED_SCORES = f"""select model, outer_fold, selected_k, cast(least(coalesce(try_cast(selected_k as int), 5), 5) as int) selected_feature_count,
  {', '.join(f'{sql_round(n)} {n}' for n in SCORE_NAMES)}
  from (select model, outer_fold, max(cast(feature_selection__k as varchar)) filter (selected_by_one_se) selected_k,
          max(mean_test_score) filter (selected_by_one_se) inner_selected_accuracy, max(mean_test_score) inner_max_accuracy from all_picked group by model, outer_fold)
  join ({METRICS_SQL}) using (model, outer_fold)"""


@query(f"with {_nested_tables(WEIGHTED_DOCUMENTS, 'weight')} {NESTED_SCORES}", "document_quality")
def nested_cv(spark, d):
    """Ten outer and five inner folds, both families; SQL searches, refits and scores the same."""
    folded = materialize(splits.stratified_kfold(_documents(spark, d), SPEC.target, "row_id", PLAN.n_outer), "outer")
    return rounded(select_model.nested_cv(folded, SPEC, FAMILIES, replace(PLAN, repeats=0))["fold_scores"], *SCORE_NAMES)


@query()
def permutation_importance_of_fit(spark, d):
    rows = _documents(spark, d).withColumn("outer_fold", F.lit(1))
    model = models.fit(TREE, TREE_PARAMETERS, rows, SPEC)
    return permutation_importance(rows, SPEC, thresholds(model.nodes), model.score, TREE, 3)


SELECTION_SCORES = ("development_cv_accuracy", "max_development_cv_accuracy", "nested_cv_accuracy_mean", "nested_cv_accuracy_std")


def _selection_sql(source: str, weight: str) -> str:
    """The one-row summary: the family that nested cross-validation prefers, and what the final search chose for it."""
    final = ",".join(
        f"{growing.search_sql(prefix, {0: candidates}, 5, LEVELS, prefix == 'fs_', rows='final_rows')},{growing.chosen_sql(prefix)}"
        for prefix, candidates in (("ts_", growing.grid(TREE_SPACE)), ("fs_", growing.draw(FOREST_SPACE, PLAN.n_iter, 42))))
    picked = " union all ".join(f"""select '{family}' model, max(cast(feature_selection__k as varchar)) filter (selected_by_one_se) selected_k,
      max(mean_test_score) filter (selected_by_one_se) development_cv_accuracy, max(mean_test_score) max_development_cv_accuracy from {prefix}picked""" for family, prefix in ((TREE, "ts_"), (FOREST, "fs_")))
    return f"""with {_nested_tables(source, weight)}, final_rows as materialized (select 0 grp, row_id, {', '.join(i.DOC_FEATURES)}, Result y, cast({weight} as double) w, inner_fold fold
  from ({kfold_sql(source, 5, '42', 'inner_fold')})),{final},
means as (select model, avg(accuracy) nested_cv_accuracy_mean, stddev_samp(accuracy) nested_cv_accuracy_std from ({METRICS_SQL}) group by model)
select model selected_model, selected_k, {', '.join(f'{sql_round(n)} {n}' for n in SELECTION_SCORES)}, (select count(*) from final_rows) "rows", (select sum(w) from final_rows) weighted_instances
from means join ({picked}) using (model) order by round(nested_cv_accuracy_mean,12) desc, model limit 1"""


@query(_selection_sql(WEIGHTED_DOCUMENTS, "weight"), "document_quality")
def model_selection(spark, d):
    """The whole stage on ten outer and five inner folds with twenty repeats: every table is written, the summary is returned."""
    stage = select_model.select_model(_documents(spark, d), SPEC, PLAN)
    written = tables.write_tables(stage, scratch_path(spark, "model-selection"))
    summary = tables.parquet_scan(spark, written["results_summary"])
    return rounded(summary.select("selected_model", "selected_k", *SELECTION_SCORES, "rows", "weighted_instances"), *SELECTION_SCORES)


@query()
def holdout_evaluation(spark, d):
    dev, test = _sides(spark, d)
    candidates = [(TREE, 0.8, TREE_PARAMETERS), (FOREST, 0.8, FOREST_PARAMETERS)]
    stage = evaluate.evaluate_holdout(dev, test, SPEC, candidates[1], candidates, "weighted", True)
    return stage["evaluation_summary"]


@query()
def local_explanations(spark, d):
    """Explanations of every held-out row; the additivity error must vanish."""
    dev, test = _sides(spark, d)
    rows = dev.withColumn("outer_fold", (F.col("row_id") % 2 + 1).cast("int"))
    model = models.fit(FOREST, FOREST_PARAMETERS, dev, SPEC)
    scores = permutation_importance(rows, SPEC, thresholds(model.nodes), model.score, FOREST, 2)
    summary = importance_summary(scores.withColumn("selected", F.lit(True)))
    return explain.explain(dev, test, SPEC, FOREST, FOREST_PARAMETERS, summary)["summary"]
