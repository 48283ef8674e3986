"""Scoring, permutation importance and Shapley values of a fixed tree model over every order."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.cleaning import _write_csv
from catalog.registry import query, rounded, sql_round
from profilespark.operators import importance, shapley
from profilespark.operators.splits import background_sample
from profilespark.operators.trees import score_nodes, thresholds
from profilespark.sources import tables

SCORE = i.tree_score_sql()
USED = ("f_disc", "f_lines", "f_prio", "f_qty", "f_returns")
REPEATS = 20


def _predict(df):
    return score_nodes(df, i.ORDER_TREES)


@query(f"""select row_id, {sql_round(SCORE)} phishing_probability, cast(case when {SCORE}>=0.5::double then -1 else 1 end as int) y_pred
           from order_profiles""", "order_profiles")
def predict_with_probability(spark, d):
    return rounded(_predict(i.order_profiles(spark, d)).select("row_id", "phishing_probability", "y_pred"), "phishing_probability")


def _permuted_sql() -> str:
    """Each used feature in turn: the fold's values in ascending order, dealt to rows in hash order."""
    parts = []
    for f in USED:
        score = i.tree_score_sql(replaced={f: "v"})
        parts.append(f"""
          select outer_fold, '{f}' feature, rep, sum(case when (case when {score}>=0.5::double then -1 else 1 end)=Result then sample_weight else 0 end)/sum(sample_weight) permuted
          from (select *, row_number() over (partition by outer_fold, rep order by md5((42+outer_fold)||'/{f}/'||rep||':'||row_id)) rn
                from weighted_orders cross join (select unnest(range(1,{REPEATS + 1})) rep))
          join (select outer_fold, {f} v, row_number() over (partition by outer_fold order by {f}) rn from weighted_orders) using (outer_fold, rn)
          group by outer_fold, rep""")
    return " union all ".join(parts)


IMPORTANCE = f"""select outer_fold, feature, avg(base-permuted) importance_mean, stddev_pop(base-permuted) importance_std from ({_permuted_sql()})
  join (select outer_fold, sum(case when (case when {SCORE}>=0.5::double then -1 else 1 end)=Result then sample_weight else 0 end)/sum(sample_weight) base
        from weighted_orders group by outer_fold) using (outer_fold) group by outer_fold, feature
  union all select distinct outer_fold, 'f_status', cast(0 as double), cast(0 as double) from weighted_orders"""


def _importance(spark, d):
    rows = i.weighted_orders(spark, d)
    return importance.permutation_importance(
        rows, i.WEIGHTED_ORDERS, thresholds(i.ORDER_TREES), _predict, "Decision Tree", REPEATS, portable=True
    )


@query(f"""select 'Decision Tree' model, outer_fold, feature, {sql_round('importance_mean', 8)} importance_mean, {sql_round('importance_std', 8)} importance_std
           from ({IMPORTANCE})""", "weighted_orders")
def permutation_importance(spark, d):
    return rounded(_importance(spark, d), "importance_mean", "importance_std", digits=8)


SUMMARY = f"""select 'Decision Tree' model, feature, cast(sum(case when feature<>'f_status' then 1 else 0 end) as bigint) selected_in_folds,
    avg(importance_mean) mean_importance, stddev_samp(importance_mean) std_importance_across_folds, avg(importance_std) mean_within_fold_std
  from ({IMPORTANCE}) group by feature"""
SUMMARY_NAMES = ("mean_importance", "std_importance_across_folds", "mean_within_fold_std")


def _summary(spark, d):
    scores = _importance(spark, d)
    return importance.importance_summary(scores.withColumn("selected", F.col("feature").isin(*USED)))


@query(f"select model, feature, selected_in_folds, {', '.join(f'{sql_round(n, 8)} {n}' for n in SUMMARY_NAMES)} from ({SUMMARY})", "weighted_orders")
def importance_summary(spark, d):
    return rounded(_summary(spark, d), *SUMMARY_NAMES, digits=8)


RANKED = f"""select cast(dense_rank() over (order by round(mean_importance,12) desc) as int) rank, model, feature, selected_in_folds,
    mean_importance importance_mean, coalesce(std_importance_across_folds,0) importance_std, mean_within_fold_std from ({SUMMARY})"""


@query(f"""select rank, model, feature, selected_in_folds, {sql_round('importance_mean', 8)} importance_mean, {sql_round('importance_std', 8)} importance_std,
           {sql_round('mean_within_fold_std', 8)} mean_within_fold_std from ({RANKED})""", "weighted_orders")
def importance_rank(spark, d):
    ranked = importance.importance_rank(_summary(spark, d), "Decision Tree")
    return rounded(ranked, "importance_mean", "importance_std", "mean_within_fold_std", digits=8)


@query(f"""select rank, feature, {sql_round('importance_mean', 8)} importance_mean, {sql_round('importance_std', 8)} importance_std,
  {sql_round('importance_mean-importance_std', 8)} bar_low, {sql_round('importance_mean+importance_std', 8)} bar_high
  from ({RANKED}) order by rank, feature limit 4""", "weighted_orders")
def importance_topn(spark, d):
    top = importance.importance_topn(importance.importance_rank(_summary(spark, d), "Decision Tree"), 4)
    return rounded(top, "importance_mean", "importance_std", "bar_low", "bar_high", digits=8)


@query(f"select model, feature, selected_in_folds, {', '.join(f'{sql_round(n, 8)} {n}' for n in SUMMARY_NAMES)} from ({SUMMARY})", "weighted_orders")
def read_importance_summary(spark, d):
    path = _write_csv(spark, _summary(spark, d), "importance")
    return rounded(tables.read_importance_summary(spark, path), *SUMMARY_NAMES, digits=8)


# Shapley values by definition: for every coalition of the five used features, the model on
# rows that take the coalition's features from the sample and the rest from the background.
# Coalition games are averaged over all 5! orders through the usual subset weights.
def _shapley_sql() -> str:
    names = ", ".join(USED)
    mixed = {f: f"(case when (s>>{n})&1=1 then x.{f} else z.{f} end)" for n, f in enumerate(USED)}
    score = i.tree_score_sql(replaced=mixed)
    # weight of joining a coalition of size c among 5 features: c!(4-c)!/5!
    weights = "[0.2, 0.05, 0.03333333333333333, 0.05, 0.2]"
    return f"""with x as (select row_number() over () pid, {names} from (select distinct {names} from order_profiles)),
  z as (select {names}, count(*) c from (select * from order_profiles order by md5('42:'||row_id) limit 500) group by {names}),
  games as (select pid, s, sum(c*({score}))/sum(c) v from x cross join z cross join (select unnest(range(0,32)) s) group by pid, s),
  gains as (select g.pid, {', '.join(
      f"sum(case when (g.s>>{n})&1=0 then {weights}[cast(bit_count(g.s) as int)+1]*(h{n}.v-g.v) else 0 end) phi_{f}" for n, f in enumerate(USED))}
    from games g {' '.join(f'left join games h{n} on h{n}.pid=g.pid and h{n}.s=g.s+{1 << n} and (g.s>>{n})&1=0' for n in range(len(USED)))} group by g.pid),
  by_row as (select row_id, o.*, gains.* exclude (pid) from order_profiles o join x using ({names}) join gains using (pid)),
  contributions as ({' union all '.join(f"select row_id, '{f}' feature, cast({f} as double) feature_value, {'phi_' + f if f in USED else 'cast(0 as double)'} shap_value from by_row" for f in i.ORDER_FEATURES)})"""


SHAPLEY = _shapley_sql()


def _explained(spark, d):
    rows = i.order_profiles(spark, d)
    return shapley.explained_rows(rows, background_sample(rows, "row_id"), i.ORDER_TREES, i.ORDERS)


@query(f"{SHAPLEY} select row_id, feature, feature_value, {sql_round('shap_value', 9)} shap_value from contributions", "order_profiles")
def shapley_contributions(spark, d):
    return rounded(shapley.shapley_contributions(_explained(spark, d), i.ORDERS), "shap_value", digits=9)


@query(f"""{SHAPLEY} select row_id, feature, feature_value, {sql_round('shap_value', 9)} shap_value, {sql_round('abs(shap_value)', 9)} absolute_shap_value,
  case when round(shap_value,12)>0 then 'increases_phishing_probability' when round(shap_value,12)<0 then 'decreases_phishing_probability' else 'no_effect' end direction,
  cast(row_number() over (partition by row_id order by round(abs(shap_value),12) desc, feature) as int) rank from contributions""", "order_profiles")
def contribution_table(spark, d):
    return rounded(shapley.contribution_table(_explained(spark, d), i.ORDERS), "shap_value", "absolute_shap_value", digits=9)


@query(f"""{SHAPLEY}, base as (select avg({SCORE}) b, count(*) n from (select * from order_profiles order by md5('42:'||row_id) limit 500))
  select row_id, cast(case when p>=0.5::double then -1 else 1 end as int) predicted_class, cast(-1 as int) explained_class, {sql_round('p')} explained_phishing_probability,
    {sql_round('b')} base_value, {sql_round('s')} sum_of_shap_values, {sql_round('b+s')} reconstructed_probability,
    cast(0 as double) absolute_additivity_error, n background_size
  from (select row_id, {SCORE} p from order_profiles) join (select row_id, sum(shap_value) s from contributions group by row_id) using (row_id) cross join base""",
       "order_profiles")
def explanation_summary(spark, d):
    background = background_sample(i.order_profiles(spark, d), "row_id")
    table = shapley.explanation_summary(_explained(spark, d), background, _predict, i.ORDERS)
    return rounded(table, "explained_phishing_probability", "base_value", "sum_of_shap_values", "reconstructed_probability", "absolute_additivity_error")
