"""Metrics, diagnostics and the paired test, over prediction tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.registry import query, r, rounded, sql_round
from profilespark.operators import diagnostics, metrics

BY = ["model", "outer_fold"]

# Masses per group, spelled out once for every metric below.
MASSES = """select model, outer_fold, sum(sample_weight) m,
  sum(case when y_true=-1 and y_pred=-1 then sample_weight else 0 end) tp, sum(case when y_true=-1 and y_pred=1 then sample_weight else 0 end) fn,
  sum(case when y_true=1 and y_pred=-1 then sample_weight else 0 end) fp, sum(case when y_true=1 and y_pred=1 then sample_weight else 0 end) tn
  from predictions group by model, outer_fold"""
ACCURACY = "(tp+tn)/m"
PRECISION = "coalesce(tp/nullif(tp+fp,0),0)"
RECALL = "coalesce(tp/nullif(tp+fn,0),0)"
F1 = "(coalesce(2*tp/nullif(2*tp+fp+fn,0),0)+coalesce(2*tn/nullif(2*tn+fp+fn,0),0))/2"


def auc_sql(source: str, by: str) -> str:
    """Pairwise definition: positive above negative counts 1, equal counts one half."""
    return f"""select {by}, sum(pos*(below+neg/2))/(sum(pos)*sum(neg)) roc_auc from (
      select *, sum(neg) over (partition by {by} order by s)-neg below from (
        select {by}, phishing_probability s, sum(case when y_true=-1 then sample_weight else 0 end) pos,
          sum(case when y_true=-1 then 0 else sample_weight end) neg from {source} group by all)) group by {by}"""


METRICS_SQL = f"""select model, outer_fold, {ACCURACY} accuracy, {PRECISION} phishing_precision, {RECALL} phishing_recall, {F1} macro_f1, roc_auc
  from ({MASSES}) join ({auc_sql('predictions', 'model, outer_fold')}) using (model, outer_fold)"""


@query(f"select model, outer_fold, {sql_round(ACCURACY)} accuracy from ({MASSES})", "predictions")
def accuracy(spark, d):
    return rounded(metrics.accuracy(i.predictions(spark, d), BY), "accuracy")


@query(f"select model, outer_fold, {sql_round(F1)} macro_f1 from ({MASSES})", "predictions")
def macro_f1(spark, d):
    return rounded(metrics.macro_f1(i.predictions(spark, d), BY), "macro_f1")


@query(f"select model, outer_fold, {sql_round(PRECISION)} phishing_precision from ({MASSES})", "predictions")
def precision(spark, d):
    return rounded(metrics.precision(i.predictions(spark, d), BY), "phishing_precision")


@query(f"select model, outer_fold, {sql_round(RECALL)} phishing_recall from ({MASSES})", "predictions")
def recall(spark, d):
    return rounded(metrics.recall(i.predictions(spark, d), BY), "phishing_recall")


@query(f"select model, {sql_round('roc_auc')} roc_auc from ({auc_sql('predictions', 'model')})", "predictions")
def roc_auc(spark, d):
    return rounded(metrics.roc_auc(i.predictions(spark, d), ["model"]), "roc_auc")


CURVE = """select *, row_number() over (partition by model order by s desc) place, count(*) over (partition by model) points,
    sum(pos) over (partition by model order by s desc) tps, sum(neg) over (partition by model order by s desc) fps,
    sum(pos) over (partition by model) P, sum(neg) over (partition by model) N
  from (select model, phishing_probability s, sum(case when y_true=-1 then sample_weight else 0 end) pos,
          sum(case when y_true=-1 then 0 else sample_weight end) neg from predictions group by all)"""
BENDS = f"""select *, coalesce(lead(tps) over w-2*tps+lag(tps) over w,1)<>0 or coalesce(lead(fps) over w-2*fps+lag(fps) over w,1)<>0 bend
  from ({CURVE}) window w as (partition by model order by s desc)"""
CURVE_COLUMNS = f"model, {sql_round('fps/N')} fpr, {sql_round('tps/P')} tpr, {sql_round('s')} threshold"
CURVE_START = "select distinct model, cast(0 as double) fpr, cast(0 as double) tpr, cast(null as double) threshold from predictions"


@query(f"{CURVE_START} union all select {CURVE_COLUMNS} from ({BENDS}) where bend", "predictions")
def roc_curve(spark, d):
    return rounded(metrics.roc_curve(i.predictions(spark, d), ["model"]), "fpr", "tpr", "threshold")


@query(f"{CURVE_START} union all select {CURVE_COLUMNS} from ({CURVE})", "predictions")
def roc_curve_all_points(spark, d):
    return rounded(metrics.roc_curve(i.predictions(spark, d), ["model"], False), "fpr", "tpr", "threshold")


@query(f"""select m.model, t.y y_true, p.y y_pred, coalesce(mass, cast(0 as double)) mass,
    {sql_round('coalesce(100*mass/sum(mass) over (partition by m.model, t.y), 0)')} row_percentage
  from (select distinct model from predictions) m cross join (values (-1),(1)) t(y) cross join (values (-1),(1)) p(y)
  left join (select model, y_true, y_pred, sum(sample_weight) mass from predictions group by all) c
    on c.model=m.model and c.y_true=t.y and c.y_pred=p.y""", "predictions")
def confusion_matrix(spark, d):
    return rounded(metrics.confusion_matrix(i.predictions(spark, d), ["model"]), "row_percentage")


NAMES = ("accuracy", "phishing_precision", "phishing_recall", "macro_f1", "roc_auc")
ROUNDED = ", ".join(f"{sql_round(n)} {n}" for n in NAMES)


@query(f"select model, outer_fold, {ROUNDED} from ({METRICS_SQL})", "predictions")
def classification_metrics(spark, d):
    return rounded(metrics.classification_metrics(i.predictions(spark, d), BY), *NAMES)


SIDES = f"""select model, split, {ACCURACY} accuracy, {PRECISION} phishing_precision, {RECALL} phishing_recall, {F1} macro_f1, roc_auc, m, n from (
    {MASSES.replace('outer_fold', 'split').replace('from predictions', ', count(*) n from sided_predictions')})
  join ({auc_sql('sided_predictions', 'model, split')}) using (model, split)"""
FINAL = f"""select 'weighted' experiment, te.model, cv.development_cv_score development_cv_accuracy, tr.accuracy train_accuracy, te.accuracy test_accuracy,
    te.phishing_precision test_phishing_precision, te.phishing_recall test_phishing_recall, te.macro_f1 test_macro_f1, te.roc_auc test_roc_auc,
    tr.n train_observations, te.n test_observations, tr.m train_weighted_mass, te.m test_weighted_mass
  from (select * from ({SIDES}) where split='test') te join (select * from ({SIDES}) where split='train') tr using (model)
  join (select model, avg(accuracy) development_cv_score from ({METRICS_SQL}) group by model) cv using (model)"""
FINAL_NAMES = ("development_cv_accuracy", "train_accuracy", "test_accuracy", "test_phishing_precision", "test_phishing_recall",
               "test_macro_f1", "test_roc_auc")
FINAL_ROUNDED = ", ".join(f"{sql_round(n)} {n}" for n in FINAL_NAMES)


def _final_metrics(spark, d):
    cv = metrics.accuracy(i.predictions(spark, d), BY).groupBy("model").agg(F.avg("accuracy").alias("development_cv_score"))
    return metrics.final_metrics_table(i.sided_predictions(spark, d), cv, "weighted")


@query(f"select experiment, model, {FINAL_ROUNDED} from ({FINAL})", "predictions", "sided_predictions")
def final_metrics_table(spark, d):
    return rounded(_final_metrics(spark, d), *FINAL_NAMES)


@query(f"""select experiment, model, {FINAL_ROUNDED}, train_observations, test_observations, train_weighted_mass, test_weighted_mass,
           'k_search' run_name, cast(1 as int) weighted from ({FINAL})""", "predictions", "sided_predictions")
def evaluation_summary(spark, d):
    summary = metrics.evaluation_summary(_final_metrics(spark, d), i.sided_predictions(spark, d), run_name="k_search")
    return rounded(summary.withColumn("weighted", F.col("weighted").cast("int")), *FINAL_NAMES)


BOX = f"""with scores as (select model, accuracy a from ({METRICS_SQL})),
  q as (select model, quantile_cont(a, 0.25) q1, quantile_cont(a, 0.5) median, quantile_cont(a, 0.75) q3 from scores group by model),
  span as (select min(a) lo, max(a) hi, greatest(0.004, (max(a)-min(a))*0.08) margin from scores)
  select model, {sql_round('q1')} q1, {sql_round('median')} median, {sql_round('q3')} q3,
    {sql_round('least(q1, min(a) filter (a between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)))')} whisker_low,
    {sql_round('greatest(q3, max(a) filter (a between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)))')} whisker_high,
    count(*) filter (not a between q1-1.5*(q3-q1) and q3+1.5*(q3-q1)) outliers,
    {sql_round('any_value(lo)-any_value(margin)')} axis_low, {sql_round('any_value(hi)+any_value(margin)')} axis_high
  from scores join q using (model) cross join span group by model, q.q1, q.median, q.q3"""


@query(BOX, "predictions")
def fold_boxplot_stats(spark, d):
    stats = metrics.fold_boxplot_stats(metrics.accuracy(i.predictions(spark, d), BY))
    return rounded(stats, "q1", "median", "q3", "whisker_low", "whisker_high", "axis_low", "axis_high")


# --- K: diagnostics -------------------------------------------------------------------------------------------------

def _flags(df):
    return rounded(
        df.withColumns({c: F.col(c).cast("int") for c in ("correct", "high_confidence_error")}),
        "phishing_probability", "predicted_confidence",
    )


PREDICTION_COLUMNS = f"""model, row_id, sample_weight, y_true, y_pred, {sql_round('phishing_probability')} phishing_probability,
  {sql_round('predicted_confidence')} predicted_confidence, cast(correct as int) correct, error_type, cast(high_confidence_error as int) high_confidence_error"""


@query(f"select outer_fold, {PREDICTION_COLUMNS} from prediction_rows", "prediction_rows")
def oof_predictions(spark, d):
    return _flags(i.prediction_rows(spark, d))


@query(f"select {PREDICTION_COLUMNS} from sided_predictions where split='test'", "sided_predictions")
def test_predictions(spark, d):
    return _flags(i.sided_predictions(spark, d).where("split = 'test'").drop("split", "outer_fold"))


RATES = ("weighted_false_negative_rate", "weighted_false_positive_rate", "weighted_error_rate")


@query(f"""select model, count(*) unique_profiles, sum(sample_weight) retained_weighted_instances,
    sum(sample_weight) filter (error_type='true_positive_phishing') true_positive_phishing_mass, sum(sample_weight) filter (error_type='false_negative') false_negative_mass,
    sum(sample_weight) filter (error_type='false_positive') false_positive_mass, sum(sample_weight) filter (error_type='true_negative_legitimate') true_negative_legitimate_mass,
    {sql_round("sum(sample_weight) filter (error_type='false_negative')/sum(sample_weight) filter (y_true=-1)")} weighted_false_negative_rate,
    {sql_round("sum(sample_weight) filter (error_type='false_positive')/sum(sample_weight) filter (y_true=1)")} weighted_false_positive_rate,
    {sql_round("sum(sample_weight) filter (not correct)/sum(sample_weight)")} weighted_error_rate,
    count(*) filter (high_confidence_error) high_confidence_errors, cast(0.65 as double) high_confidence_threshold
  from prediction_rows group by model""", "prediction_rows")
def error_summary(spark, d):
    return rounded(diagnostics.error_summary(i.prediction_rows(spark, d), i.FLAGGED_FROM), *RATES)


@query(" union all ".join(f"""select model, '{f}' feature, o.{f} feature_value, count(*) unique_profiles, sum(p.sample_weight) weighted_instances,
    coalesce(sum(p.sample_weight) filter (not correct), 0) weighted_errors, {sql_round("coalesce(sum(p.sample_weight) filter (not correct), 0)/sum(p.sample_weight)")} weighted_error_rate,
    count(*) filter (error_type='false_negative') false_negatives, count(*) filter (error_type='false_positive') false_positives,
    count(*) filter (high_confidence_error) high_confidence_errors, {sql_round("avg(phishing_probability)")} mean_phishing_probability
  from prediction_rows p left join order_profiles o using (row_id) group by model, o.{f}""" for f in i.ORDER_FEATURES), "prediction_rows")
def error_by_feature_value(spark, d):
    table = diagnostics.error_by_feature_value(i.prediction_rows(spark, d).drop("outer_fold"), i.order_profiles(spark, d), i.ORDERS)
    return rounded(table, "weighted_error_rate", "mean_phishing_probability")


PAIRED = f"""select outer_fold, max(case when model='Decision Tree' then accuracy end) dt, max(case when model='Random Forest' then accuracy end) rf
  from ({METRICS_SQL}) group by outer_fold"""


@query(f'select outer_fold, {sql_round("dt")} "Decision Tree", {sql_round("rf")} "Random Forest" from ({PAIRED})', "predictions")
def fold_pivot(spark, d):
    return rounded(diagnostics.fold_pivot(metrics.accuracy(i.predictions(spark, d), BY)), "Decision Tree", "Random Forest")


def wilcoxon_sql(pairs: str, by: str) -> str:
    """Exact test by listing all sign patterns of the ranks (folds are few); with ties or zeros, the normal
    approximation, whose distribution function is summed as its power series."""
    z = "abs((w-n*(n+1)/4.0)/sqrt((n*(n+1)*(2*n+1)-ties/2.0)/24.0))"
    series = f"list_sum(list_transform(range(0, 60), lambda k: pow({z}, 2*k+1)*sqrt(pi())/(pow(2, k+1)*gamma(k+1.5))))"
    normal = f"1-2*{series}*exp(-pow({z}, 2)/2)/sqrt(2*pi())"
    return f"""with d as (select {by}, round(rf-dt, 12) d from ({pairs})),
      placed as (select {by}, d, count(*) over (partition by {by}, abs(d)) t, rank() over (partition by {by} order by abs(d)) low from d where d<>0),
      seen as (select {by}, count(*) n, least(sum(case when d>0 then low+(t-1)/2.0 else 0 end), sum(case when d<0 then low+(t-1)/2.0 else 0 end)) w,
                 sum(t*t-1) ties from placed group by {by}),
      whole as (select {by}, count(*) sample_size, avg(d) mean_d from d group by {by}),
      signs as (select n, mask, sum(case when (mask>>(b-1))&1=1 then b else 0 end) w
                from (select distinct n from seen) cross join (select unnest(range(0, 1024)) mask) cross join (select unnest(range(1, 11)) b)
                where mask < (1::bigint<<n) and b<=n group by n, mask),
      listed as (select {by}, 2.0*count(*) filter (signs.w<=seen.w)/count(*) p from seen join signs using (n) group by {by}, seen.w)
      select {by}, 'Wilcoxon signed-rank' test, cast(w as double) statistic,
        {sql_round(f'case when ties=0 and n=sample_size then least(1, p) else greatest(0, {normal}) end', 10)} p_value, sample_size,
        {sql_round('mean_d')} mean_paired_difference_rf_minus_dt
      from seen join whole using ({by}) join listed using ({by})"""


TESTED = " union all ".join(
    f"""select '{m}' metric, outer_fold, max(case when model='Decision Tree' then {m} end) dt, max(case when model='Random Forest' then {m} end) rf
        from ({METRICS_SQL}) group by outer_fold""" for m in NAMES
)


@query(wilcoxon_sql(TESTED, "metric"), "predictions")
def wilcoxon_paired(spark, d):
    folds = metrics.classification_metrics(i.predictions(spark, d), BY)
    long = folds.unpivot(["model", "outer_fold"], list(NAMES), "metric", "score")
    tests = diagnostics.wilcoxon_paired(diagnostics.fold_pivot(long, ["metric"], "score"), ["metric"])
    return tests.withColumns({"p_value": r("p_value", 10), "mean_paired_difference_rf_minus_dt": r("mean_paired_difference_rf_minus_dt")})
