"""Sources, sinks, checks, expressions, deduplication and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import inputs as i
from catalog.inputs import holdout_sql
from catalog.registry import query, r, sql_round
from profilespark.functions import exprs
from profilespark.operators import dedup, quality, splits
from profilespark.plans import prepare as plans
from profilespark.session import scratch_path
from profilespark.sources import arff, tables
from profilespark.spec import WEIGHT

FEATURES = ", ".join(i.ORDER_FEATURES)


def write_arff(spark: SparkSession, sf_dir: str) -> str:
    """The order profiles as ARFF text files with comments, blank lines, an ``Idx`` column and a target named ``class``."""
    path = scratch_path(spark, "arff")
    names = ["Idx", *i.ORDER_FEATURES, "class"]
    kinds = ["numeric", *["{-1,0,1}"] * len(i.ORDER_FEATURES), "{-1,1}"]
    header = ["% order profiles", "@relation orders", "", *[f"@attribute {n} {k}" for n, k in zip(names, kinds)], "@data", "", "% rows"]
    spark.createDataFrame([("\n".join(header),)], "value string").coalesce(1).write.text(path)
    rows = i.order_profiles(spark, sf_dir).select(F.concat_ws(",", "row_id", *i.ORDER_FEATURES, "Result").alias("value"))
    rows.write.mode("append").text(path)
    return path


def _write_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    return tables.write_table(df, scratch_path(spark, name), csv=True)


# --- A: sources and sinks -------------------------------------------------------------------------------------------

@query(f"select {FEATURES}, Result from order_profiles", "order_profiles")
def arff_scan(spark, d):
    return arff.load_source(spark, write_arff(spark, d))


@query(f"select cast(row_id as int) Idx, {FEATURES}, Result class from order_profiles", "order_profiles")
def normalize_ints(spark, d):
    return arff.normalize_ints(arff.arff_scan(spark, write_arff(spark, d)))


@query(f"select {FEATURES}, Result from order_profiles", "order_profiles")
def drop_id_columns(spark, d):
    rows = i.order_profiles(spark, d)
    return arff.drop_id_columns(rows.withColumnRenamed("row_id", "Unnamed: 0").withColumn("INDEX", F.col("f_qty")))


@query(f"select row_id, {FEATURES}, Result from order_profiles", "order_profiles")
def resolve_target(spark, d):
    return arff.resolve_target(i.order_profiles(spark, d).withColumnRenamed("Result", "class"))


@query(f"select cast(row_id as int) row_id, {FEATURES}, Result, sample_weight from weighted_orders", "weighted_orders")
def csv_scan(spark, d):
    path = _write_csv(spark, i.weighted_orders(spark, d).drop("outer_fold"), "csv")
    return tables.csv_scan(spark, path)


@query(f"select {FEATURES}, Result from order_profiles", "order_profiles")
def drop_index_columns(spark, d):
    rows = i.order_profiles(spark, d).withColumnsRenamed({"row_id": "Unnamed: 0"})
    return tables.drop_index_columns(rows)


@query("select Result, count(*) n_rows, cast(sum(row_id) as bigint) ids from order_profiles group by Result", "order_profiles")
def write_table(spark, d):
    path = tables.write_table(i.order_profiles(spark, d), scratch_path(spark, "table"), partition_by=["Result"])
    back = tables.parquet_scan(spark, path)
    return back.groupBy("Result").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("row_id").alias("ids"))


@query("select 'orders' dataset_variant, count(*) development_rows, sum(sample_weight) development_weighted_instances, "
       "cast(6 as bigint) input_features from weighted_orders", "weighted_orders")
def write_summary(spark, d):
    summary = i.weighted_orders(spark, d).agg(
        F.lit("orders").alias("dataset_variant"), F.count(F.lit(1)).alias("development_rows"),
        F.sum("sample_weight").alias("development_weighted_instances"),
    ).withColumn("input_features", F.lit(len(i.ORDER_FEATURES)))
    path = tables.write_summary(summary, scratch_path(spark, "summary"))
    return spark.read.json(path)


@query(f"""select md5('["'||concat_ws('","', {FEATURES}, Result)||'"]')||'-'||row_number() over (partition by {FEATURES}, Result order by row_id) row_id,
       {FEATURES}, Result from order_profiles""", "order_profiles")
def row_key(spark, d):
    return dedup.row_key(i.order_profiles(spark, d).drop("row_id"))


# --- B: checks ------------------------------------------------------------------------------------------------------

MISSING = "+".join(f"sum(case when {c} is null then 1 else 0 end)" for c in (*i.ORDER_FEATURES, "Result"))
FEATURE_MISSING = "+".join(f"sum(case when {c} is null then 1 else 0 end)" for c in i.ORDER_FEATURES)


def _report_sql(checks: dict[str, str], source: str) -> str:
    parts = [f'select \'{n}\' "check", cast({e} as bigint) failures, cast({e}=0 as int) passed from {source}' for n, e in checks.items()]
    return " union all ".join(parts)


EDA_CHECKS = {
    "table_empty": "(case when count(*)=0 then 1 else 0 end)",
    "unexpected_labels": "sum(case when Result not in (-1,1) then 1 else 0 end)",
    "missing_values": f"({MISSING})",
}


@query(_report_sql(EDA_CHECKS, "dirty_orders"), "dirty_orders")
def quality_report_eda(spark, d):
    return quality.quality_report(i.dirty_orders(spark, d), i.ORDERS).withColumn("passed", F.col("passed").cast("int"))


@query(_report_sql({**EDA_CHECKS, "missing_values": f"({FEATURE_MISSING})",
                    "absent_labels": "(case when max(case when Result=-1 then 1 else 0 end)=0 then 1 else 0 end"
                                     "+case when max(case when Result=1 then 1 else 0 end)=0 then 1 else 0 end)"},
                   "dirty_orders"), "dirty_orders")
def quality_report_modelling(spark, d):
    report = quality.quality_report(i.dirty_orders(spark, d), i.ORDERS, quality.MODELLING)
    return report.withColumn("passed", F.col("passed").cast("int"))


@query(" union all ".join(f"select * from (select '{c}' \"column\", count(*) missing from dirty_orders where {c} is null) where missing>0"
                          for c in i.ORDER_FEATURES), "dirty_orders")
def missing_by_column(spark, d):
    return quality.missing_by_column(i.dirty_orders(spark, d), i.ORDER_FEATURES)


@query("select row_id, count(*) n from dirty_orders group by row_id having count(*)>1", "dirty_orders")
def duplicate_keys(spark, d):
    return quality.duplicate_keys(i.dirty_orders(spark, d), "row_id")


@query("""select o_orderkey row_id, o_orderstatus from orders where not exists (select 1 from lined_orders w where w.row_id=o_orderkey)""",
       "lined_orders")
def unaligned_weights(spark, d):
    """Orders without lines have no weight where the weights are their lines'."""
    rows = i.table(spark, d, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus")
    return quality.unaligned_weights(rows, i.lined_orders(spark, d).select("row_id", F.lit(1.0).alias("sample_weight")), "row_id")


@query("""select 'left' side, count(*) duplicate_keys from (select row_id from dirty_orders group by row_id having count(*)>1)
          union all select 'right', count(*) from (select row_id from order_profiles group by row_id having count(*)>1)""",
       "dirty_orders", "order_profiles")
def join_guard(spark, d):
    return quality.join_guard(i.dirty_orders(spark, d), i.order_profiles(spark, d), "row_id")


@query(f"select row_id, Result, {FEATURES} from order_profiles", "order_profiles")
def align_features(spark, d):
    quality.check_schema(i.order_profiles(spark, d), i.ORDERS)
    shuffled = i.order_profiles(spark, d).select("Result", *reversed(i.ORDER_FEATURES), "row_id")
    return quality.align_features(shuffled, i.ORDERS)


@query("select model, outer_fold, row_id from predictions", "predictions")
def require_columns(spark, d):
    checked = quality.require_columns(i.predictions(spark, d), ("model", "outer_fold", "row_id"), "predictions")
    return checked.select("model", "outer_fold", "row_id")


# --- C: projections and expressions ---------------------------------------------------------------------------------

@query(f"select row_id, {FEATURES}, Result, cast(1 as double) sample_weight from order_profiles", "order_profiles")
def split_features_target(spark, d):
    return exprs.split_features_target(i.order_profiles(spark, d), i.ORDERS)


@query("select row_id, Result, cast(f.i as int) outer_fold from weighted_orders join (select unnest(range(1,11)) i) f on f.i<>outer_fold", "weighted_orders")
def select_rows(spark, d):
    """The training rows of every fold."""
    rows = i.weighted_orders(spark, d).select("row_id", "Result", "outer_fold")
    return splits.training_rows(rows, 10)


@query("select model, row_id, cast(case when y_true=-1 then 1 else 0 end as int) y_binary from predictions", "predictions")
def binarize_label(spark, d):
    return i.predictions(spark, d).select("model", "row_id", exprs.binarize_label(F.col("y_true")).alias("y_binary"))


@query(f"select model, row_id, {sql_round('predicted_confidence')} predicted_confidence from prediction_rows", "prediction_rows")
def predicted_confidence(spark, d):
    confidence = exprs.predicted_confidence(F.col("y_pred"), F.col("phishing_probability"))
    return i.predictions(spark, d).select("model", "row_id", r(confidence).alias("predicted_confidence"))


@query("select model, error_type, count(*) n_rows from prediction_rows group by all", "prediction_rows")
def error_type(spark, d):
    kind = exprs.error_type(F.col("y_true"), F.col("y_pred")).alias("error_type")
    return i.predictions(spark, d).groupBy("model", kind).agg(F.count(F.lit(1)).alias("n_rows"))


@query("select model, row_id from prediction_rows where high_confidence_error", "prediction_rows")
def high_confidence_error(spark, d):
    confidence = exprs.predicted_confidence(F.col("y_pred"), F.col("phishing_probability"))
    flag = exprs.high_confidence_error(F.col("y_true"), F.col("y_pred"), confidence, i.FLAGGED_FROM)
    return i.predictions(spark, d).where(flag).select("model", "row_id")


@query("""select model, row_id, case when p1000>500 then 'increases_phishing_probability'
          when p1000<500 then 'decreases_phishing_probability' else 'no_effect' end direction from predictions""", "predictions")
def direction(spark, d):
    return i.predictions(spark, d).select("model", "row_id", exprs.direction(F.col("phishing_probability") - 0.5).alias("direction"))


@query("""select f_lines, case f_lines when -1 then 'Phishing (-1)' when 1 then 'Legitimate (1)' else cast(f_lines as varchar) end label_name,
          count(*) n_rows from order_profiles group by all""", "order_profiles")
def label_names(spark, d):
    names = {-1: "Phishing (-1)", 1: "Legitimate (1)"}
    return i.order_profiles(spark, d).groupBy("f_lines", exprs.label_name(F.col("f_lines"), names).alias("label_name")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


RATIO = "sum(case when Result=-1 and f_qty=1 then 1 else 0 end)*cast(1 as double)/nullif(sum(case when f_lines=1 and f_qty=1 then 1 else 0 end),0)"


@query(f"select f_qty, {sql_round(f'coalesce({RATIO},0)')} ratio_or_zero, {sql_round(RATIO)} ratio_or_null from order_profiles group by f_qty",
       "order_profiles")
def safe_ratio(spark, d):
    top, bottom = (F.count_if(F.expr(e)) for e in ("Result = -1 and f_qty = 1", "f_lines = 1 and f_qty = 1"))
    return i.order_profiles(spark, d).groupBy("f_qty").agg(
        r(exprs.safe_ratio(top, bottom)).alias("ratio_or_zero"), r(exprs.safe_ratio(top, bottom, None)).alias("ratio_or_null")
    )


@query("""select 'predictions' source, model, count(*) n_rows from predictions group by model
          union all select 'orders', 'none', count(*) from order_profiles""", "predictions", "order_profiles")
def union_results(spark, d):
    count = F.count(F.lit(1)).alias("n_rows")
    return exprs.union_results([
        i.predictions(spark, d).groupBy("model").agg(count).withColumn("source", F.lit("predictions")),
        i.order_profiles(spark, d).agg(count).select(F.lit("none").alias("model"), "n_rows", F.lit("orders").alias("source")),
    ])


# --- D: deduplication -----------------------------------------------------------------------------------------------

VOTES = f"""(select {FEATURES}, sum(case when Result=-1 then 1 else 0 end) a, sum(case when Result=1 then 1 else 0 end) b
  from order_profiles group by {FEATURES})"""


@query(f"select distinct {FEATURES}, Result from order_profiles", "order_profiles")
def exact_dedup(spark, d):
    return dedup.exact_dedup(i.order_profiles(spark, d).drop("row_id"))


@query(f"""select {FEATURES}, cast(case when a>b then -1 else 1 end as int) Result, cast(greatest(a,b) as bigint) sample_weight
           from {VOTES} where a<>b""", "order_profiles")
def weighted_majority_dedup(spark, d):
    return dedup.weighted_majority_dedup(i.order_profiles(spark, d), i.ORDERS)


@query("""select distinct x_len, x_lang, x_at, x_url, x_sym, cast(case when a>b then -1 else 1 end as int) Result, cast(greatest(a,b) as bigint) sample_weight
          from (select x_len, x_lang, x_at, x_url, x_sym, sum(case when Result=-1 then 1 else 0 end) a, sum(case when Result=1 then 1 else 0 end) b
                from document_quality group by all) where a<>b""", "document_quality")
def weighted_majority_dedup_documents(spark, d):
    return dedup.weighted_majority_dedup(i.document_quality(spark, d), i.DOCS)


FOREIGN_VOTES = f"""(select {FEATURES}, sum(n) all_rows, count(Result) labels, max(n) filter (Result is not null) top_n,
    count(*) filter (n=top and Result is not null) holders, max(Result) filter (n=top) winner
  from (select *, max(n) filter (Result is not null) over (partition by {FEATURES}) top
        from (select {FEATURES}, Result, count(*) n from dirty_orders group by all)) group by {FEATURES})"""


@query(f"select {FEATURES}, winner Result, top_n sample_weight from {FOREIGN_VOTES} where holders=1", "dirty_orders")
def weighted_majority_dedup_foreign(spark, d):
    """A vote with a label that nobody declared, over profiles with gaps."""
    return dedup.weighted_majority_dedup(i.dirty_orders(spark, d), i.ORDERS)


@query(f"""select cast(sum(all_rows) as bigint) rows_before, count(*) profiles_before,
  count(*) filter (holders=1) profiles_kept, count(*) filter (holders<>1) dropped_ties, count(*) filter (holders=1 and labels>1) resolved_conflicts,
  cast(coalesce(sum(top_n) filter (holders=1),0) as bigint) retained_mass, cast(coalesce(sum(all_rows-top_n) filter (holders=1),0) as bigint) minority_mass,
  cast(coalesce(sum(all_rows) filter (holders<>1),0) as bigint) tied_mass from {FOREIGN_VOTES}""", "dirty_orders")
def weighted_dedup_report_foreign(spark, d):
    return dedup.weighted_dedup_report(i.dirty_orders(spark, d), i.ORDERS)


@query(f"""select cast(count(*) as bigint) rows_before, (select count(*) from (select distinct {FEATURES}, Result from order_profiles)) rows_after,
           count(*)-(select count(*) from (select distinct {FEATURES}, Result from order_profiles)) exact_duplicates_removed from order_profiles""",
       "order_profiles")
def exact_dedup_report(spark, d):
    return dedup.exact_dedup_report(i.order_profiles(spark, d).drop("row_id"))


@query(f"""select cast(sum(a+b) as bigint) rows_before, count(*) profiles_before,
  count(*) filter (a<>b) profiles_kept, count(*) filter (a=b) dropped_ties,
  count(*) filter (a<>b and a>0 and b>0) resolved_conflicts,
  cast(coalesce(sum(greatest(a,b)) filter (a<>b),0) as bigint) retained_mass,
  cast(coalesce(sum(least(a,b)) filter (a<>b),0) as bigint) minority_mass,
  cast(coalesce(sum(a+b) filter (a=b),0) as bigint) tied_mass from {VOTES}""", "order_profiles")
def weighted_dedup_report(spark, d):
    return dedup.weighted_dedup_report(i.order_profiles(spark, d), i.ORDERS)


@query(f"select count(*) unique_profiles from (select distinct {FEATURES} from order_profiles)", "order_profiles")
def unique_profiles(spark, d):
    return dedup.unique_profiles(i.order_profiles(spark, d), i.ORDERS).agg(F.count(F.lit(1)).alias("unique_profiles"))


# --- E: splits and folds --------------------------------------------------------------------------------------------

def kfold_sql(source: str, k: int, seed: str, out: str, within: str = "", label: str = "Result", key: str = "row_id") -> str:
    """Folds as contiguous ranges of the hash order within each class, sized by dealing class positions in turn."""
    group = f"{within}, " if within else ""
    inside = f"partition by {within} " if within else ""
    dealt = lambda n, j: f"(({n})//{k}*{j}+least(({n})%{k},{j}))"
    cuts = "+".join(f"(case when rn > {dealt('o+n', j)}-{dealt('o', j)} then 1 else 0 end)" for j in range(1, k))
    using = f"({group}{label})"
    return f"""
select s.* exclude (rn), cast(1+{cuts} as int) {out}
from (select *, row_number() over (partition by {group}{label} order by md5(({seed})||':'||{key})) rn from {source}) s
join (select {group}{label}, n, coalesce(sum(n) over ({inside}order by {label} rows between unbounded preceding and 1 preceding),0) o
      from (select {group}{label}, count(*) n from {source} group by all)) c using {using}"""


HOLDOUT = holdout_sql("order_profiles")
OUTER = kfold_sql("order_profiles", 10, "42", "outer_fold")
INNER = kfold_sql("(select * exclude (outer_fold), f.i outer_fold from outer_rows join (select unnest(range(1,11)) i) f on f.i<>outer_fold)",
                  5, "42+outer_fold", "inner_fold", "outer_fold")


@query(f"select row_id, Result, split from ({HOLDOUT})", "order_profiles")
def stratified_holdout(spark, d):
    return splits.stratified_holdout(i.order_profiles(spark, d), "Result", "row_id").select("row_id", "Result", "split")


@query(f"select row_id, Result, split from ({holdout_sql('document_quality', test_size=0.33, seed=7)})", "document_quality")
def stratified_holdout_unbalanced(spark, d):
    rows = splits.stratified_holdout(i.document_quality(spark, d), "Result", "row_id", 0.33, 7)
    return rows.select("row_id", "Result", "split")


@query(f"select row_id, Result, outer_fold from ({OUTER})", "order_profiles")
def stratified_kfold(spark, d):
    return splits.stratified_kfold(i.order_profiles(spark, d), "Result", "row_id").select("row_id", "Result", "outer_fold")


@query(f"with outer_rows as (select row_id, Result, outer_fold from ({OUTER})) select row_id, outer_fold, inner_fold from ({INNER})", "order_profiles")
def inner_kfold(spark, d):
    outer = splits.stratified_kfold(i.order_profiles(spark, d).select("row_id", "Result"), "Result", "row_id")
    return splits.inner_kfold(outer, "Result", "row_id").select("row_id", "outer_fold", "inner_fold")


@query(f"select row_id, inner_fold from ({kfold_sql('order_profiles', 5, '42', 'inner_fold')})", "order_profiles")
def final_kfold(spark, d):
    rows = splits.stratified_kfold(i.order_profiles(spark, d), "Result", "row_id", 5, out="inner_fold")
    return rows.select("row_id", "inner_fold")


@query(f"select row_id, fold from ({kfold_sql('(select *, 0 z from order_profiles)', 4, '1', 'fold', label='z')})", "order_profiles")
def kfold(spark, d):
    return splits.kfold(i.order_profiles(spark, d), "row_id", 4, 1).select("row_id", "fold")


@query(f"select row_id, {FEATURES} from order_profiles order by md5('42:'||row_id) limit 500", "order_profiles")
def background_sample(spark, d):
    return splits.background_sample(i.order_profiles(spark, d), "row_id").select("row_id", *i.ORDER_FEATURES)


# --- P: preparation -------------------------------------------------------------------------------------------------

@query(f"select row_id, {FEATURES}, Result, split from ({HOLDOUT})", "order_profiles")
def prepare_raw(spark, d):
    return plans.prepare(i.order_profiles(spark, d), i.ORDERS, "raw")


DISTINCT = f"""(select md5('["'||concat_ws('","', {FEATURES}, Result)||'"]')||'-1' row_id, * from (select distinct {FEATURES}, Result from order_profiles))"""


@query(holdout_sql(DISTINCT), "order_profiles")
def prepare_exact(spark, d):
    return plans.prepare(i.order_profiles(spark, d), i.ORDERS, "exact")


VOTED = f"""(select md5('["'||concat_ws('","', {FEATURES}, Result, sample_weight)||'"]')||'-1' row_id, * from
  (select {FEATURES}, cast(case when a>b then -1 else 1 end as int) Result, cast(greatest(a,b) as bigint) sample_weight from {VOTES} where a<>b))"""


@query(holdout_sql(VOTED), "order_profiles")
def prepare_weighted(spark, d):
    return plans.prepare(i.order_profiles(spark, d), i.ORDERS, "weighted")


@query(f"select split, count(*) n_rows, sum(cast(sample_weight as double)) mass from ({holdout_sql(VOTED)}) group by split", "order_profiles")
def split_report(spark, d):
    return dedup.split_report(plans.prepare_weighted(i.order_profiles(spark, d), i.ORDERS), WEIGHT)


@query(f"select {FEATURES}, Result, sample_weight from weighted_orders", "weighted_orders")
def load_and_prepare(spark, d):
    rows = i.weighted_orders(spark, d).drop("outer_fold").withColumnRenamed("row_id", "index")
    return plans.load_and_prepare(spark, _write_csv(spark, rows, "dev"))[0]
