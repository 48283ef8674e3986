"""Labelled tables derived from the given ones, in Spark and as SQL text.

orders_profiles  order features in {-1, 0, 1}: many duplicates and conflicts, little signal
document_quality document features with a quality label: real signal, one constant column
predictions      two families' scores for every order, by integer arithmetic
search scores    weighted accuracy of each candidate's operating point on each split
order_trees      a fixed three-tree model over the order features
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.operators.diagnostics import prediction_table
from profilespark.operators.search import DECISION_TREE_SPACE, RANDOM_FOREST_SPACE, grid_candidates, random_candidates
from profilespark.operators.splits import stratified_holdout
from profilespark.operators.trees import Node
from profilespark.spec import FAMILIES, TableSpec

ORDER_FEATURES = ("f_lines", "f_qty", "f_returns", "f_disc", "f_status", "f_prio")
DOC_FEATURES = ("x_len", "x_lang", "x_at", "x_url", "x_sym")
AMOUNT_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
AMOUNTS = TableSpec(features=AMOUNT_FEATURES)
ORDERS = TableSpec(features=ORDER_FEATURES, key="row_id")
DOCS = TableSpec(features=DOC_FEATURES, key="row_id")
WEIGHTED_ORDERS = ORDERS.with_(weight="sample_weight")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _steps(value: Column, low: Column, high: Column) -> Column:
    return F.when(low, -1).when(high, 0).otherwise(1).cast("int")


def _order_columns() -> list[Column]:
    status = F.col("o_orderstatus")
    return [
        _steps(status, status == "F", status == "P").alias("f_status"),
        F.when(F.substring("o_orderpriority", 1, 1) <= "2", 1).otherwise(-1).cast("int").alias("f_prio"),
        F.when(F.col("o_totalprice") >= 250000, 1).otherwise(-1).cast("int").alias("Result"),
    ]


def _orders(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"), F.max("l_discount").alias("md"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    orders = table(spark, sf_dir, "orders")
    n, q, md, ret = (F.coalesce(F.col(c), F.lit(0)) for c in ("n", "q", "md", "returned"))
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], how).select(
        F.col("o_orderkey").cast("bigint").alias("row_id"),
        _steps(n, n <= 2, n <= 5).alias("f_lines"),
        _steps(q, q < 60, q < 120).alias("f_qty"),
        _steps(ret, ret == 0, ret == 1).alias("f_returns"),
        _steps(md, md < 0.05, md < 0.08).alias("f_disc"),
        *_order_columns(),
    )


def order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order; one without lines has none, no quantity, no discount and no returns."""
    return _orders(spark, sf_dir, "left")


def lined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir, "inner")


def _orders_sql(join: str) -> str:
    return f"""
select cast(o_orderkey as bigint) row_id,
  cast(case when n<=2 then -1 when n<=5 then 0 else 1 end as int) f_lines,
  cast(case when q<60 then -1 when q<120 then 0 else 1 end as int) f_qty,
  cast(case when ret=0 then -1 when ret=1 then 0 else 1 end as int) f_returns,
  cast(case when md<0.05::double then -1 when md<0.08::double then 0 else 1 end as int) f_disc,
  cast(case o_orderstatus when 'F' then -1 when 'P' then 0 else 1 end as int) f_status,
  cast(case when substr(o_orderpriority,1,1)<='2' then 1 else -1 end as int) f_prio,
  cast(case when o_totalprice>=250000 then 1 else -1 end as int) Result
from (
  select orders.*, coalesce(n,0) n, coalesce(q,0) q, coalesce(md,0) md, coalesce(ret,0) ret
  from orders {join} join (
    select l_orderkey, count(*) n, sum(l_quantity) q, max(l_discount) md,
           sum(case when l_returnflag='R' then 1 else 0 end) ret
    from lineitem group by l_orderkey) li on o_orderkey=l_orderkey)"""


ORDER_PROFILES, LINED_ORDERS = _orders_sql("left"), _orders_sql("inner")


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    symbols = F.length(F.regexp_replace("text", "[A-Za-z ]", "")) * F.lit(1.0) / F.col("n_chars")
    n, s = F.col("n_chars"), symbols
    return joined.select(
        F.col("doc_id").cast("bigint").alias("row_id"),
        _steps(n, n < 400, n < 2000).alias("x_len"),
        F.when(F.col("lang") == "en", 1).otherwise(-1).cast("int").alias("x_lang"),
        F.when(F.col("text").contains("@"), -1).otherwise(1).cast("int").alias("x_at"),
        F.when(F.col("text").contains("https://"), -1).otherwise(1).cast("int").alias("x_url"),
        _steps(s, s > 0.15, s > 0.05).alias("x_sym"),
        F.when(F.col("quality") == 0, -1).otherwise(1).cast("int").alias("Result"),
    )


DOCUMENT_QUALITY = """
select cast(doc_id as bigint) row_id,
  cast(case when n_chars<400 then -1 when n_chars<2000 then 0 else 1 end as int) x_len,
  cast(case when lang='en' then 1 else -1 end as int) x_lang,
  cast(case when text like '%@%' then -1 else 1 end as int) x_at,
  cast(case when text like '%https://%' then -1 else 1 end as int) x_url,
  cast(case when s>0.15::double then -1 when s>0.05::double then 0 else 1 end as int) x_sym,
  cast(case quality when 0 then -1 else 1 end as int) Result
from (select d.doc_id, n_chars, lang, text, quality,
        cast(length(regexp_replace(text,'[A-Za-z ]','','g')) as double)/n_chars s
      from documents d join labels l on d.doc_id=l.doc_id)"""


def weighted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order profiles with a weight of 1 to 3 and an outer fold of 1 to 10."""
    return order_profiles(spark, sf_dir).withColumns(
        {
            "sample_weight": (F.col("row_id") % 3 + 1).cast("double"),
            "outer_fold": (F.col("row_id") % 10 + 1).cast("int"),
        }
    )


WEIGHTED_ORDERS_SQL = """
select *, cast(row_id%3+1 as double) sample_weight, cast(row_id%10+1 as int) outer_fold from order_profiles"""


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order keyed by customer: orders without lines lack features, customers repeat."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"), *_order_columns())
    lines = lined_orders(spark, sf_dir).select(F.col("row_id").alias("order_id"), *ORDER_FEATURES[:4])
    return orders.join(lines, "order_id", "left").select(F.col("customer").alias("row_id"), *ORDER_FEATURES, "Result")


ORDERS_WITH_GAPS = """
select o_custkey row_id, f_lines, f_qty, f_returns, f_disc,
  cast(case o_orderstatus when 'F' then -1 when 'P' then 0 else 1 end as int) f_status,
  cast(case when substr(o_orderpriority,1,1)<='2' then 1 else -1 end as int) f_prio,
  cast(case when o_totalprice>=250000 then 1 else -1 end as int) Result
from orders left join (select row_id, f_lines, f_qty, f_returns, f_disc from lined_orders) l on l.row_id=o_orderkey"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with gaps whose pending ones carry a foreign label."""
    return orders_with_gaps(spark, sf_dir).withColumn("Result", F.when(F.col("f_status") == 0, 0).otherwise(F.col("Result")).cast("int"))


DIRTY_ORDERS = """
select * exclude (Result), cast(case when f_status=0 then 0 else Result end as int) Result from orders_with_gaps"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two families' predictions for every order."""
    rows = weighted_orders(spark, sf_dir).withColumnRenamed("Result", "y_true")
    positive = F.col("y_true") == -1
    u1, u2 = (F.col("row_id") * 7919) % 1000, (F.col("row_id") * 104729) % 1000
    div = lambda x, n: F.call_function("div", x, F.lit(n))
    first = F.when(positive, 300 + div(u1 * 7, 10)).otherwise(div(u1 * 6, 10))
    second = F.when(positive, 380 + div(u2 * 6, 10)).otherwise(div(u2 * 55, 100))
    both = F.array(*[F.struct(F.lit(m).alias("model"), p.alias("p1000")) for m, p in zip(FAMILIES, (first, second))])
    return rows.select("row_id", "outer_fold", "sample_weight", "y_true", F.inline(both)).select(
        "model", "outer_fold", "row_id", "sample_weight", "y_true",
        F.when(F.col("p1000") >= 500, -1).otherwise(1).cast("int").alias("y_pred"),
        (F.col("p1000").cast("double") / 1000.0).alias("phishing_probability"),
        F.col("p1000").cast("int").alias("p1000"),
    )


PREDICTIONS = """
select model, outer_fold, row_id, sample_weight, Result y_true,
  cast(case when p1000>=500 then -1 else 1 end as int) y_pred,
  cast(p1000 as double)/cast(1000 as double) phishing_probability, cast(p1000 as int) p1000
from (
  select 'Decision Tree' model, *, case when Result=-1 then 300+((row_id*7919)%1000*7)//10 else ((row_id*7919)%1000*6)//10 end p1000
  from weighted_orders
  union all
  select 'Random Forest' model, *, case when Result=-1 then 380+((row_id*104729)%1000*6)//10 else ((row_id*104729)%1000*55)//100 end p1000
  from weighted_orders)"""


# No prediction of this table is wrong with a confidence of 0.80, the usual threshold.
FLAGGED_FROM = 0.65


def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_table(predictions(spark, sf_dir).drop("p1000"), FLAGGED_FROM)


PREDICTION_ROWS = """
select *, y_true=y_pred correct,
  case when y_true=-1 and y_pred=-1 then 'true_positive_phishing' when y_true<>-1 and y_pred<>-1 then 'true_negative_legitimate'
       when y_true=-1 then 'false_negative' else 'false_positive' end error_type,
  y_true<>y_pred and predicted_confidence>=cast(0.65 as double) high_confidence_error
from (select * exclude (p1000), case when y_pred=-1 then phishing_probability else cast(1 as double)-phishing_probability end predicted_confidence
      from predictions)"""


def sided_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with the side of a stratified holdout their row is on."""
    sides = stratified_holdout(order_profiles(spark, sf_dir).select("row_id", "Result"), "Result", "row_id").select("row_id", "split")
    return prediction_rows(spark, sf_dir).join(sides, "row_id")


def holdout_sql(source: str, key: str = "row_id", test_size: float = 0.2, seed: int = 42) -> str:
    """Holdout by ranking whole classes; classes get their share by largest remainder."""
    return f"""
select s.* exclude (rn), case when rn <= base + case when place <= missing then 1 else 0 end then 'train' else 'test' end split
from (select *, row_number() over (partition by Result order by md5('{seed}:'||{key})) rn from {source}) s
join (select Result, base, row_number() over (order by rest desc, Result) place, n_train-sum(base) over () missing
      from (select Result, n_train, c*n_train//n base, (c*n_train)%n rest
            from (select Result, c, n, n-cast(ceil(cast({test_size} as double)*n) as bigint) n_train
                  from (select Result, count(*)::hugeint c, sum(count(*)) over () n from {source} group by Result)))) a using (Result)"""


SIDED_PREDICTIONS = f"""select p.*, split from prediction_rows p
  join (select row_id, split from ({holdout_sql('order_profiles')})) s using (row_id)"""

# ---------------------------------------------------------------------------
# Search scores. Each candidate labels rows at its own operating point, a score
# threshold set by its number; its score on a split is the weighted accuracy of
# the prediction table at that threshold.

THRESHOLDS = 400
N_SPLITS = 5


def operating_point(candidate: Column) -> Column:
    return (F.lit(300) + (candidate * 37) % THRESHOLDS).cast("int")


def threshold_scores(histogram: DataFrame, by: list[str]) -> DataFrame:
    """Weighted accuracy at every threshold 0..1000 from positive and negative mass per score."""
    below = Window.partitionBy(*by).orderBy("p1000").rowsBetween(Window.unboundedPreceding, -1)  # 1,001 rows
    everything = Window.partitionBy(*by)
    groups = histogram.select(*by).distinct()
    dense = groups.withColumn("p1000", F.explode(F.sequence(F.lit(0), F.lit(1000)))).join(histogram, [*by, "p1000"], "left")
    dense = dense.fillna({"pos": 0.0, "neg": 0.0})
    right = F.sum("pos").over(everything) - F.coalesce(F.sum("pos").over(below), F.lit(0.0)) + F.coalesce(
        F.sum("neg").over(below), F.lit(0.0)
    )
    return dense.select(*by, F.col("p1000").alias("threshold"), (right / F.sum(F.col("pos") + F.col("neg")).over(everything)).alias("score"))


def masses() -> dict[str, Column]:
    """Weight of a prediction on its true side."""
    w, positive = F.col("sample_weight"), F.col("y_true") == -1
    return {"pos": F.when(positive, w).otherwise(0.0), "neg": F.when(positive, 0.0).otherwise(w)}


def _histogram(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, "p1000").agg(*[F.sum(c).alias(n) for n, c in masses().items()])


def candidates(spark: SparkSession, family: str) -> DataFrame:
    if family == FAMILIES[0]:
        return grid_candidates(spark, DECISION_TREE_SPACE)
    return random_candidates(spark, RANDOM_FOREST_SPACE)


SPLIT = "cast((row_id div 10) % 5 + 1 as int)"


def search_scores(spark: SparkSession, sf_dir: str, family: str, outer: bool = False) -> DataFrame:
    """``[outer_fold,] candidate_id, split, score``; with ``outer``, on each outer training set."""
    rows = predictions(spark, sf_dir).where(F.col("model") == family).withColumn("split", F.expr(SPLIT))
    by = ["outer_fold", "split"] if outer else ["split"]
    histogram = _histogram(rows, by)
    if outer:
        others = F.array_except(F.sequence(F.lit(1), F.lit(10)), F.array("outer_fold"))
        histogram = histogram.withColumn("outer_fold", F.explode(others)).groupBy(*by, "p1000").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
        )
    at = candidates(spark, family).select("candidate_id", operating_point(F.col("candidate_id")).alias("threshold"))
    return threshold_scores(histogram, by).join(F.broadcast(at), "threshold").select(*by, "candidate_id", "score")


def _scores_sql(model: str, candidate_cte: str, outer: bool) -> str:
    fold = "f.fold outer_fold, " if outer else ""
    group = "f.fold, " if outer else ""
    folds = "cross join (select unnest(range(1,11)) fold) f where h.outer_fold<>f.fold and" if outer else "where"
    return f"""
select {fold}c.candidate_id, h.split,
  sum(case when h.p1000>=c.t then h.pos else h.neg end)/sum(h.pos+h.neg) score
from (select outer_fold, cast((row_id//10)%5+1 as int) split, p1000,
        sum(case when y_true=-1 then sample_weight else 0 end) pos, sum(case when y_true=-1 then 0 else sample_weight end) neg
      from predictions where model='{model}' group by all) h
  cross join (select candidate_id, 300+(candidate_id*37)%400 t from {candidate_cte}) c
  {folds} true
group by {group}c.candidate_id, h.split"""


def _axis(name: str, values: list) -> str:
    mixed = len({type(v) for v in values if v is not None}) > 1
    def lit(v):
        if v is None:
            return "null"
        if isinstance(v, bool):
            return str(v).lower()
        return f"'{v}'" if mixed or isinstance(v, str) else str(v)
    return "(values " + ", ".join(f"({i}, {lit(v)})" for i, v in enumerate(values)) + f") {name}"


def _grid_sql(space: dict[str, list]) -> str:
    names = sorted(space)
    short = {n: f"a{i}" for i, n in enumerate(names)}
    columns = ", ".join(f"{short[n]}.v {n}" for n in names)
    order = ", ".join(f"{short[n]}.i" for n in names)
    axes = " cross join ".join(_axis(f"{short[n]}(i, v)", space[n]) for n in names)
    return f"select row_number() over (order by {order}) candidate_id, {columns} from {axes}"


TREE_GRID = _grid_sql(DECISION_TREE_SPACE)
FOREST_DRAW = f"""
select row_number() over (order by md5('42:'||grid_id)) candidate_id, * from (
  select candidate_id grid_id, * exclude (candidate_id) from ({_grid_sql(RANDOM_FOREST_SPACE)})
  order by md5('42:'||candidate_id) limit 180)"""


def results_sql(scores: str, by: str = "") -> str:
    """Pivoted scores with mean, population spread and min-rank, split scores added in order."""
    key = f"{by}, " if by else ""
    splits = ", ".join(f"max(case when split={i+1} then score end) split{i}_test_score" for i in range(N_SPLITS))
    mean = "(" + "+".join(f"split{i}_test_score" for i in range(N_SPLITS)) + ")/cast(5 as double)"
    spread = "+".join(f"(split{i}_test_score-mean_test_score)*(split{i}_test_score-mean_test_score)" for i in range(N_SPLITS))
    partition = f"partition by {by} " if by else ""
    return f"""
select *, sqrt(({spread})/cast(5 as double)) std_test_score,
  rank() over ({partition}order by mean_test_score desc) rank_test_score
from (select *, {mean} mean_test_score from (select {key}candidate_id, {splits} from {scores} group by {key}candidate_id))"""


def one_se_sql(results: str, grid: str, by: str = "") -> str:
    partition = f"partition by {by} " if by else ""
    return f"""
select *, row_number() over ({partition}order by (mean_test_score>=threshold) desc,
    coalesce(try_cast(feature_selection__k as int),999), coalesce(classifier__max_depth,999), mean_test_score desc, candidate_id)=1 selected_by_one_se
from (select *, first_value(mean_test_score) over w - first_value(std_test_score) over w/sqrt(cast(5 as double)) threshold
      from {results} join {grid} using (candidate_id)
      window w as ({partition}order by mean_test_score desc, candidate_id rows between unbounded preceding and unbounded following))"""


# ---------------------------------------------------------------------------
# A fixed model over the order features: depth up to 3, f_qty twice on one path, f_status never used.

ORDER_TREES = [
    Node(0, 0, "f_qty", 0.5, 1, 2, 0.5), Node(0, 1, "f_qty", -0.5, 3, 4, 0.5), Node(0, 2, "f_returns", 0.5, 5, 6, 0.5),
    Node(0, 3, None, None, None, None, 0.9), Node(0, 4, None, None, None, None, 0.62),
    Node(0, 5, None, None, None, None, 0.3), Node(0, 6, None, None, None, None, 0.12),
    Node(1, 0, "f_lines", -0.5, 1, 2, 0.5), Node(1, 1, "f_prio", 0.0, 3, 4, 0.5), Node(1, 2, "f_disc", 0.5, 5, 6, 0.5),
    Node(1, 3, None, None, None, None, 0.75), Node(1, 4, None, None, None, None, 0.55),
    Node(1, 5, None, None, None, None, 0.45), Node(1, 6, None, None, None, None, 0.2),
    Node(2, 0, "f_disc", -0.5, 1, 2, 0.5), Node(2, 1, "f_lines", 0.5, 3, 4, 0.5), Node(2, 2, "f_qty", -0.5, 5, 6, 0.5),
    Node(2, 3, None, None, None, None, 0.8), Node(2, 4, None, None, None, None, 0.35),
    Node(2, 5, "f_prio", 0.0, 7, 8, 0.5), Node(2, 6, None, None, None, None, 0.25),
    Node(2, 7, None, None, None, None, 0.7), Node(2, 8, None, None, None, None, 0.5),
]


def tree_score_sql(prefix: str = "", replaced: dict[str, str] | None = None) -> str:
    """The fixed model as SQL, independent of the node list walk."""
    f = {n: (replaced or {}).get(n, f"{prefix}{n}") for n in ORDER_FEATURES}
    d = lambda v: f"cast({v} as double)"
    t0 = (f"case when {f['f_qty']}<=0.5 then case when {f['f_qty']}<=-0.5 then {d(0.9)} else {d(0.62)} end "
          f"when {f['f_returns']}<=0.5 then {d(0.3)} else {d(0.12)} end")
    t1 = (f"case when {f['f_lines']}<=-0.5 then case when {f['f_prio']}<=0 then {d(0.75)} else {d(0.55)} end "
          f"when {f['f_disc']}<=0.5 then {d(0.45)} else {d(0.2)} end")
    t2 = (f"case when {f['f_disc']}<=-0.5 then case when {f['f_lines']}<=0.5 then {d(0.8)} else {d(0.35)} end "
          f"when {f['f_qty']}<=-0.5 then case when {f['f_prio']}<=0 then {d(0.7)} else {d(0.5)} end else {d(0.25)} end")
    return f"((({t0})+({t1}))+({t2}))/cast(3 as double)"


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "order_profiles": (ORDER_PROFILES, ()),
    "lined_orders": (LINED_ORDERS, ()),
    "document_quality": (DOCUMENT_QUALITY, ()),
    "weighted_orders": (WEIGHTED_ORDERS_SQL, ("order_profiles",)),
    "orders_with_gaps": (ORDERS_WITH_GAPS, ("lined_orders",)),
    "dirty_orders": (DIRTY_ORDERS, ("orders_with_gaps",)),
    "predictions": (PREDICTIONS, ("weighted_orders",)),
    "prediction_rows": (PREDICTION_ROWS, ("predictions",)),
    "sided_predictions": (SIDED_PREDICTIONS, ("prediction_rows",)),
    "tree_grid": (TREE_GRID, ()),
    "forest_draw": (FOREST_DRAW, ()),
    "tree_scores": (_scores_sql(FAMILIES[0], "tree_grid", False), ("predictions", "tree_grid")),
    "forest_scores": (_scores_sql(FAMILIES[1], "forest_draw", False), ("predictions", "forest_draw")),
    "tree_fold_scores": (_scores_sql(FAMILIES[0], "tree_grid", True), ("predictions", "tree_grid")),
    "forest_fold_scores": (_scores_sql(FAMILIES[1], "forest_draw", True), ("predictions", "forest_draw")),
    "tree_results": (results_sql("tree_scores"), ("tree_scores",)),
    "forest_results": (results_sql("forest_scores"), ("forest_scores",)),
    "tree_fold_results": (results_sql("tree_fold_scores", "outer_fold"), ("tree_fold_scores",)),
    "forest_fold_results": (results_sql("forest_fold_scores", "outer_fold"), ("forest_fold_scores",)),
    "tree_chosen": (one_se_sql("tree_results", "tree_grid"), ("tree_results", "tree_grid")),
    "forest_chosen": (one_se_sql("forest_results", "forest_draw"), ("forest_results", "forest_draw")),
    "tree_fold_chosen": (one_se_sql("tree_fold_results", "tree_grid", "outer_fold"), ("tree_fold_results", "tree_grid")),
    "forest_fold_chosen": (one_se_sql("forest_fold_results", "forest_draw", "outer_fold"), ("forest_fold_results", "forest_draw")),
}
