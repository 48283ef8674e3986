"""Exploratory aggregates and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs as i
from catalog.registry import query, r, rounded, sql_round
from profilespark.operators import eda, selection
from profilespark.plans.explore import explore as explore_table

DIGITS = 10
MI = lambda c="mutual_information": sql_round(c, DIGITS)


def _position(features: tuple[str, ...], column: str = "feature") -> str:
    return "case " + column + " " + " ".join(f"when '{f}' then {n}" for n, f in enumerate(features, 1)) + " end"


def long_sql(source: str, features: tuple[str, ...], keep: str) -> str:
    return " union all ".join(f"select '{f}' feature, {f} value, {keep} from {source}" for f in features)


def statistics_sql(source: str, features: tuple[str, ...], weight: str) -> str:
    names = ", ".join(features)
    missing = "+".join(f"sum(case when {c} is null then 1 else 0 end)" for c in [*features, "Result", *([] if weight == "1" else [weight])])
    base = f"""select count(*) n, (select count(*) from (select distinct {names} from {source})) profiles,
      cast(sum({weight}) as double) m, {missing} missing,
      sum(case when Result=-1 then 1 else 0 end) n_pos, sum(case when Result=1 then 1 else 0 end) n_neg,
      cast(sum(case when Result=-1 then {weight} else 0 end) as double) m_pos,
      cast(sum(case when Result=1 then {weight} else 0 end) as double) m_neg from {source}"""
    entries = [
        (eda.ROWS, "n"), (eda.PROFILES, "profiles"), (eda.MASS, "m"), (eda.FEATURES, str(len(features))),
        (eda.MISSING, "missing"), (eda.POSITIVE_ROWS, "n_pos"), (eda.NEGATIVE_ROWS, "n_neg"), (eda.POSITIVE_MASS, "m_pos"),
        (eda.POSITIVE_SHARE, "round(100*m_pos/m,2)"), (eda.NEGATIVE_MASS, "m_neg"), (eda.NEGATIVE_SHARE, "round(100*m_neg/m,2)"),
        (eda.IMBALANCE, "round(greatest(m_pos,m_neg)/nullif(least(m_pos,m_neg),0),3)"),
    ]
    rows = " union all ".join(
        f"select cast({n} as int) position, '{name}' statistic, cast({e} as double) \"value\" from base" for n, (name, e) in enumerate(entries, 1)
    )
    return f"with base as ({base}) {rows}"


@query(statistics_sql("weighted_orders", i.ORDER_FEATURES, "sample_weight"), "weighted_orders")
def dataset_statistics(spark, d):
    return eda.dataset_statistics(i.weighted_orders(spark, d), i.WEIGHTED_ORDERS)


@query(statistics_sql("orders_with_gaps", i.ORDER_FEATURES, "1"), "orders_with_gaps")
def dataset_statistics_with_gaps(spark, d):
    return eda.dataset_statistics(i.orders_with_gaps(spark, d), i.ORDERS)


def _conflicts(source: str, features: tuple[str, ...]) -> str:
    names = ", ".join(features)
    return f"""select {names}, count(distinct Result) number_of_labels, count(Result) number_of_rows
      from {source} group by {names} having count(distinct Result)>1"""


@query(_conflicts("order_profiles", i.ORDER_FEATURES), "order_profiles")
def conflicting_profiles(spark, d):
    return eda.conflicting_profiles(i.order_profiles(spark, d), i.ORDERS)


SAME = " and ".join(f"o.{c} is not distinct from p.{c}" for c in i.ORDER_FEATURES)


@query(f"select o.* from orders_with_gaps o where exists (select 1 from ({_conflicts('orders_with_gaps', i.ORDER_FEATURES)}) p where {SAME})",
       "orders_with_gaps")
def conflicting_rows(spark, d):
    return eda.conflicting_rows(i.orders_with_gaps(spark, d), i.ORDERS)


@query(f"""with c as ({_conflicts('order_profiles', i.ORDER_FEATURES)})
  select cast(1 as int) position, '{eda.CONFLICTING_PROFILES}' statistic, cast(count(*) as double) "value" from c
  union all select 2, '{eda.CONFLICTING_ROWS}', cast(sum(number_of_rows) as double) from c
  union all select 3, '{eda.CONFLICTING_SHARE}', round(100*cast(sum(number_of_rows) as double)/(select count(*) from order_profiles),2) from c""",
       "order_profiles")
def conflict_statistics(spark, d):
    return eda.conflict_statistics(i.order_profiles(spark, d), i.ORDERS)


def mi_sql(source: str, features: tuple[str, ...], by: str = "") -> str:
    """Textbook MI over joint and marginal counts."""
    key = f"{by}, " if by else ""
    return f"""select {key}feature, greatest(sum(cast(nxy as double)/n*ln(cast(nxy as double)*n/(cast(nx as double)*ny))), 0) mutual_information
      from (select *, sum(nxy) over (partition by {key}feature) n, sum(nxy) over (partition by {key}feature, value) nx,
              sum(nxy) over (partition by {key}feature, Result) ny
            from (select {key}feature, value, Result, count(*) nxy from ({long_sql(source, features, key + 'Result')}) group by all))
      group by {key}feature"""


def mi_rank_sql(source: str, features: tuple[str, ...]) -> str:
    return f"""select cast(row_number() over (order by round(mutual_information,12) desc, {_position(features)}) as int) mi_rank, feature,
      mutual_information from ({mi_sql(source, features)})"""


ORDERS_MI = mi_sql("order_profiles", i.ORDER_FEATURES)
DOCS_MI = mi_sql("document_quality", i.DOC_FEATURES)
DOCS_RANK = mi_rank_sql("document_quality", i.DOC_FEATURES)
ORDERS_RANK = mi_rank_sql("order_profiles", i.ORDER_FEATURES)


@query(f"select feature, {MI()} mutual_information from ({ORDERS_MI})", "order_profiles")
def mutual_information(spark, d):
    return rounded(eda.mutual_information(i.order_profiles(spark, d), i.ORDERS), "mutual_information", digits=DIGITS)


@query(f"select feature, {MI()} mutual_information from ({DOCS_MI})", "document_quality")
def mutual_information_documents(spark, d):
    return rounded(eda.mutual_information(i.document_quality(spark, d), i.DOCS), "mutual_information", digits=DIGITS)


@query(f"select mi_rank, feature, {MI()} mutual_information from ({DOCS_RANK})", "document_quality")
def mi_rank(spark, d):
    ranked = eda.mi_rank(eda.mutual_information(i.document_quality(spark, d), i.DOCS), i.DOCS)
    return rounded(ranked, "mutual_information", digits=DIGITS)


@query(f"select mi_rank, feature, {MI()} mutual_information from ({ORDERS_RANK}) where mi_rank<=4", "order_profiles")
def top_features(spark, d):
    ranked = eda.mi_rank(eda.mutual_information(i.order_profiles(spark, d), i.ORDERS), i.ORDERS)
    return rounded(eda.top_features(ranked, 4), "mutual_information", digits=DIGITS)


def distribution_sql(source: str, features: tuple[str, ...], weight: str) -> str:
    return f"""select feature, Result target, case Result when -1 then 'Phishing (-1)' when 1 then 'Legitimate (1)' else cast(Result as varchar) end class_name,
        value, mass, {sql_round('100*mass/sum(mass) over (partition by feature, Result)')} percentage
      from (select feature, Result, value, cast(sum(w) as double) mass
            from ({long_sql(source, features, f'Result, {weight} w')}) where value is not null and Result is not null group by all)"""


@query(distribution_sql("weighted_orders", i.ORDER_FEATURES, "sample_weight"), "weighted_orders")
def class_distribution(spark, d):
    return rounded(eda.class_distribution(i.weighted_orders(spark, d), i.WEIGHTED_ORDERS), "percentage")


@query(distribution_sql("orders_with_gaps", i.ORDER_FEATURES, "1"), "orders_with_gaps")
def class_distribution_with_gaps(spark, d):
    return rounded(eda.class_distribution(i.orders_with_gaps(spark, d), i.ORDERS), "percentage")


@query(f"""select d.*, mi_rank, cast(ceil(mi_rank/2.0) as int) page from ({distribution_sql('order_profiles', i.ORDER_FEATURES, '1')}) d
           join ({ORDERS_RANK}) m using (feature)""".replace("select d.*", "select d.*"), "order_profiles")
def distribution_pages(spark, d):
    rows = i.order_profiles(spark, d)
    ranked = eda.mi_rank(eda.mutual_information(rows, i.ORDERS), i.ORDERS)
    return rounded(eda.distribution_pages(eda.class_distribution(rows, i.ORDERS), ranked, 2), "percentage")


def spearman_sql(source: str, features: tuple[str, ...]) -> str:
    """Pearson correlation of average ranks, row by row."""
    ranks = ", ".join(f"rank() over (order by {f})+(count(*) over (partition by {f})-1)/cast(2 as double) {f}" for f in features)
    pairs = " union all ".join(
        f"select '{a}' feature_1, '{b}' feature_2, case when min({a})<max({a}) and min({b})<max({b}) then corr({a},{b}) end rho from ranks"
        for a in features for b in features
    )
    return f"with ranks as (select {ranks} from {source}) {pairs}"


DOCS_RHO = spearman_sql("document_quality", i.DOC_FEATURES)
ORDERS_RHO = spearman_sql("order_profiles", i.ORDER_FEATURES)


@query(f"select feature_1, feature_2, {MI('rho')} rho from ({ORDERS_RHO})", "order_profiles")
def spearman_matrix(spark, d):
    return rounded(eda.spearman_matrix(i.order_profiles(spark, d), i.ORDERS), "rho", digits=DIGITS)


@query(f"select feature_1, feature_2, {MI('rho')} rho from ({DOCS_RHO})", "document_quality")
def spearman_matrix_documents(spark, d):
    return rounded(eda.spearman_matrix(i.document_quality(spark, d), i.DOCS), "rho", digits=DIGITS)


AMOUNTS_RHO = spearman_sql("lineitem", i.AMOUNT_FEATURES)


@query(f"select feature_1, feature_2, {MI('rho')} rho from ({AMOUNTS_RHO})")
def spearman_matrix_amounts(spark, d):
    """Fractions of any size: prices, discounts and taxes of every line."""
    return rounded(eda.spearman_matrix(i.table(spark, d, "lineitem"), i.AMOUNTS), "rho", digits=DIGITS)


PAIRS = ", ".join(f"{MI(f)} {f}" for f in i.ORDER_FEATURES)


@query(f"select feature_1, {PAIRS} from (pivot ({ORDERS_RHO}) on feature_2 in ({', '.join(repr(f) for f in i.ORDER_FEATURES)}) using first(rho) group by feature_1)",
       "order_profiles")
def spearman_square(spark, d):
    square = eda.pivot_matrix(eda.spearman_matrix(i.order_profiles(spark, d), i.ORDERS), i.ORDER_FEATURES)
    return rounded(square, *i.ORDER_FEATURES, digits=DIGITS)


@query(f"""select feature_1, feature_2, {MI('rho')} spearman_correlation, {MI('abs(rho)')} absolute_correlation from ({ORDERS_RHO})
  where {_position(i.ORDER_FEATURES, 'feature_1')}<{_position(i.ORDER_FEATURES, 'feature_2')} and rho is not null
  order by round(abs(rho),12) desc, {_position(i.ORDER_FEATURES, 'feature_1')}, {_position(i.ORDER_FEATURES, 'feature_2')} limit 7""", "order_profiles")
def strongest_correlations(spark, d):
    matrix = eda.spearman_matrix(i.order_profiles(spark, d), i.ORDERS)
    return rounded(eda.strongest_correlations(matrix, i.ORDERS, 7), "spearman_correlation", "absolute_correlation", digits=DIGITS)


@query(f"""with rho_table as ({DOCS_RHO}), strongest as (
    select feature_1 f from rho_table where feature_1<>feature_2 and rho is not null group by feature_1
    order by round(max(abs(rho)),12) desc, {_position(i.DOC_FEATURES, 'feature_1')} limit 3)
  select feature_1, feature_2, {MI('rho')} rho from rho_table where feature_1 in (select f from strongest) and feature_2 in (select f from strongest)""",
       "document_quality")
def top_correlated_submatrix(spark, d):
    matrix = eda.spearman_matrix(i.document_quality(spark, d), i.DOCS)
    return rounded(eda.top_correlated_submatrix(matrix, i.DOCS, 3), "rho", digits=DIGITS)


# --- G: feature selection -------------------------------------------------------------------------------------------

FOLDED = "(select *, cast(row_id%5+1 as int) fold_no from document_quality)"
TRAINING = f"(select t.* exclude (fold_no), f.i outer_fold from {FOLDED} t join (select unnest(range(1,6)) i) f on f.i<>t.fold_no)"
FOLD_MI = mi_sql(TRAINING, i.DOC_FEATURES, "outer_fold")


def _folded_documents(spark, d):
    return i.document_quality(spark, d).withColumn("outer_fold", (F.col("row_id") % 5 + 1).cast("int"))


@query(f"select cast(outer_fold as int) outer_fold, feature, {MI()} mutual_information from ({FOLD_MI})", "document_quality")
def fold_mutual_information(spark, d):
    return rounded(selection.fold_mutual_information(_folded_documents(spark, d), i.DOCS, 5), "mutual_information", digits=DIGITS)


K_CHOICES = (1, 2, 3, "all")
K_SQL = "(values " + ", ".join(f"('{k}', {len(i.DOC_FEATURES) if k == 'all' else k})" for k in K_CHOICES) + ") c(k, take)"


def k_best_sql(information: str, features: tuple[str, ...], by: str = "") -> str:
    partition = f"partition by {by} " if by else ""
    return f"""select *, row_number() over ({partition}order by round(mutual_information,12) desc, {_position(features)} desc) place
      from ({information})"""


@query(f"""select cast(outer_fold as int) outer_fold, k, feature, {MI()} mutual_information, cast(place<=take as int) selected
           from ({k_best_sql(FOLD_MI, i.DOC_FEATURES, 'outer_fold')}) cross join {K_SQL}""", "document_quality")
def select_k_best_mi(spark, d):
    information = selection.fold_mutual_information(_folded_documents(spark, d), i.DOCS, 5)
    flagged = selection.select_k_best(information, i.DOCS, K_CHOICES, ["outer_fold"])
    return rounded(flagged.withColumn("selected", F.col("selected").cast("int")), "mutual_information", digits=DIGITS)


@query(f"""select feature, {MI()} mutual_information_score, cast(rank() over (order by round(mutual_information,12) desc) as int) mutual_information_rank,
           cast(place<=3 as int) selected from ({k_best_sql(DOCS_MI, i.DOC_FEATURES)})""", "document_quality")
def selected_feature_table(spark, d):
    information = eda.mutual_information(i.document_quality(spark, d), i.DOCS)
    selected = selection.selected_feature_table(information, i.DOCS, 3)
    return rounded(selected.withColumn("selected", F.col("selected").cast("int")), "mutual_information_score", digits=DIGITS)


@query(f"""select feature, {MI()} mutual_information_score, cast(rank() over (order by round(mutual_information,12) desc) as int) mutual_information_rank,
           cast(place<=2 as int) selected from ({k_best_sql(DOCS_MI, i.DOC_FEATURES)})
           order by round(mutual_information,12) desc, {_position(i.DOC_FEATURES)} limit 4""", "document_quality")
def feature_ranking_topn(spark, d):
    information = eda.mutual_information(i.document_quality(spark, d), i.DOCS)
    top = selection.feature_ranking_topn(selection.selected_feature_table(information, i.DOCS, 2), i.DOCS, 4)
    return rounded(top.withColumn("selected", F.col("selected").cast("int")), "mutual_information_score", digits=DIGITS)


@query("select row_id, Result, f_lines, f_disc from order_profiles", "order_profiles")
def selector_transform(spark, d):
    return selection.selector_transform(i.order_profiles(spark, d), i.ORDERS, ["f_disc", "f_lines"])


# --- P5 -------------------------------------------------------------------------------------------------------------

@query(f"""with stats as ({statistics_sql('order_profiles', i.ORDER_FEATURES, '1').replace('with base as', 'select * from (with base as', 1)})),
  conflicts as ({_conflicts('order_profiles', i.ORDER_FEATURES)}), rho_table as ({ORDERS_RHO})
  select 'dataset_statistics' section, statistic item, {sql_round('"value"', 8)} "value" from stats
  union all select 'conflict_statistics', '{eda.CONFLICTING_PROFILES}', count(*) from conflicts
  union all select 'conflict_statistics', '{eda.CONFLICTING_ROWS}', sum(number_of_rows) from conflicts
  union all select 'conflict_statistics', '{eda.CONFLICTING_SHARE}', round(100*cast(sum(number_of_rows) as double)/(select count(*) from order_profiles),2) from conflicts
  union all select 'conflicting_profiles', 'rows', count(*) from conflicts
  union all select 'mutual_information', feature, {sql_round('mutual_information', 8)} from ({ORDERS_RANK})
  union all select 'class_distribution', feature||'/'||target||'/'||value, percentage from ({distribution_sql('order_profiles', i.ORDER_FEATURES, '1')})
  union all select 'spearman_matrix', feature_1||'/'||feature_2, {sql_round('rho', 8)} from rho_table
  union all select 'top_correlated_submatrix', feature_1||'/'||feature_2, {sql_round('rho', 8)} from rho_table
  union all select 'strongest_correlations', feature_1||'/'||feature_2, {sql_round('rho', 8)} from rho_table
    join ({ORDERS_RANK}) a on a.feature=feature_1 join ({ORDERS_RANK}) b on b.feature=feature_2 where a.mi_rank<b.mi_rank""", "order_profiles")
def explore(spark, d):
    tables = explore_table(i.order_profiles(spark, d), i.ORDERS)
    pair = F.concat_ws("/", "feature_1", "feature_2")
    items = {
        "dataset_statistics": (F.col("statistic"), r("value", 8)),
        "conflict_statistics": (F.col("statistic"), r("value", 8)),
        "mutual_information": (F.col("feature"), r("mutual_information", 8)),
        "class_distribution": (F.concat_ws("/", "feature", "target", "value"), r("percentage")),
        "spearman_matrix": (pair, r("rho", 8)),
        "top_correlated_submatrix": (pair, r("rho", 8)),
        "strongest_correlations": (pair, r("spearman_correlation", 8)),
    }
    out = tables["conflicting_profiles"].agg(
        F.lit("conflicting_profiles").alias("section"), F.lit("rows").alias("item"), F.count(F.lit(1)).cast("double").alias("value")
    )
    for name, (item, value) in items.items():
        out = out.unionByName(tables[name].select(F.lit(name).alias("section"), item.alias("item"), value.alias("value")))
    return out
