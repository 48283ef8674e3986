from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog import inputs as i
from profilespark.operators import cross_validation, diagnostics, eda, importance, metrics, models, search, selection, shapley
from profilespark.operators.splits import background_sample
from profilespark.operators.trees import Node, score_expression, score_nodes, thresholds, used_features
from profilespark.spec import FAMILIES, WEIGHT, TableSpec

SPEC = TableSpec(features=("a", "b"))


def frame(spark, rows, columns="a int, b int, Result int"):
    return spark.createDataFrame(rows, columns)


def scored(spark, rows):
    return spark.createDataFrame(rows, "model string, y_true int, y_pred int, phishing_probability double, sample_weight double")


def test_constant_feature(spark):
    data = frame(spark, [(1, 0, -1), (2, 0, 1), (3, 0, 1)])
    rho = {(r[0], r[1]): r[2] for r in eda.spearman_matrix(data, SPEC).collect()}
    assert rho == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}
    mi = {r[0]: r[1] for r in eda.mutual_information(data, SPEC).collect()}
    assert mi["b"] == 0.0 and mi["a"] > 0
    assert eda.strongest_correlations(eda.spearman_matrix(data, SPEC), SPEC).count() == 0


def test_spearman_agrees_with_the_library(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    rows = i.order_profiles(spark, sf_dir)
    packed = VectorAssembler(inputCols=list(i.ORDER_FEATURES), outputCol="v").transform(rows)
    expected = Correlation.corr(packed, "v", "spearman").first()[0].toArray()
    for r in eda.spearman_matrix(rows, i.ORDERS).collect():
        x, y = i.ORDER_FEATURES.index(r["feature_1"]), i.ORDER_FEATURES.index(r["feature_2"])
        assert r["rho"] == pytest.approx(expected[x][y], abs=1e-12)


def test_number_digits_follow_the_order_of_numbers(spark):
    """Digits never fall as numbers rise and leave few numbers together, whatever the type."""
    import random

    from profilespark.functions.ranking import number_digits

    rng = random.Random(3)
    doubles = [0.0, 5e-324, -5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf")]
    doubles += [s * 2.0**e * f for s in (1, -1) for e in range(-1000, 1000, 37) for f in (1.0, 1 - 2**-53, 1 + 2**-52, 1.5)]
    doubles += [rng.random() for _ in range(2000)] + [rng.gauss(0, 1e6) for _ in range(500)]
    longs = [0, 1, -1, 2**63 - 1, -(2**63), 2**48, 2**32 - 1, -(2**32)] + [rng.randrange(-(2**63), 2**63) for _ in range(500)]
    for name, values in (("double", sorted(set(doubles))), ("long", sorted(set(longs))), ("int", [-(2**31), -65537, -1, 0, 65535, 65536, 2**31 - 1])):
        table = spark.createDataFrame([(v,) for v in values], f"v {name}")
        digits = number_digits(F.col("v"), table.schema["v"].dataType)
        rows = [tuple(r) for r in table.orderBy("v").select(*[c for _, c in digits]).collect()]
        assert rows == sorted(rows) and all(c is not None for r in rows for c in r)
        if name == "double":
            assert len(set(rows)) > 0.8 * len(rows)


def test_rank_correlation_of_fractions(spark):
    data = spark.range(400).select((F.rand(1) * 1e-3).alias("a"), F.col("id").alias("i"), F.lit(1).alias("Result")).withColumn("b", -F.sqrt("a")).drop("i")
    rho = {(r[0], r[1]): r[2] for r in eda.spearman_matrix(data, SPEC).collect()}
    assert rho[("a", "b")] == pytest.approx(-1.0)
    with pytest.raises(Exception, match="without missing values"):
        eda.spearman_matrix(data.withColumn("a", F.when(F.col("b") > -0.01, float("nan")).otherwise(F.col("a"))), SPEC).collect()


def test_wide_ranks_are_exact(spark):
    """Values far apart fall into different blocks of the two-level rank."""
    data = spark.range(200).select((F.col("id") * 40_000 - 3_000_000).alias("a"), (-F.col("id")).alias("b"), F.lit(1).alias("Result"))
    rho = {(r[0], r[1]): r[2] for r in eda.spearman_matrix(data, SPEC).collect()}
    assert rho[("a", "b")] == pytest.approx(-1.0)


def _shuffled_by(table):
    return table._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_pairs_of_values_are_never_grouped(spark, monkeypatch):
    """Only profiles and ranks are shuffled, once for each feature with many values; ranks of others are broadcast."""
    spec = TableSpec(features=("a", "b", "c"))
    data = spark.range(300).select(F.col("id").alias("a"), (F.col("id") * 7 % 300 / 3).alias("b"), (F.col("id") % 2).alias("c"), F.lit(1).alias("Result"))
    looked_up = eda.spearman_matrix(data, spec)
    assert _shuffled_by(looked_up) == 0
    expected = data.select("a", "b", "c").toPandas().corr("spearman")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(eda, "BROADCAST_VALUES", 2)
        joined = eda.spearman_matrix(data, spec)
        assert _shuffled_by(joined) == 4
        for rows in (looked_up.collect(), joined.collect()):
            assert len(rows) == 9 and all(r["rho"] == pytest.approx(expected[r["feature_1"]][r["feature_2"]], abs=1e-12) for r in rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_rank_correlation_of_odd_tables(spark):
    """Rows that come twice, features of several types, both zeros, rows without a multiplicity, no rows, missing values."""
    spec = TableSpec(features=("a", "b", "c"))
    rows = [(1, -0.0, 1, 2), (1, 0.0, 1, 2), (2, 0.5, 3, 1), (3, 0.25, 3, 3), (3, 0.25, 3, 3), (-7, 1e300, 2, 1), (4, -1.5, 9, None)]
    data = spark.createDataFrame(rows, "a int, b double, c int, n long").withColumn("c", F.col("c").cast("decimal(10,2)")).withColumn("Result", F.lit(1))
    for given, by in ((data, spec), (data, spec.with_(multiplicity="n"))):
        plain = pd.DataFrame([r[:3] for r in rows for _ in range((r[3] or 0) if by.multiplicity else 1)], columns=["a", "b", "c"]).corr("spearman")
        found = eda.spearman_matrix(given, by).collect()
        assert len(found) == 9 and all(r["rho"] == pytest.approx(plain[r["feature_1"]][r["feature_2"]], abs=1e-12) for r in found)
    assert eda.spearman_matrix(data.limit(0), spec).collect() == []
    for gap in ("a", "b", "c"):
        with pytest.raises(Exception, match="without missing values"):
            eda.spearman_matrix(data.withColumn(gap, F.when(F.col("a") > 0, F.col(gap))), spec).collect()


def test_class_without_mass_has_no_imbalance_ratio(spark):
    value = {r["statistic"]: r["value"] for r in eda.dataset_statistics(frame(spark, [(1, 1, 1), (2, 2, 1)]), SPEC).collect()}
    assert value[eda.IMBALANCE] is None
    assert value[eda.POSITIVE_SHARE] == 0.0 and value[eda.NEGATIVE_SHARE] == 100.0


def test_cells_give_the_same_exploration(spark, sf_dir):
    rows = i.weighted_orders(spark, sf_dir)
    cells, spec = eda.profile_cells(rows, i.WEIGHTED_ORDERS)
    for op in (eda.dataset_statistics, eda.conflict_statistics, eda.conflicting_profiles, eda.class_distribution):
        assert sorted(op(cells, spec).collect()) == sorted(op(rows, i.WEIGHTED_ORDERS).collect())
    left = {r[0]: r[1] for r in eda.mutual_information(cells, spec).collect()}
    right = {r[0]: r[1] for r in eda.mutual_information(rows, i.WEIGHTED_ORDERS).collect()}
    assert left == pytest.approx(right, abs=1e-13)


def test_later_column_wins_a_tie_at_the_cut(spark):
    information = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.9)], "feature string, mutual_information double")
    spec = TableSpec(features=("a", "b", "c"))
    chosen = {r["feature"] for r in selection.select_k_best(information, spec, [2]).where("selected").collect()}
    assert chosen == {"b", "c"}
    ranks = {r["feature"]: r["mutual_information_rank"] for r in selection.selected_feature_table(information, spec, "all").collect()}
    assert ranks == {"c": 1, "a": 2, "b": 2}


def test_one_class_has_no_auc(spark):
    rows = scored(spark, [("m", 1, 1, 0.2, 1.0), ("m", 1, -1, 0.7, 2.0)])
    (row,) = metrics.classification_metrics(rows, ["model"]).collect()
    assert row["roc_auc"] is None
    assert row["phishing_precision"] == 0.0 and row["phishing_recall"] == 0.0
    assert row["accuracy"] == pytest.approx(1 / 3)
    assert row["macro_f1"] == pytest.approx((0.0 + 2 * 1 / (2 * 1 + 2)) / 2)


def test_macro_f1_counts_only_labels_that_occur(spark):
    rows = scored(spark, [("m", 1, 1, 0.2, 1.0), ("m", 1, 1, 0.3, 1.0)])
    assert metrics.macro_f1(rows, ["model"]).first()["macro_f1"] == 1.0


@pytest.mark.parametrize("drop", [True, False])
def test_auc_is_the_area_under_the_curve(spark, sf_dir, drop):
    rows = i.predictions(spark, sf_dir)
    auc = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(rows, ["model"]).collect()}
    points = {}
    for r in metrics.roc_curve(rows, ["model"], drop).collect():
        points.setdefault(r["model"], []).append((r["fpr"], r["tpr"]))
    for model, curve in points.items():
        curve.sort()
        area = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(curve, curve[1:]))
        assert area == pytest.approx(auc[model], abs=1e-12)
        assert curve[0] == (0.0, 0.0) and curve[-1] == pytest.approx((1.0, 1.0))


def test_scores_at_the_ends_of_the_interval(spark):
    rows = scored(spark, [("m", -1, -1, 1.0, 1.0), ("m", 1, 1, 0.0, 1.0), ("m", -1, -1, 1e-9, 2.0), ("m", 1, 1, 2e-9, 1.0)])
    # Pairs (positive above negative): 1.0 beats both; 1e-9 beats 0.0 only. Masses 1 and 2, negatives 2.
    assert metrics.roc_auc(rows, ["model"]).first()["roc_auc"] == pytest.approx((1 * 2 + 2 * 1) / (3 * 2))


def test_confusion_cells_add_up(spark, sf_dir):
    cells = metrics.confusion_matrix(i.predictions(spark, sf_dir), ["model"])
    total = i.predictions(spark, sf_dir).groupBy("model").agg(F.sum("sample_weight").alias("m"))
    for r in cells.groupBy("model").agg(F.sum("mass").alias("s"), F.sum("row_percentage").alias("p")).join(total, "model").collect():
        assert r["s"] == r["m"] and r["p"] == pytest.approx(200.0)


def pairs(spark, values):
    return spark.createDataFrame([(n, 0.5, 0.5 + v) for n, v in enumerate(values)], 'outer_fold int, `Decision Tree` double, `Random Forest` double')


def test_wilcoxon_exact(spark):
    (row,) = diagnostics.wilcoxon_paired(pairs(spark, [0.01 * k for k in range(1, 11)])).collect()
    assert (row["statistic"], row["p_value"], row["sample_size"]) == (0.0, 0.001953125, 10)
    (row,) = diagnostics.wilcoxon_paired(pairs(spark, [0.01, -0.02, 0.03, 0.04, -0.05])).collect()
    # W- = 2 + 5; 19 of the 32 sign patterns have a sum of at most 7.
    below = sum(1 for m in range(32) if sum(b + 1 for b in range(5) if m >> b & 1) <= 7)
    assert row["statistic"] == 7.0 and row["p_value"] == pytest.approx(min(1.0, 2 * below / 32))


def test_wilcoxon_without_differences(spark):
    (row,) = diagnostics.wilcoxon_paired(pairs(spark, [0.0] * 5)).collect()
    assert (row["statistic"], row["p_value"], row["mean_paired_difference_rf_minus_dt"]) == (0.0, 1.0, 0.0)


def test_wilcoxon_with_ties_and_zeros_uses_the_normal_approximation(spark):
    (row,) = diagnostics.wilcoxon_paired(pairs(spark, [0.0, 0.01, 0.01, -0.02, 0.03, 0.04, 0.05])).collect()
    n, statistic, tie = 6, 3.0, 2**3 - 2
    spread = math.sqrt((n * (n + 1) * (2 * n + 1) - tie / 2) / 24)
    z = (statistic - n * (n + 1) / 4) / spread
    assert row["statistic"] == statistic
    assert row["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)


def test_wilcoxon_needs_both_families(spark):
    assert diagnostics.wilcoxon_paired(pairs(spark, []).where("false")).count() == 0


def candidates(spark, rows):
    return spark.createDataFrame(rows, f"candidate_id bigint, mean_test_score double, std_test_score double, {search.K} string, {search.DEPTH} int")


def test_one_standard_error_rule(spark):
    def chosen(rows):
        picked = search.one_se_rule(candidates(spark, rows), 4).where("selected_by_one_se").collect()
        assert len(picked) == 1
        return picked[0]["candidate_id"]

    # Threshold 0.90 - 0.04/2 = 0.88; k is compared as a number, "all" last, no depth limit last.
    assert chosen([(1, 0.90, 0.04, "all", 3), (2, 0.89, 0.0, "10", 5), (3, 0.88, 0.0, "5", None), (4, 0.87, 0.0, "5", 1)]) == 3
    assert chosen([(1, 0.90, 0.04, "10", None), (2, 0.89, 0.0, "10", 12), (3, 0.885, 0.0, "10", 12)]) == 2
    # Equal in everything: the first; the first of equal best means sets the threshold.
    assert chosen([(1, 0.90, 0.0, "5", 3), (2, 0.90, 0.04, "5", 3), (3, 0.89, 0.0, "5", 1)]) == 1
    assert chosen([(1, 0.90, 0.04, "5", 3), (2, 0.90, 0.0, "5", 3), (3, 0.89, 0.0, "5", 1)]) == 3


def test_grids(spark):
    grid = search.grid_candidates(spark, search.DECISION_TREE_SPACE)
    first = [r.asDict() for r in grid.orderBy("candidate_id").limit(2).collect()]
    assert grid.count() == 864 and grid.drop("candidate_id").distinct().count() == 864
    assert [r[search.K] for r in first] == ["5", "10"] and first[0][search.DEPTH] is None
    drawn = search.random_candidates(spark, search.RANDOM_FOREST_SPACE)
    assert drawn.count() == 180 and drawn.select("grid_id").distinct().count() == 180
    assert drawn.agg(F.max("candidate_id")).first()[0] == 180


def test_heatmap_order(spark):
    rows = candidates(spark, [(1, 0.5, 0.0, "all", None), (2, 0.6, 0.0, "10", 3), (3, 0.7, 0.0, "5", 12), (4, 0.4, 0.0, "5", 12)])
    heatmap = search.hyperparameter_heatmap(rows, [None, 12, 3])
    assert heatmap.columns == ["k", "depth_3", "depth_12", "depth_None"]
    assert [(r["k"], r["depth_12"]) for r in heatmap.collect()] == [("5", 0.7), ("10", None), ("all", None)]


@pytest.mark.parametrize("portable", [True, False])
def test_importance_of_unused_features_is_zero_and_permutation_keeps_values(spark, sf_dir, portable):
    rows = i.weighted_orders(spark, sf_dir)
    points = thresholds(i.ORDER_TREES)
    permuted = importance.permuted_rows(rows, i.WEIGHTED_ORDERS, points, 2, portable=portable)
    assert permuted.count() == rows.count() * len(points) * 2
    # Within a fold the permuted column holds as many values per interval as the original.
    game = list(points).index("f_qty") * 2
    for fold in (1, 7):
        bins = lambda df, c: {r[0]: r[1] for r in df.where(F.col("outer_fold") == fold).groupBy(
            (F.col(c) > -0.5).cast("int") + (F.col(c) > 0.5).cast("int")).count().collect()}
        assert bins(permuted.where(F.col("_game") == game), "f_qty") == bins(rows, "f_qty")
    moved = permuted.where(F.col("_game") == game).withColumnRenamed("f_qty", "now").join(rows.select("row_id", "f_qty"), "row_id")
    assert moved.where("(now > 0.5) <> (f_qty > 0.5)").count() > 0
    predict = lambda df: score_nodes(df, i.ORDER_TREES)
    scores = importance.permutation_importance(rows, i.WEIGHTED_ORDERS, points, predict, "m", 2)
    zero = scores.where("feature = 'f_status'").collect()
    assert len(zero) == 10 and all(r["importance_mean"] == 0.0 and r["importance_std"] == 0.0 for r in zero)


def test_permuted_copies_are_scored_as_cells(spark, sf_dir):
    """A model scores what it can tell apart, not every copy."""
    rows, seen = i.weighted_orders(spark, sf_dir), []

    def predict(df):
        seen.append(df.count())
        return score_nodes(df, i.ORDER_TREES)

    importance.permutation_importance(rows, i.WEIGHTED_ORDERS, thresholds(i.ORDER_TREES), predict, "m", 5).collect()
    copies = rows.count() * len(thresholds(i.ORDER_TREES)) * 5
    # A fold of this table has few rows, so few of them agree; more rows give no more cells.
    assert seen[0] <= rows.count() and seen[1] < copies
    tripled = rows.unionByName(rows.withColumn("row_id", F.col("row_id") + 10_000_000)).unionByName(rows.withColumn("row_id", F.col("row_id") + 20_000_000))
    importance.permutation_importance(tripled, i.WEIGHTED_ORDERS, thresholds(i.ORDER_TREES), predict, "m", 5).collect()
    assert seen[2] == seen[0] and seen[3] < 2 * seen[1]


def test_shapley_values_add_up(spark, sf_dir):
    rows = i.order_profiles(spark, sf_dir)
    background = background_sample(rows, "row_id")
    explained = shapley.explained_rows(rows, background, i.ORDER_TREES, i.ORDERS)
    contributions = shapley.shapley_contributions(explained, i.ORDERS)
    summary = shapley.explanation_summary(explained, background, lambda df: score_nodes(df, i.ORDER_TREES), i.ORDERS)
    assert summary.count() == rows.count()
    assert summary.agg(F.max("absolute_additivity_error")).first()[0] < 1e-9
    assert contributions.where("feature = 'f_status' and shap_value <> 0").count() == 0


def test_shapley_of_a_deep_forest_of_tables(spark):
    """Deep drawn trees: exact sums, values by definition, and no table of conditions that is joined by feature or leaf alone."""
    rows = spark.range(300).select(F.col("id").alias("row_id"), *[(F.pmod(F.xxhash64("id", F.lit(n)), F.lit(5))).cast("int").alias(n) for n in "abcd"])
    rows = rows.withColumn("Result", F.when(F.col("a") * F.col("b") + F.col("c") > 6, -1).otherwise(1).cast("int"))
    spec = TableSpec(features=tuple("abcd"), key="row_id")
    parameters = {"feature_selection__k": "all", "classifier__n_estimators": 12, "classifier__max_depth": 10, "classifier__max_features": "sqrt"}
    model = models.fit(FAMILIES[1], parameters, rows, spec)
    background = background_sample(rows, "row_id", 20)
    explained = shapley.explained_rows(rows, background, model.conditions(), spec)
    summary = shapley.explanation_summary(explained, background, model.score, spec)
    assert summary.agg(F.max("absolute_additivity_error"), F.count("*")).first()[:] == pytest.approx((0, 300), abs=1e-9)
    boxes = model.conditions().where("feature is not null").groupBy("tree", "leaf").agg(F.count("*").alias("n"), F.max("bit").alias("most"))
    assert boxes.where("most <> n - 1").count() == 0
    # By definition, for one row: every coalition takes its features from the row, the rest from the background.
    base, one = background.toPandas(), rows.where("row_id = 17").toPandas().iloc[0]
    frames = []
    for s in range(16):
        mixed = base.copy()
        for k, f in enumerate("abcd"):
            if s >> k & 1:
                mixed[f] = one[f]
        frames.append(mixed.assign(s=s))
    mixed = spark.createDataFrame(pd.concat(frames))
    value = {r["s"]: r["v"] for r in model.score(mixed).groupBy("s").agg(F.avg("phishing_probability").alias("v")).collect()}
    got = {r["feature"]: r["shap_value"] for r in shapley.shapley_contributions(explained, spec).where("row_id = 17").collect()}
    for k, f in enumerate("abcd"):
        want = sum(math.factorial(n := s.bit_count()) * math.factorial(3 - n) / 24 * (value[s | 1 << k] - value[s]) for s in range(16) if not s >> k & 1)
        assert got[f] == pytest.approx(want, abs=1e-9)
    assert not hasattr(shapley, "BROADCAST_ROWS")


def test_shapley_of_a_stump(spark):
    stump = [Node(0, 0, "a", 0.5, 1, 2, 0.5), Node(0, 1, None, None, None, None, 0.2), Node(0, 2, None, None, None, None, 0.8)]
    spec = TableSpec(features=("a", "b"), key="row_id")
    rows = spark.createDataFrame([(1, 0, 0), (2, 1, 0)], "row_id int, a int, b int")
    background = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 0, 1), (4, 1, 1)], "row_id int, a int, b int")
    explained = shapley.explained_rows(rows, background, stump, spec)
    values = {(r["row_id"], r["feature"]): r["shap_value"] for r in shapley.shapley_contributions(explained, spec).collect()}
    base = 0.75 * 0.2 + 0.25 * 0.8
    assert values[(1, "a")] == pytest.approx(0.2 - base) and values[(2, "a")] == pytest.approx(0.8 - base)
    assert values[(1, "b")] == 0.0
    gaps = spark.createDataFrame([(1, 0, 0), (3, None, 0), (4, None, 1)], "row_id int, a int, b int")
    explained = shapley.explained_rows(gaps, background, stump, spec)
    assert sorted(r["row_id"] for r in explained.collect()) == [1, 3, 4]


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    weighted = i.document_quality(spark, sf_dir.replace("0.001", "0.01")).withColumn("sample_weight", (F.col("row_id") % 3 + 1).cast("double"))
    return weighted.cache()


DOCS = i.DOCS.with_(weight="sample_weight")


@pytest.mark.parametrize("family", FAMILIES)
def test_minimum_split_reads_small_nodes_as_leaves(documents, family):
    parameters = {"feature_selection__k": "all", "classifier__max_depth": 6, "classifier__n_estimators": 3, "classifier__min_samples_split": 60}
    model = models.fit(family, parameters, documents, DOCS)
    assert all(n.is_leaf or n.rows >= 60 for n in model.nodes)
    by_leaf = {r["row_id"]: r["phishing_probability"] for r in model.score(documents).collect()}
    by_nodes = {r["row_id"]: r["p"] for r in documents.withColumn("p", score_expression(model.nodes)).collect()}
    assert by_leaf == pytest.approx(by_nodes, abs=1e-12)


def test_models_beat_the_majority_and_repeat(documents):
    parameters = {"feature_selection__k": 3, "classifier__max_depth": 4, "classifier__n_estimators": 5}
    total = documents.agg(F.sum("sample_weight")).first()[0]
    most = documents.groupBy("Result").agg(F.sum("sample_weight").alias("m")).agg(F.max("m")).first()[0]
    for family in FAMILIES:
        tables = [models.predict(models.fit(family, parameters, documents, DOCS), documents, family) for _ in range(2)]
        assert sorted(tables[0].collect()) == sorted(tables[1].collect())
        assert metrics.accuracy(tables[0], ["model"]).first()["accuracy"] >= most / total


def test_unknown_family(documents):
    with pytest.raises(ValueError, match="No model family"):
        models.fit("Naive Bayes", {"feature_selection__k": 2}, documents, DOCS)
    with pytest.raises(ValueError, match="No model family"):
        models.build_classifier("Naive Bayes", {})


def test_used_features():
    assert used_features(i.ORDER_TREES) == ["f_disc", "f_lines", "f_prio", "f_qty", "f_returns"]


def test_unweighted_is_as_without_a_weight_column(spark, documents):
    """Neither fits nor scores read a weight that is not wanted."""
    spec = i.DOCS.with_(weight="sample_weight")
    rows = documents.withColumn("sample_weight", (F.col("row_id") % 5 + 1).cast("double")).withColumn("inner_fold", (F.col("row_id") % 2 + 1).cast("int"))
    for family, more in ((FAMILIES[0], {}), (FAMILIES[1], {"classifier__n_estimators": 3, "classifier__max_features": "sqrt", "classifier__bootstrap": True})):
        for smallest in (1, 4):
            candidate = {"candidate_id": 1, "feature_selection__k": 3, "classifier__criterion": "gini", "classifier__max_depth": 3,
                         "classifier__min_samples_split": 2, "classifier__min_samples_leaf": smallest, **more}
            scores = [
                sorted(tuple(r) for r in cross_validation.cv_scores(table, s, family, [candidate], 2, weighted=w).collect())
                for table, s, w in ((rows, spec, False), (rows.drop("sample_weight"), i.DOCS, True), (rows.drop("sample_weight"), i.DOCS, False))
            ]
            assert scores[0] == scores[1] == scores[2]


def test_a_feature_table_holds_a_key_once(spark):
    predictions = diagnostics.prediction_table(spark.createDataFrame(
        [("m", 1, 1.0, -1, 1, 0.3), ("m", 2, 1.0, 1, 1, 0.2)],
        "model string, row_id int, sample_weight double, y_true int, y_pred int, phishing_probability double"))
    spec = SPEC.with_(key="row_id")
    once = spark.createDataFrame([(1, 5, 5, 1), (2, 6, 6, 1)], "row_id int, a int, b int, Result int")
    assert diagnostics.error_by_feature_value(predictions, once, spec).agg(F.sum("unique_profiles")).first()[0] == 4
    with pytest.raises(Exception, match="more than once"):
        diagnostics.error_by_feature_value(predictions, once.unionByName(once.limit(1)), spec).collect()


def test_values_beyond_thirty_two_are_split_points(spark):
    """A tree finds the one value, of a hundred, at which the label changes."""
    rows = spark.range(400).select(F.col("id").alias("row_id"), (F.col("id") % 100).cast("int").alias("a"), F.lit(0).alias("b"))
    rows = rows.withColumn("Result", F.when(F.col("a") <= 36, 1).otherwise(-1).cast("int"))
    spec = SPEC.with_(key="row_id")
    parameters = {"feature_selection__k": "all", "classifier__criterion": "gini", "classifier__max_depth": 1, "classifier__min_samples_split": 2, "classifier__min_samples_leaf": 1}
    model = models.fit(FAMILIES[0], parameters, rows, spec)
    assert model.score(rows).where("y_pred <> Result").count() == 0


@pytest.mark.parametrize("family,smallest", [(FAMILIES[0], 1), (FAMILIES[0], 2), (FAMILIES[1], 1)])
def test_a_rare_decisive_value_is_a_split_point(spark, family, smallest):
    """On cells, on weighted rows with a leaf size and in a forest, all of more than 10,000 rows."""
    digits = [(F.floor(F.col("id") / 60**k) % 60).cast("int").alias(name) for k, name in enumerate("bcd")]
    rows = spark.range(200_000).select(F.col("id").alias("row_id"), (F.col("id") % 120_000 == 7).cast("int").alias("a"), *digits, F.lit(1.0).alias(WEIGHT))
    rows = rows.withColumn("Result", F.when(F.col("a") == 1, -1).otherwise(1).cast("int"))
    parameters = {
        "feature_selection__k": "all", "classifier__criterion": "gini", "classifier__max_depth": 1, "classifier__min_samples_split": 2, "classifier__min_samples_leaf": smallest,
        "classifier__n_estimators": 1, "classifier__max_features": None, "classifier__bootstrap": False,
    }
    model = models.fit(family, parameters, rows, SPEC.with_(features=tuple("abcd"), key="row_id", weight=WEIGHT))
    assert model.score(rows).where("y_pred <> Result").count() == 0


def test_a_submatrix_needs_a_correlation(spark):
    with pytest.raises(ValueError, match="no two features"):
        eda.top_correlated_submatrix(eda.spearman_matrix(frame(spark, [(1, 0, -1), (2, 0, 1)]), SPEC), SPEC)
