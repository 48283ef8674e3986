"""Trees grown in Spark against trees grown in plain Python, from the same draws."""

from __future__ import annotations

import bisect
import collections
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from profilespark.operators import cross_validation, growth, models, search, splits
from profilespark.plans.select_model import SearchPlan, nested_cells
from profilespark.spec import FAMILIES, SEED, WEIGHT, TableSpec

SPEC = TableSpec(features=("a", "b", "c", "d"), key="row_id", weight=WEIGHT)
CDF = growth.poisson_table()


def rows_of(n=400, seed=1, weights=(1.0, 2.0, 3.0)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c, d = rng.randrange(4), rng.randrange(-1, 2), rng.randrange(9), rng.randrange(2)
        y = -1 if (a + c > 6) != (rng.random() < 0.2) else 1
        out.append((i, a, b, c, d, y, weights[i % len(weights)]))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows_of(), "row_id int, a int, b int, c int, d int, Result int, sample_weight double").cache()


def uniform(text, part=0):
    return int(hashlib.md5(text.encode()).hexdigest()[13 * part:13 * part + 13], 16) / 16**13


def draw(n, text):
    if n <= growth.EXACT_DRAWS:
        return bisect.bisect_right(CDF[n], uniform(text))
    z = math.sqrt(-2 * math.log(1 - uniform(text))) * math.cos(2 * math.pi * uniform(text, 1))
    return max(0, round(n + math.sqrt(n) * z + (z * z - 1) / 6))


def impurity(criterion, a, b):
    p = [x / (a + b) for x in (a, b)]
    return -sum(x * math.log2(x) for x in p if x > 0) if criterion == "entropy" else 1 - sum(x * x for x in p)


def brute_tree(cells, features, *, tree=1, criterion="gini", depth=60, min_split=2, min_leaf=1, tried=None, seed=SEED):
    """A function from a feature tuple to P(positive), and the number of split nodes; cells are (x, positive, weight, n)."""
    def build(cells, node, level):
        a, b = (sum(w * n for _, p, w, n in cells if p == want) for want in (True, False))
        n_rows = sum(n for *_, n in cells)
        value = a / (a + b)
        best = None
        if level < depth and n_rows >= min_split:
            differ = [f for f in features if len({x[f] for x, *_ in cells}) > 1]
            differ.sort(key=lambda f: hashlib.md5(f"{seed}/{tree}/{node}/{f}".encode()).hexdigest())
            for f in differ[:tried]:
                values = sorted({x[f] for x, *_ in cells})
                for lo, hi in zip(values, values[1:]):
                    left = [c for c in cells if c[0][f] <= lo]
                    right = [c for c in cells if c[0][f] > lo]
                    if min(sum(n for *_, n in left), sum(n for *_, n in right)) < min_leaf:
                        continue
                    sides = [[sum(w * n for _, p, w, n in side if p == want) for want in (True, False)] for side in (left, right)]
                    gain = impurity(criterion, a, b) - sum(sum(s) / (a + b) * impurity(criterion, *s) for s in sides)
                    key = (-round(gain, 12), f, lo)
                    if round(gain, 12) > 1e-12 and (best is None or key < best[0]):
                        best = (key, f, (lo + hi) / 2, left, right)
        if best is None:
            return lambda x: value, 0
        _, f, cut, left, right = best
        (below, m), (above, k) = build(left, 2 * node, level + 1), build(right, 2 * node + 1, level + 1)
        return lambda x: (above if x[f] > cut else below)(x), m + k + 1
    return build([c for c in cells if c[3] > 0], 1, 0)


def cells(rows):
    counted = collections.Counter((r[1:5], r[5], r[6]) for r in rows)
    return [(x, y == -1, w, n, f"{'|'.join(map(str, x))}|{y}|{w}") for (x, y, w), n in counted.items()]


def brute_forest(rows, features, trees, bootstrap, **how):
    grown = []
    for t in range(1, trees + 1):
        grown.append(brute_tree([(x, p, w, draw(n, f"{SEED}/{t}/{key}") if bootstrap else n) for x, p, w, n, key in cells(rows)], features, tree=t, **how)[0])
    return lambda x: sum(g(x) for g in grown) / trees


def parameters(**more):
    return {"feature_selection__k": "all", **{f"classifier__{k}": v for k, v in more.items()}}


@pytest.mark.parametrize("how", [
    {}, {"max_depth": 3}, {"criterion": "entropy", "max_depth": 4}, {"min_samples_split": 40}, {"min_samples_leaf": 15, "max_depth": 5}])
def test_a_tree_is_the_tree_grown_by_hand(spark, table, how):
    model = models.fit(FAMILIES[0], parameters(**how), table, SPEC)
    want, n_splits = brute_tree([c[:4] for c in cells(rows_of())], range(4), criterion=how.get("criterion", "gini"), depth=how.get("max_depth", 60),
                                min_split=how.get("min_samples_split", 2), min_leaf=how.get("min_samples_leaf", 1))
    got = {r.row_id: r.phishing_probability for r in model.score(table).collect()}
    assert got == pytest.approx({r[0]: want(r[1:5]) for r in rows_of()}, abs=1e-9)
    assert sum(not n.is_leaf for n in model.nodes) == n_splits


@pytest.mark.parametrize("bootstrap,max_features,tried", [(True, "sqrt", 2), (True, None, None), (False, 0.25, 1)])
def test_a_forest_is_the_forest_grown_by_hand(spark, table, bootstrap, max_features, tried):
    model = models.fit(FAMILIES[1], parameters(n_estimators=5, max_depth=4, bootstrap=bootstrap, max_features=max_features, min_samples_leaf=3), table, SPEC)
    want = brute_forest(rows_of(), range(4), 5, bootstrap, depth=4, tried=tried, min_leaf=3)
    got = {r.row_id: r.phishing_probability for r in model.score(table).collect()}
    assert got == pytest.approx({r[0]: want(r[1:5]) for r in rows_of()}, abs=1e-9)


@pytest.mark.parametrize("family", FAMILIES)
def test_scores_of_a_split_are_those_of_trees_grown_without_it(spark, table, family):
    how = [{"max_depth": 2}, {"max_depth": None, "min_samples_split": 30}] if family == FAMILIES[0] else [{"n_estimators": 3, "max_depth": 3, "max_features": None}]
    candidates = [{"candidate_id": i, **parameters(**h)} for i, h in enumerate(how, 1)]
    folded = table.withColumn("inner_fold", F.col("row_id") % 3 + 1)
    got = {(r.candidate_id, r.split): r.score for r in cross_validation.cv_scores(folded, SPEC, family, candidates, 3).collect()}
    for (c, split), score in got.items():
        train, held = ([r for r in rows_of() if (r[0] % 3 + 1 == split) == side] for side in (False, True))
        limits = {"depth": how[c - 1]["max_depth"] or 60, "min_split": how[c - 1].get("min_samples_split", 2)}
        want = brute_tree([x[:4] for x in cells(train)], range(4), **limits)[0] if family == FAMILIES[0] else brute_forest(train, range(4), 3, True, **limits)
        right = sum(r[6] for r in held if (-1 if round(want(r[1:5]), 12) >= 0.5 else 1) == r[5])
        assert score == pytest.approx(right / sum(r[6] for r in held), abs=1e-12)


def test_draws_follow_the_poisson_distribution(spark):
    for n in (1, 7, 300):
        found = spark.range(20_000).select(growth.poisson_draw(F.lit(n), F.concat(F.lit("s/"), F.col("id").cast("string"))).alias("k"))
        mean, variance = found.agg(F.avg("k"), F.var_pop("k")).first()
        assert mean == pytest.approx(n, rel=0.03) and variance == pytest.approx(n, rel=0.06)


def test_a_draw_takes_one_digest_and_not_one_per_element(spark):
    drawn = spark.createDataFrame([(3, "s/1")], "n bigint, text string").select(growth.poisson_draw(F.col("n"), F.col("text")))
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    inner = plan[plan.index("filter("):]
    assert "md5(" not in inner[:inner.index("false)")]


def test_profiles_of_a_small_file_of_cells_are_made_by_many_tasks(spark, table, monkeypatch):
    made, members = [], growth._members
    monkeypatch.setattr(growth, "MEMBERS_PER_TASK", 100)
    monkeypatch.setattr(growth, "_members", lambda *a: made.append(members(*a)) or made[-1])
    counted = growth.cells_of(table, SPEC, 1, F.lit(1))
    fits = [growth.fit_of(FAMILIES[1], {"n_estimators": 6}, [0, 1, 2, 3])]
    (spread,) = growth.grow(counted, fits)
    assert "repartition" in made[0]._jdf.queryExecution().logical().toString().lower()
    monkeypatch.setattr(growth, "MEMBERS_PER_TASK", 10**9)
    (single,) = growth.grow(counted, fits)
    nodes = lambda g: sorted(map(tuple, g.nodes.select("tree", "node", "level", "n", "place", "cut").collect()), key=str)
    assert "repartition" not in made[1]._jdf.queryExecution().logical().toString().lower()
    assert nodes(spread) == nodes(single)
    assert all(node.bit_length() - 1 == level for _, node, level, *_ in nodes(single))


def test_levels_follow_from_the_numbers_of_nodes(spark):
    numbers = [1, 2, 3, 4, 7, 8, 2**growth.MAX_DEPTH]
    found = spark.createDataFrame([(n,) for n in numbers], "node bigint").select("node", growth._level().alias("level")).collect()
    assert {r.node: r.level for r in found} == {n: n.bit_length() - 1 for n in numbers}


def test_a_forest_costs_as_much_as_there_are_profiles(spark, table):
    """Thousand copies of every row make the same number of cells, so every step sees the same number of rows."""
    many = table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(1000))))
    few, lots = (growth.cells_of(t, SPEC, 1, F.lit(1)) for t in (table, many))
    assert few.count() == lots.count()
    fitted = growth.fit_of(FAMILIES[1], {"n_estimators": 4, "max_depth": 3}, range(4))
    grown = [next(growth.grow(c, [fitted])) for c in (few, lots)]
    sizes = [g.arrived.count() for g in grown]
    assert sizes[0] <= sizes[1] <= 4 * few.select("x").distinct().count()


def test_inner_folds_are_those_of_copied_rows(spark, table):
    outer = splits.stratified_kfold(table.select("row_id", "Result"), "Result", "row_id", 4)
    arrays = splits.inner_folds(outer, "Result", "row_id", 4, 3).select("row_id", F.posexplode("inner_folds").alias("p", "f")).where("f is not null")
    copies = splits.inner_kfold(outer, "Result", "row_id", 4, 3)
    assert sorted((r.row_id, r.p + 1, r.f) for r in arrays.collect()) == sorted((r.row_id, r.outer_fold, r.inner_fold) for r in copies.collect())


def test_nested_cells_hold_every_row_once_per_outer_fold(spark, table):
    plan = SearchPlan(n_outer=4, n_inner=3)
    folded = splits.stratified_kfold(table, "Result", "row_id", 4)
    found = nested_cells(folded, SPEC, plan)
    totals = found.groupBy("group").agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n"), F.sum(F.get("counts", F.lit(0))).alias("out"))
    sizes = {r.outer_fold: r["count"] for r in folded.groupBy("outer_fold").count().collect()}
    assert {r.group: (r.n, r.out) for r in totals.collect()} == {g: (400, n) for g, n in sizes.items()}


def test_a_feature_of_many_values_is_cut_between_any_two(spark):
    """No bins and no sample: one row of 300,000 different values decides."""
    rows = spark.range(300_000).select(F.col("id").alias("row_id"), (F.col("id") * 0.5 + 0.25).alias("a"), F.lit(0).alias("b"), F.when(F.col("id") == 299_999, -1).otherwise(1).alias("Result"))
    spec = TableSpec(features=("a", "b"), key="row_id")
    model = models.fit(FAMILIES[0], parameters(max_depth=1), rows, spec)
    assert model.score(rows).where("y_pred <> Result").count() == 0
    assert [n.threshold for n in model.nodes if not n.is_leaf] == [299_998.5 * 0.5 + 0.25]


def test_missing_values_go_right_and_a_constant_table_is_one_leaf(spark, table):
    model = models.fit(FAMILIES[0], parameters(max_depth=2), table, SPEC)
    gap = table.limit(1).withColumns({f: F.lit(None).cast("int") for f in "abcd"})
    last = next(n for n in model.nodes if n.is_leaf and n.node == max(m.node for m in model.nodes if m.is_leaf))
    assert model.score(gap).first().phishing_probability == pytest.approx(last.value)
    flat = models.fit(FAMILIES[0], parameters(), table.withColumns({f: F.lit(1) for f in "abcd"}), SPEC)
    assert len(flat.nodes) == 1 and flat.score(table).count() == 400


def test_searches_tell_how_long_fits_and_scores_took(spark, table):
    candidates = [{"candidate_id": 1, **parameters(max_depth=2)}, {"candidate_id": 2, **parameters(max_depth=3)}]
    folded = table.withColumn("inner_fold", F.col("row_id") % 3 + 1)
    counted = growth.cells_of(folded, SPEC, 3, F.col("inner_fold"))
    scores = cross_validation.search_scores(counted, SPEC, {FAMILIES[0]: {0: candidates}}, 3)
    assert {(r.candidate_id, r.split) for r in scores.where("fit_time > 0 and score_time > 0").collect()} == {(c, s) for c in (1, 2) for s in (1, 2, 3)}
    results = search.cv_results(scores, [1, 2, 3])
    listed = results.withColumns({"selected_by_one_se": F.lit(True), **{n: F.lit(1) for n in ("p", "q")}})
    table = search.compact_search_results(listed, ["p", "q"])
    assert table.columns[-4:] == ["mean_fit_time", "std_fit_time", "mean_score_time", "std_score_time"]
    assert table.where("mean_fit_time > 0 and std_fit_time >= 0 and mean_score_time > 0 and std_score_time >= 0").count() == 2
