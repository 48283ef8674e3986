from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog.cleaning import write_arff
from catalog.inputs import order_profiles
from profilespark.operators import dedup, eda, quality, splits
from profilespark.functions.exprs import union_results
from profilespark.plans.explore import explore
from profilespark.plans.prepare import load_and_prepare, prepare, prepare_weighted
from profilespark.session import shared_dir
from profilespark.sources import arff, tables
from profilespark.spec import TableSpec

SPEC = TableSpec(features=("a", "b"))


def frame(spark, rows, columns="a int, b int, Result int"):
    return spark.createDataFrame(rows, columns)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_majority_vote_keeps_majority_support_and_drops_ties(spark):
    data = frame(spark, [(1, 1, -1)] * 3 + [(1, 1, 1)] + [(2, 2, 1)] * 2 + [(3, 3, -1), (3, 3, 1)])
    assert rows_of(dedup.weighted_majority_dedup(data, SPEC)) == [(1, 1, -1, 3), (2, 2, 1, 2)]
    report = dedup.weighted_dedup_report(data, SPEC).first().asDict()
    assert report["retained_mass"] + report["minority_mass"] + report["tied_mass"] == report["rows_before"] == 8
    assert (report["dropped_ties"], report["resolved_conflicts"], report["profiles_kept"]) == (1, 1, 2)


def test_majority_vote_with_three_labels(spark):
    class Three(TableSpec):
        labels = (-1, 0, 1)

    spec = Three(features=("a", "b"))
    data = frame(spark, [(1, 1, -1), (1, 1, 0), (1, 1, 1)] + [(2, 2, 0)] * 2 + [(2, 2, 1)] * 2 + [(2, 2, -1)] + [(3, 3, 0)] * 2 + [(3, 3, 1)])
    assert rows_of(dedup.weighted_majority_dedup(data, spec)) == [(3, 3, 0, 2)]


def test_all_profiles_tied_raises(spark):
    with pytest.raises(ValueError, match="clear majority"):
        prepare_weighted(frame(spark, [(1, 1, -1), (1, 1, 1)]), SPEC)


def test_missing_features_form_one_profile(spark):
    data = frame(spark, [(None, 1, -1), (None, 1, 1), (None, 1, 1), (2, 2, 1)])
    assert sorted(dedup.weighted_majority_dedup(data, SPEC).collect(), key=str)[-1]["sample_weight"] == 2
    assert eda.conflicting_rows(data, SPEC).count() == 3
    assert eda.conflicting_profiles(data, SPEC).first()["number_of_rows"] == 3


def test_row_key_of_a_hot_row_is_unique_and_spread(spark, monkeypatch):
    monkeypatch.setattr(dedup, "CHUNK", 7)
    data = frame(spark, [(1, 1, 1)] * 100 + [(i, 0, -1) for i in range(200)])
    keyed = dedup.row_key(data)
    assert keyed.count() == 300
    assert keyed.select("row_id").distinct().count() == 300
    assert rows_of(keyed.drop("row_id")) == rows_of(data)


def test_report_of_exact_dedup(spark):
    data = frame(spark, [(1, 1, 1)] * 3 + [(1, 1, -1), (2, 1, 1)])
    assert tuple(dedup.exact_dedup_report(data).first()) == (5, 3, 2)


@pytest.mark.parametrize("n,k", [(23, 5), (100, 10), (7, 4)])
def test_folds_partition_rows_evenly(spark, n, k):
    data = spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(1).alias("Result"))
    folded = splits.stratified_kfold(data, "Result", "row_id", k)
    assert folded.count() == n
    sizes = [r["count"] for r in folded.groupBy("outer_fold").count().collect()]
    assert len(sizes) == k and max(sizes) - min(sizes) <= 1
    per_class = {}
    for r in folded.groupBy("outer_fold", "Result").count().collect():
        per_class.setdefault(r["Result"], []).append(r["count"])
    for counts in per_class.values():
        counts += [0] * (k - len(counts))
        assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("n,test_size", [(10, 0.2), (11, 0.3), (97, 0.25)])
def test_holdout_sizes(spark, n, test_size):
    import math

    data = spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 == 0, -1).otherwise(1).alias("Result"))
    split = splits.stratified_holdout(data, "Result", "row_id", test_size)
    tested = split.where("split = 'test'")
    assert tested.count() == math.ceil(test_size * n)
    whole = data.where("Result = -1").count()
    assert abs(tested.where("Result = -1").count() - whole * math.ceil(test_size * n) / n) <= 1


def test_split_does_not_depend_on_buckets_or_partitions(spark, monkeypatch):
    data = spark.range(500).select(F.col("id").alias("row_id"), (F.col("id") % 2 * 2 - 1).cast("int").alias("Result"))
    first = rows_of(splits.stratified_kfold(data, "Result", "row_id", 7))
    plain = splits.with_order_key
    monkeypatch.setattr(splits, "with_order_key", lambda df, seed, row_id: plain(df, seed, row_id, 1))
    assert rows_of(splits.stratified_kfold(data.repartition(13), "Result", "row_id", 7)) == first


@pytest.mark.parametrize("portable", [True, False])
def test_cut_keys_sort_only_parts_of_buckets(spark, monkeypatch, portable):
    """Any widths of buckets and parts give the keys at the wanted ranks; no window holds a bucket."""
    from profilespark.functions import ranking

    monkeypatch.setattr(ranking, "FINE_DIGITS", 1)
    data = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("g"))
    keyed = ranking.with_order_key(data, 5, "row_id", 1, portable)
    keys = {g: sorted(r["_key"] for r in keyed.where(F.col("g") == g).collect()) for g in range(3)}
    ranks = {1: 1, 2: 400, 3: 401, 4: 1000}
    wanted = spark.createDataFrame([(g, c, n) for g in range(3) for c, n in ranks.items()], "g long, _cut int, _rank long")
    cuts = ranking.cut_keys(keyed, ranking.bucket_counts(keyed, ["g"]), ["g"], wanted, 1)
    assert {(r["g"], r["_cut"]): r["_cut_key"] for r in cuts.collect()} == {(g, c): keys[g][n - 1] for g in range(3) for c, n in ranks.items()}


@pytest.mark.parametrize("portable", [True, False])
@pytest.mark.parametrize("same", [1, 400])
def test_segment_sums_of_one_pass(spark, monkeypatch, portable, same):
    """The sums of placed rows, with and without keys that repeat too much for the windows; few rows wait for their cut."""
    from profilespark.functions import ranking

    data = spark.range(8000).select((F.col("id").cast("long") - F.col("id") % same).alias("row_id"), (F.col("id") % 2).alias("g"), (F.col("id") % 5).alias("c"))
    keyed = ranking.with_order_key(data, 5, "row_id", 1, portable)
    ranks = {1: 0, 2: 1, 3: 1700, 4: 1701, 5: 4000}
    wanted = spark.createDataFrame([(g, c, n, 4000) for g in range(2) for c, n in ranks.items()], "g long, _cut int, _rank long, _size long")
    cuts = ranking.cut_keys(keyed, ranking.bucket_counts(keyed, ["g"]), ["g"], wanted.where("_rank > 0"), 1)
    placed = ranking.assign_segments(keyed, ["g"], cuts, 5, "s").groupBy("g", "c", "s").agg(F.sum("row_id").alias("t"))
    general, written = ranking.cut_keys, {}
    monkeypatch.setattr(ranking, "cut_keys", lambda *a: written.update(general=True) or general(*a))
    plain = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, name, *a: written.setdefault(name, plain(df, name, *a)))
    sums = ranking.segment_sums(keyed, ["g"], wanted, 5, ["c"], {"t": F.col("row_id")}, "s", 1)
    assert rows_of(sums) == rows_of(placed)
    assert ("general" in written) == (same > 1)
    if same == 1:
        assert written["segments"].where("_open is not null").count() < 8000 / 4


def test_running_totals_bound_the_cells_of_a_task(spark, monkeypatch):
    from profilespark.functions import ranking

    monkeypatch.setattr(ranking, "CELLS_PER_TASK", 100)
    cells = spark.range(2000).select(F.lit("f").alias("g"), F.col("id").alias("v"), F.lit(1).alias("n"))
    totals = ranking.running_totals(cells, ["g"], [("_d1", F.shiftright("v", 4))], "v", ["n"])
    assert totals.where("cum_n = v + 1").count() == 2000
    assert max(r["count"] for r in totals.groupBy(F.spark_partition_id()).count().collect()) < 600


def test_inner_folds_leave_the_outer_fold_out(spark):
    data = spark.range(60).select(F.col("id").alias("row_id"), (F.col("id") % 2 * 2 - 1).cast("int").alias("Result"))
    outer = splits.stratified_kfold(data, "Result", "row_id", 3)
    own = {r["row_id"]: r["outer_fold"] for r in outer.collect()}
    inner = splits.inner_kfold(outer, "Result", "row_id", 3, 4).collect()
    assert len(inner) == 120
    assert all(own[r["row_id"]] != r["outer_fold"] for r in inner)


def test_bad_test_size(spark):
    with pytest.raises(ValueError):
        splits.stratified_holdout(spark.range(3).withColumn("Result", F.lit(1)), "Result", "id", 1.0)


def test_background_is_the_whole_table_when_small(spark):
    assert splits.background_sample(spark.range(20).withColumnRenamed("id", "row_id"), "row_id", 500).count() == 20


def test_prepare_writes_a_table(spark, tmp_path):
    data = frame(spark, [(i % 5, i % 3, 1 if i % 2 else -1) for i in range(40)])
    written = prepare(data, SPEC, "raw", str(tmp_path / "raw"))
    assert written.count() == 40
    assert written.where("split = 'test'").count() == 8


def test_eda_accepts_one_class_and_modelling_does_not(spark):
    data = frame(spark, [(1, 1, 1), (2, 1, 1)])
    quality.enforce(quality.quality_report(data, SPEC))
    with pytest.raises(ValueError, match="absent_labels"):
        quality.enforce(quality.quality_report(data, SPEC, quality.MODELLING))


def test_checks_raise(spark):
    with pytest.raises(ValueError, match="table_empty"):
        quality.enforce(quality.quality_report(frame(spark, []), SPEC))
    with pytest.raises(ValueError, match="unexpected_labels"):
        quality.enforce(quality.quality_report(frame(spark, [(1, 1, 5)]), SPEC))
    with pytest.raises(ValueError, match="missing_values: 1"):
        quality.enforce(quality.quality_report(frame(spark, [(None, 1, 1)]), SPEC))
    with pytest.raises(ValueError, match="target"):
        quality.check_schema(frame(spark, [(1, 1, 1)]).drop("Result"), SPEC)
    with pytest.raises(TypeError, match="numeric"):
        quality.check_schema(frame(spark, [("x", 1, 1)], "a string, b int, Result int"), SPEC)
    with pytest.raises(ValueError, match="predict from"):
        quality.check_schema(frame(spark, [(1, 1, 1)]), TableSpec(features=()))
    with pytest.raises(ValueError, match="lacks the columns"):
        quality.require_columns(frame(spark, [(1, 1, 1)]), ["z"], "table")
    with pytest.raises(ValueError, match="lacks the features \\['b'\\]"):
        quality.align_features(frame(spark, [(1, 1, 1)]).drop("b"), SPEC)
    assert quality.duplicate_columns(["a", "b", "a"]) == ["a"]


def test_arff(spark, tmp_path):
    text = """% comment
@RELATION 'web sites'

@attribute 'having IP' {-1,1}
@attribute length REAL
@attribute Index numeric
@attribute class {-1,1}
@data
-1, 3, 7, 1
% another
1,0,8,-1

"""
    (tmp_path / "x.arff").write_text(text)
    table = arff.load_source(spark, str(tmp_path / "x.arff"))
    assert table.columns == ["having IP", "length", "Result"]
    assert rows_of(table) == [(-1, 3, 1), (1, 0, -1)]


def test_arff_without_target_or_with_a_bad_cell(spark, tmp_path):
    (tmp_path / "a.arff").write_text("@attribute x numeric\n@data\n1\n")
    with pytest.raises(ValueError, match="target"):
        arff.load_source(spark, str(tmp_path / "a.arff"))
    (tmp_path / "b.arff").write_text("@attribute x {1,two}\n@attribute class {-1,1}\n@data\ntwo,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        arff.load_source(spark, str(tmp_path / "b.arff")).collect()


def test_arff_of_several_files(spark, tmp_path):
    import gzip

    header = "@relation r\n" + "% long header\n" * 9000 + "@attribute name {'@home',b}\n@attribute x numeric\n@DATA\n"
    (tmp_path / "a.arff").write_text(header + "@home,1\n")
    (tmp_path / "b.arff.gz").write_bytes(gzip.compress((header + "b,2\n@home,?\n").encode()))
    table = arff.arff_scan(spark, str(tmp_path))
    assert table.columns == ["name", "x"]
    assert rows_of(table.fillna(-1.0)) == [("@home", -1.0), ("@home", 1.0), ("b", 2.0)]
    # The same columns in another order.
    (tmp_path / "c.arff").write_text("@relation r\n@attribute x numeric\n@attribute name {'@home',b}\n@data\n1,b\n")
    with pytest.raises(ValueError, match="differ"):
        arff.arff_scan(spark, str(tmp_path))


def test_arff_without_a_header(spark, tmp_path):
    (tmp_path / "x.arff").write_text("1,2\n")
    with pytest.raises(ValueError, match="No attributes"):
        arff.arff_scan(spark, str(tmp_path / "x.arff"))


def test_arff_parts_without_a_header_go_on_with_the_rows(spark, tmp_path):
    (tmp_path / "a.arff").write_text("1,b\r\n2,'@data'\r\n" + "3,c\n" * 50_000 + "@attribute z numeric\n@data\n")
    (tmp_path / "b.arff").write_text("% head\n@attribute x numeric\n@attribute name {b,c,'@data'}\n@data\n% rows\n")
    (tmp_path / "c.arff").write_text("")
    table = arff.arff_scan(spark, str(tmp_path))
    assert table.columns == ["x", "name"] and table.count() == 50_002
    assert rows_of(table.where("x < 3")) == [(1.0, "b"), (2.0, "@data")]
    # A file is read no further than its first row.
    assert arff.header_attributes(spark, str(tmp_path / "a.arff")) == []


@pytest.mark.parametrize("treatment", ["raw", "exact"])
def test_experiments_prepare_every_row_of_their_parts(spark, sf_dir, tmp_path, treatment):
    profiles = order_profiles(spark, sf_dir).drop("row_id")
    source = arff.load_source(spark, write_arff(spark, sf_dir))
    prepared = prepare(source, TableSpec.infer(source), treatment, str(tmp_path / "prepared"))
    want = profiles if treatment == "raw" else profiles.distinct()
    names = sorted(profiles.columns)
    assert rows_of(prepared.select(*names)) == rows_of(want.select(*names))


def test_target_names_are_matched_exactly_and_in_order(spark):
    both = spark.createDataFrame([(1, 2)], "class int, RESULT int")
    assert arff.resolve_target(both).columns == ["Result", "RESULT"]


def test_parameter_files(spark, tmp_path):
    (tmp_path / "candidates.csv").write_text(
        'model,development_cv_score,development_cv_metric,max_development_cv_score,parameters\n'
        'Decision Tree,0.95,accuracy,0.96,"{""classifier__max_depth"": null, ""feature_selection__k"": 5}"\n'
        'Random Forest,0.97,accuracy,0.97,"{""classifier__max_features"": 0.5, ""classifier__bootstrap"": true, ""feature_selection__k"": ""all""}"\n'
    )
    read = dict((m, p) for m, _, p in tables.configurations(tables.read_candidate_configs(spark, str(tmp_path / "candidates.csv"))))
    assert read["Decision Tree"] == {"classifier__max_depth": None, "feature_selection__k": 5}
    assert read["Random Forest"] == {"classifier__max_features": 0.5, "classifier__bootstrap": True, "feature_selection__k": "all"}
    (tmp_path / "final.csv").write_text(
        "model,development_cv_score,classifier__max_depth,classifier__criterion,feature_selection__k\nDecision Tree,0.95,,gini,10\n"
    )
    ((name, score, parameters),) = tables.configurations(tables.read_final_config(spark, str(tmp_path / "final.csv")))
    assert (name, score) == ("Decision Tree", 0.95)
    assert parameters == {"classifier__max_depth": None, "classifier__criterion": "gini", "feature_selection__k": 10}


def test_empty_parameters_and_several_final_rows_raise(spark, tmp_path):
    (tmp_path / "c.csv").write_text("model,development_cv_score,parameters\nDecision Tree,0.9,{}\n")
    with pytest.raises(Exception, match="Parameters are empty"):
        tables.read_candidate_configs(spark, str(tmp_path / "c.csv")).collect()
    (tmp_path / "f.csv").write_text("model,development_cv_score,classifier__x\nA,1,2\nB,1,2\n")
    with pytest.raises(ValueError, match="exactly one row"):
        tables.read_final_config(spark, str(tmp_path / "f.csv"))


def test_missing_file_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.csv_scan(spark, "/tmp/there-is-no-such-file.csv")


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark).removeprefix("file:") == f"{spark.conf.get('spark.checkpoint.dir')}/{spark.sparkContext.applicationId}"


def test_undeclared_labels_vote(spark):
    data = frame(spark, [(0, 0, 0), (0, 0, 0), (0, 0, 1), (1, 1, 0), (2, 2, 0), (2, 2, -1), (None, 1, 7)])
    assert sorted(map(tuple, dedup.weighted_majority_dedup(data, SPEC).collect()), key=repr) == [(0, 0, 0, 2), (1, 1, 0, 1), (None, 1, 7, 1)]
    report = dedup.weighted_dedup_report(data, SPEC).first()
    assert (report["dropped_ties"], report["tied_mass"], report["minority_mass"], report["retained_mass"]) == (1, 2, 1, 4)
    assert {tuple(r) for r in eda.conflicting_profiles(data, SPEC).collect()} == {(0, 0, 2, 3), (2, 2, 2, 2)}


def test_rows_of_other_texts_have_other_keys(spark):
    rows = [("x|y", "z"), ("x", "y|z"), (None, "q"), ("null", "q"), ('a","b', "c"), ("a", 'b","c')]
    assert dedup.row_key(spark.createDataFrame(rows, "a string, b string")).select("row_id").distinct().count() == len(rows)


def test_gaps_are_refused_where_they_have_no_rank(spark):
    with pytest.raises(Exception, match="without missing values"):
        eda.spearman_matrix(frame(spark, [(1, 1, 1), (None, 2, 1)]), SPEC).collect()


def test_modelling_rules_name_the_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,Result\n1,,1\n2,,-1\n,3,1\n")
    with pytest.raises(ValueError, match=r"a \(1\), b \(2\)"):
        load_and_prepare(spark, str(tmp_path / "t.csv"), quality.MODELLING)


def test_no_tables_make_an_empty_table(spark):
    assert union_results([]).count() == 0


def test_explore_names_gaps_and_foreign_labels_from_its_own_scan(spark):
    rows = spark.createDataFrame([(1, 0, -1), (None, 0, 1), (1, 1, 7), (None, 1, 1)], "a int, b int, Result int")
    spec = TableSpec(features=("a", "b"))
    with pytest.raises(ValueError, match=r"missing values in a \(2\); 1 labels in Result"):
        explore(rows, spec)
    with pytest.raises(ValueError, match="no rows"):
        explore(rows.where("false"), spec)
    with pytest.raises(ValueError, match="more than once"):
        explore(rows.select("a", "a", "Result"), TableSpec(features=("a",)))


def test_information_refuses_a_third_label(spark):
    rows = spark.createDataFrame([(1, -1), (2, 1), (2, 3)], "a int, Result int")
    with pytest.raises(Exception, match="beyond the two"):
        eda.mutual_information(rows, TableSpec(features=("a",))).collect()
