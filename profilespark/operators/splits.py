"""Reproducible splits and folds with exact sizes per class.

Rows are ordered within their class by a seeded hash and cut at exact ranks, so
the sizes follow the usual stratified allocation rules while the rows themselves
are never shuffled or sorted: only the handful of cut keys is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from profilespark.functions.ranking import assign_segments, bucket_counts, cut_keys, hash_key, segment_sums, with_order_key
from profilespark.session import materialize
from profilespark.spec import SEED

BACKGROUND_SIZE = 500
# Copies of rows, one per trial, worth a task of their own.
COPIES_PER_TASK = 4_000_000


def _big(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def _class_sizes(buckets: DataFrame, group: list[str], label: str) -> DataFrame:
    """Rows per class with the class's offset when classes are laid end to end."""
    inside = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    sizes = buckets.groupBy(*group, label).agg(F.sum("_n").alias("_size"))
    before = F.sum("_size").over(inside.orderBy(label).rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumns({"_offset": F.coalesce(before, F.lit(0)), "_total": F.sum("_size").over(inside)})


def stratified_holdout(df: DataFrame, label: str, row_id: str, test_size: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``split`` (train/test): ceil(test_size * n) test rows, classes by largest remainder."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must be between 0 and 1.")
    keyed = with_order_key(df, seed, row_id)
    buckets = bucket_counts(keyed, [label])
    sizes = _class_sizes(buckets, [], label).withColumn(
        "_train", F.col("_total") - F.ceil(F.lit(float(test_size)) * F.col("_total").cast("double"))
    )
    # In decimals: the product of two row counts can exceed 64 bits.
    exact = sizes.withColumns({"_product": _big(F.col("_size")) * _big(F.col("_train")), "_whole": _big(F.col("_total"))})
    share = exact.withColumns({"_floor": F.expr("_product div _whole"), "_left": F.col("_product") % F.col("_whole")})
    # One row per class from here on.
    everywhere = Window.partitionBy(F.lit(0))
    by_remainder = everywhere.orderBy(F.col("_left").desc(), F.col(label))
    missing = F.col("_train") - F.sum("_floor").over(everywhere)
    extra = (F.row_number().over(by_remainder) <= missing).cast("bigint")
    wanted = share.select(label, F.lit(1).alias("_cut"), (F.col("_floor") + extra).alias("_rank"))
    cuts = cut_keys(keyed, buckets, [label], wanted)
    split = assign_segments(keyed, [label], cuts, 1, "_segment")
    return split.withColumn("split", F.when(F.col("_segment") == 1, "train").otherwise("test")).drop("_segment")


def _fold_cuts(buckets: DataFrame, group: list[str], label: str, k: int) -> DataFrame:
    """Ranks at which each class is cut into k folds.

    Class positions are dealt to the folds in turn, one class after the other, so
    both fold sizes and per-class sizes differ by at most one.
    """
    sizes = _class_sizes(buckets, group, label)
    cut = sizes.withColumn("_cut", F.explode(F.array(*[F.lit(i) for i in range(1, k)])))

    def dealt(n: Column) -> Column:
        # How many of the first n positions went to the first `_cut` folds.
        return F.call_function("div", n, F.lit(k)) * F.col("_cut") + F.least(n % F.lit(k), F.col("_cut"))

    rank = dealt(F.col("_offset") + F.col("_size")) - dealt(F.col("_offset"))
    return cut.select(*group, label, "_cut", rank.cast("bigint").alias("_rank"))


def stratified_kfold(df: DataFrame, label: str, row_id: str, k: int = 10, seed: Column | int = SEED,
                     out: str = "outer_fold", within: tuple[str, ...] = ()) -> DataFrame:
    """Add the fold number (1..k) of every row, stratified by label inside ``within``."""
    group = list(within)
    keyed = with_order_key(df, seed, row_id)
    buckets = bucket_counts(keyed, [*group, label])
    cuts = cut_keys(keyed, buckets, [*group, label], _fold_cuts(buckets, group, label, k))
    return assign_segments(keyed, [*group, label], cuts, k - 1, out)


def training_rows(folded: DataFrame, n_folds: int, fold: str = "outer_fold") -> DataFrame:
    """Every row once per outer fold it trains for; ``fold`` becomes the held-out fold."""
    others = F.array_except(F.sequence(F.lit(1), F.lit(n_folds)), F.array(F.col(fold)))
    return folded.withColumn(fold, F.explode(others))


def inner_kfold(folded: DataFrame, label: str, row_id: str, n_outer: int = 10, k: int = 5, seed: int = SEED) -> DataFrame:
    """Inner folds of each outer training set, reseeded per outer fold."""
    train = training_rows(folded, n_outer)
    return stratified_kfold(train, label, row_id, k, F.lit(seed) + F.col("outer_fold"), "inner_fold", ("outer_fold",))


def inner_folds(folded: DataFrame, label: str, row_id: str, n_outer: int = 10, k: int = 5, seed: int = SEED) -> DataFrame:
    """The folds of ``inner_kfold`` as one array column: place p holds the row's fold in the training set of outer
    fold p (from 1), null where it is held out there.

    Only (key, label, fold) is copied, to find the cut keys; rows are compared with them in place.
    """
    group = ["outer_fold", label]
    copies = training_rows(folded.select(row_id, *group), n_outer)
    keyed = with_order_key(copies, F.lit(seed) + F.col("outer_fold"), row_id)
    buckets = bucket_counts(keyed, group)
    cuts = cut_keys(keyed, buckets, group, _fold_cuts(buckets, ["outer_fold"], label, k))
    # One row per class: the cut keys of every training set.
    keys = cuts.groupBy(*group).agg(F.collect_list("_cut_key").alias("_keys"))
    keys = keys.groupBy(label).agg(F.map_from_entries(F.collect_list(F.struct("outer_fold", "_keys"))).alias("_cuts"))

    def fold(p: Column) -> Column:
        at = F.coalesce(F.try_element_at("_cuts", p), F.array().cast("array<string>"))
        key = hash_key(F.lit(seed) + p, F.col(row_id))
        # A cut without a key has rank 0: every row lies beyond it.
        return F.lit(k) - F.size(F.filter(at, lambda c: key <= c))

    each = F.transform(F.sequence(F.lit(1), F.lit(n_outer)), lambda p: F.when(p != F.col("outer_fold"), fold(p)))
    return folded.join(F.broadcast(keys), label, "left").withColumn("inner_folds", each).drop("_cuts")


def kfold(df: DataFrame, row_id: str, k: int = 4, seed: int = 0, out: str = "fold") -> DataFrame:
    """Shuffled folds without strata."""
    return stratified_kfold(df.withColumn("_stratum", F.lit(0)), "_stratum", row_id, k, seed, out).drop("_stratum")


def repeated_kfold(df: DataFrame, row_id: str, seeds: Sequence[int], k: int = 4, out: str = "fold") -> DataFrame:
    """Shuffled folds for several trials in one job; ``trial`` is the seed."""
    trials = F.explode(F.array(*[F.lit(s) for s in seeds]))
    copies = df.withColumn("trial", trials).withColumn("_stratum", F.lit(0))
    return stratified_kfold(copies, "_stratum", row_id, k, F.col("trial"), out, ("trial",)).drop("_stratum")


def repeated_kfold_sums(df: DataFrame, row_id: str, seeds: Sequence[int], by: Sequence[str], sums: dict[str, Column], k: int = 4,
                        out: str = "fold") -> DataFrame:
    """Sums per trial, fold and ``by`` over the folds of ``repeated_kfold``, in one pass over the copies.

    Rows that look alike share a task, so that it has few sums to pass on.
    """
    by = list(by)
    rows = materialize(df.select(F.col(row_id).cast("string").alias("_id"), *by, *[c.alias(n) for n, c in sums.items()]), "rows")
    n = rows.count()  # counted from the file footers
    tasks = max(1, math.ceil(n * len(seeds) / COPIES_PER_TASK))
    spread = rows.repartitionByRange(tasks, *by, "_id").sortWithinPartitions(*by)
    trials = F.array(*[F.lit(s) for s in seeds])
    keyed = with_order_key(spread.withColumn("trial", F.explode(trials)), F.col("trial"), "_id")
    sizes = df.sparkSession.range(1 if n else 0).select(F.explode(trials).alias("trial"), F.lit(0).alias("_stratum"), F.lit(n).cast("bigint").alias("_n"))
    wanted = _fold_cuts(sizes, ["trial"], "_stratum", k).drop("_stratum").withColumn("_size", F.lit(n).cast("bigint"))
    return segment_sums(keyed, ["trial"], wanted, k - 1, by, {name: F.col(name) for name in sums}, out)


def background_sample(df: DataFrame, row_id: str, size: int = BACKGROUND_SIZE, seed: int = SEED) -> DataFrame:
    """min(size, n) rows without replacement: the first ones in hash order (a top-k plan)."""
    keyed = with_order_key(df, seed, row_id)
    return keyed.orderBy("_key").limit(size).drop("_key", "_bucket")
