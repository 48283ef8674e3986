"""Permutation importance on held-out folds, and its summaries."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from profilespark.functions.exprs import rename_and_fill, with_weight
from profilespark.functions.ranking import assign_segments, bucket_counts, cut_keys, segment_sums, with_order_key
from profilespark.operators.quality import require_columns
from profilespark.session import materialize
from profilespark.spec import SEED, WEIGHT, TableSpec

REPEATS = 20
SUMMARY_COLUMNS = (
    "model", "feature", "selected_in_folds", "mean_importance", "std_importance_across_folds", "mean_within_fold_std",
)
# Hex digits of the buckets of one (fold, feature, repeat): few, for there are many groups; cuts refine them.
BUCKET_DIGITS = 2
# Permuted copies worth a task of their own.
COPIES_PER_TASK = 4_000_000


def _tasks(copies: int) -> int:
    """Tasks for so many copies, however many there are."""
    return max(1, math.ceil(copies / COPIES_PER_TASK))


def _bin(value: Column, points: Sequence[float]) -> Column:
    """Number (from 1) of the interval between split points that a value lies in."""
    beyond = [(value > F.lit(p)).cast("int") for p in points]
    return sum(beyond[1:], beyond[0]) + F.lit(1)


def _inside(points: Sequence[float]) -> Column:
    """A value of each interval between split points: its upper end, or one past the last."""
    return F.array(*[F.lit(float(v)) for v in [*points, points[-1] + 1.0]])


def as_seen(rows: DataFrame, points: dict[str, list[float]]) -> DataFrame:
    """Every used feature replaced by one value of its interval: all that a model sees of it."""
    return rows.withColumns({f: F.get(_inside(p), _bin(F.col(f), p) - 1) for f, p in points.items()})


def permuted_rows(rows: DataFrame, spec: TableSpec, points: dict[str, list[float]], repeats: int = REPEATS,
                  seed: int = SEED, fold: str = "outer_fold", digits: int = BUCKET_DIGITS, portable: bool = False) -> DataFrame:
    """Rows with one feature permuted within its fold, for every used feature and repeat; ``permuted_cells`` sums them.

    Adds ``_game``, the number of the (feature, repeat) pair: feature-major, from 0.
    """
    keyed, wanted, n_bins = _dealt(rows, spec, points, repeats, seed, fold, digits, portable)
    group = [fold, "_game"]
    cuts = cut_keys(keyed, bucket_counts(keyed, group), group, wanted, digits)
    placed = assign_segments(keyed, group, cuts, n_bins - 1, "_segment")
    return _handed(placed, points, repeats)


def permuted_cells(rows: DataFrame, spec: TableSpec, points: dict[str, list[float]], repeats: int = REPEATS,
                   seed: int = SEED, fold: str = "outer_fold", digits: int = BUCKET_DIGITS, portable: bool = False) -> DataFrame:
    """Weight of the permuted rows by fold, game, features as the model sees them, and target.

    ``rows`` hold the used features as seen. Copies are summed in the one pass that makes them.
    """
    keyed, wanted, n_bins = _dealt(rows, spec, points, repeats, seed, fold, digits, portable)
    seen = segment_sums(keyed, [fold, "_game"], wanted, n_bins - 1, [*points, spec.target], {WEIGHT: F.col(WEIGHT)}, "_segment", digits)
    return _handed(seen, points, repeats)


def _handed(placed: DataFrame, points: dict[str, list[float]], repeats: int) -> DataFrame:
    """The game's feature replaced by a value of the interval that the segment was handed."""
    changed = {}
    for n, (feature, split_points) in enumerate(points.items()):
        own = F.col("_game").between(n * repeats, (n + 1) * repeats - 1)
        changed[feature] = F.when(own, F.get(_inside(split_points), F.col("_segment") - 1)).otherwise(F.col(feature).cast("double"))
    return placed.withColumns(changed).drop("_segment")


def _dealt(rows: DataFrame, spec: TableSpec, points: dict[str, list[float]], repeats: int, seed: int, fold: str,
           digits: int, portable: bool) -> tuple[DataFrame, DataFrame, int]:
    """Copies of the rows with their order keys, the ranks at which each game hands over, and the most intervals.

    A model only sees on which side of its split points a value falls. Rows are
    put in seeded hash order per (fold, feature, repeat) and handed the fold's
    values in ascending order: a uniform permutation. The hand-over points are
    exact cut keys, so no row is shuffled to fetch its new value.
    """
    n_bins = max(len(p) for p in points.values()) + 1
    bins = rows.select(fold, *[_bin(F.col(f), p).alias(f) for f, p in points.items()])
    sizes = bins.unpivot([fold], list(points), "_feature", "_bin").groupBy(fold, "_feature").pivot(
        "_bin", list(range(1, n_bins + 1))
    ).agg(F.count(F.lit(1)))
    count = [F.coalesce(F.col(f"`{b}`"), F.lit(0)) for b in range(1, n_bins + 1)]
    so_far = [sum(count[1:b], count[0]) for b in range(1, n_bins)]
    first_game = (F.array_position(F.array(*[F.lit(f) for f in points]), F.col("_feature")).cast("int") - 1) * repeats
    cuts_at = F.array(*[F.struct(F.lit(b).alias("_cut"), rank.cast("bigint").alias("_rank")) for b, rank in enumerate(so_far, 1)])
    wanted = sizes.select(
        fold, F.explode(F.sequence(first_game, first_game + repeats - 1)).alias("_game"), cuts_at.alias("_at"), sum(count[1:], count[0]).alias("_size")
    ).select(fold, "_game", "_size", F.inline("_at"))
    games = F.array(*[
        F.struct(F.lit(n * repeats + k).alias("_game"), F.lit(f"/{f}/{k + 1}").alias("_name"))
        for n, f in enumerate(points) for k in range(repeats)
    ])
    copies = rows.withColumn("_fold_seed", (F.lit(seed) + F.col(fold)).cast("string")).select("*", F.inline(games))
    keyed = with_order_key(copies, F.concat("_fold_seed", "_name"), spec.key, digits, portable).drop("_fold_seed", "_name")
    return keyed, wanted, n_bins


def permutation_importance(rows: DataFrame, spec: TableSpec, points: dict[str, list[float]],
                           predict: Callable[[DataFrame], DataFrame], model: str, repeats: int = REPEATS,
                           seed: int = SEED, fold: str = "outer_fold", portable: bool = False) -> DataFrame:
    """Drop of weighted accuracy per (fold, feature): mean and population spread over the repeats.

    ``predict`` adds ``y_pred`` to a table with the feature columns. Features the
    model does not split on keep their predictions, so they get exactly 0
    without being scored. Weights stay with their row. ``portable`` permutes in an
    order other engines can reproduce, at a higher price.

    Copies are summed to cells of what a model sees before any is scored, on the map side
    first, so it scores as many rows as there are cells and not as there are copies.
    """
    rows, spec = with_weight(rows, spec)
    weight = F.col(WEIGHT)
    right = F.sum(F.when(F.col("y_pred") == F.col(spec.target), weight).otherwise(0.0)) / F.sum(weight)
    others = {f: F.lit(0.0) for f in spec.features if f not in points}

    def accuracies(copies: DataFrame, *by: str) -> DataFrame:
        """Accuracy by fold and perhaps game, from the cells of a table whose used features are as seen."""
        cells = copies.groupBy(*by, *points, spec.target).agg(F.sum(weight).alias(WEIGHT)).withColumns(others)
        return predict(cells).groupBy(*by).agg(right.alias("accuracy"))

    # Every row is about to be copied for each feature and repeat: the narrow rows are written once.
    seen = materialize(as_seen(rows.select(*filter(None, [spec.key]), fold, *points, spec.target, WEIGHT), points), "held-out")
    base = accuracies(seen, fold).withColumnRenamed("accuracy", "_base")
    unused = [f for f in spec.features if f not in points]
    idle = base.select(
        fold, F.explode(F.array(*[F.lit(f) for f in unused]).cast("array<string>")).alias("feature"),
        F.lit(0.0).alias("importance_mean"), F.lit(0.0).alias("importance_std"),
    )
    if not points:
        result = idle
    else:
        # A task does not carry all copies of a large file, and rows that look alike share one, so that it has few sums.
        tasks = _tasks(seen.count() * len(points) * repeats)  # counted from the file footers
        spread = seen.repartitionByRange(tasks, fold, *points, spec.target, spec.key).sortWithinPartitions(fold, *points, spec.target)
        spread = spread.withColumn(spec.key, F.col(spec.key).cast("string")) if portable else spread
        permuted = permuted_cells(spread, spec, points, repeats, seed, fold, portable=portable)
        shuffled = accuracies(permuted, fold, "_game").withColumnRenamed("accuracy", "_permuted")
        names = F.array(*[F.lit(f) for f in points])
        feature = F.get(names, F.call_function("div", F.col("_game"), F.lit(repeats)).cast("int"))
        drops = shuffled.join(F.broadcast(base), fold).withColumn("_drop", F.col("_base") - F.col("_permuted"))
        result = drops.groupBy(fold, feature.alias("feature")).agg(
            F.avg("_drop").alias("importance_mean"), F.stddev_pop("_drop").alias("importance_std")
        ).unionByName(idle)
    return result.select(F.lit(model).alias("model"), F.col(fold).alias("outer_fold"), "feature", "importance_mean", "importance_std")


def importance_summary(scores: DataFrame) -> DataFrame:
    """Per (model, feature): folds that selected it, mean and spread of the importance across folds."""
    return scores.groupBy("model", "feature").agg(
        F.sum(F.col("selected").cast("bigint")).alias("selected_in_folds"),
        F.avg("importance_mean").alias("mean_importance"),
        F.stddev_samp("importance_mean").alias("std_importance_across_folds"),
        F.avg("importance_std").alias("mean_within_fold_std"),
    )


def importance_rank(summary: DataFrame, model: str) -> DataFrame:
    """One model's features under a dense rank by importance."""
    order = Window.partitionBy("model").orderBy(F.round("importance_mean", 12).desc())  # one row per feature
    return rename_and_fill(require_columns(summary, SUMMARY_COLUMNS, "Importance summary"), model).select(
        F.dense_rank().over(order).alias("rank"), "model", "feature", "selected_in_folds",
        "importance_mean", "importance_std", "mean_within_fold_std",
    )


def importance_topn(ranked: DataFrame, n: int | None = 10) -> DataFrame:
    """Top features with their error bars; ``None`` keeps all."""
    if n is not None and n <= 0:
        raise ValueError("n must be positive or None.")
    bars = ranked.select(
        "rank", "feature", "importance_mean", "importance_std",
        (F.col("importance_mean") - F.col("importance_std")).alias("bar_low"),
        (F.col("importance_mean") + F.col("importance_std")).alias("bar_high"),
    ).orderBy("rank", "feature")
    return bars if n is None else bars.limit(n)
