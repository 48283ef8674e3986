"""Exact ranks and running totals without a global sort.

Both problems are solved in levels: rows are counted per bucket, the bounded
bucket table is summed up, and only inside the finest buckets are rows ordered. No
window here ever spans a whole class, model or feature.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StringType

from profilespark.session import materialize

# Leading hex digits of the hash that name a bucket: 65,536 buckets per group.
BUCKET_DIGITS = 4
# Further digits that divide a bucket which holds a cut: 65,536 parts.
FINE_DIGITS = 4
# Reach of the window around a cut's expected key, in units of 1/sqrt(rows): six standard deviations.
REACH = 3.0
# Cells whose totals run in one task: some hundred bytes each, sorted and joined there.
CELLS_PER_TASK = 200_000


def hash_key(seed: Column | int, row_id: Column) -> Column:
    """Seeded random order of rows, the same in every engine and every run."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.md5(F.concat(seed.cast("string"), F.lit(":"), row_id.cast("string")))


def with_order_key(df: DataFrame, seed: Column | int, row_id: str, digits: int = BUCKET_DIGITS,
                   portable: bool = True) -> DataFrame:
    """Add the order key of every row and the bucket it starts with (``digits`` hex digits).

    The portable key is an md5 digest any engine can reproduce. The other one is
    a 64-bit hash, several times cheaper; rows whose hashes collide at a cut fall
    on the same side of it.
    """
    if portable:
        return df.withColumn("_key", hash_key(seed, F.col(row_id))).withColumn("_bucket", F.substring("_key", 1, digits))
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return df.withColumn("_key", F.xxhash64(seed, F.col(row_id))).withColumn("_bucket", F.shiftright("_key", 64 - 4 * digits))


def bucket_counts(keyed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows per bucket of each group, written once: at most 16^digits rows per group.

    Several steps read this table; planned lazily, each would count the rows again.
    """
    return materialize(keyed.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n")), "buckets")


def _located(buckets: DataFrame, group: list[str], bucket: str, wanted: DataFrame) -> DataFrame:
    """The bucket of each wanted ``_rank`` of each group, and the rank's ``_place`` in it."""
    so_far = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    ends = buckets.withColumn("_end", F.sum("_n").over(so_far))
    return (
        # One row per group and cut: bounded by the number of groups.
        ends.join(F.broadcast(wanted), group)
        .where((F.col("_rank") <= F.col("_end")) & (F.col("_rank") > F.col("_end") - F.col("_n")))
        .select(*group, bucket, "_cut", (F.col("_rank") - F.col("_end") + F.col("_n")).alias("_place"))
    )


def _part(keyed: DataFrame, digits: int) -> Column:
    """The leading ``digits`` hex digits of the order key."""
    if isinstance(keyed.schema["_key"].dataType, StringType):
        return F.substring("_key", 1, digits)
    return F.shiftright("_key", 64 - 4 * digits)


def cut_keys(keyed: DataFrame, buckets: DataFrame, group: Sequence[str], wanted: DataFrame, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Order key of the row at each wanted rank of each group.

    ``wanted`` holds ``group``, ``_cut`` and a 1-based ``_rank``. Only rows in the
    few buckets that contain a wanted rank are written; these are counted again by
    ``FINE_DIGITS`` more digits, and only the parts with a rank are sorted: of 10^12
    rows of a group and four digits, about 230 a part.
    """
    group = list(group)
    coarse = _located(buckets, group, "_bucket", wanted)
    hit = coarse.select(*group, "_bucket").distinct()
    held = keyed.select(*group, "_bucket", "_key").join(F.broadcast(hit), [*group, "_bucket"], "left_semi")
    held = materialize(held.withColumn("_part", _part(keyed, digits + FINE_DIGITS)), "cut-rows")
    inside = [*group, "_bucket"]
    counts = held.groupBy(*inside, "_part").agg(F.count(F.lit(1)).alias("_n"))
    fine = _located(counts, inside, "_part", coarse.withColumnRenamed("_place", "_rank"))
    parts = [*inside, "_part"]
    order = Window.partitionBy(*parts).orderBy("_key")
    return (
        held.join(F.broadcast(fine.select(*parts).distinct()), parts, "left_semi")
        .withColumn("_place", F.row_number().over(order).cast("bigint"))
        .join(F.broadcast(fine), [*parts, "_place"])
        .select(*group, "_cut", F.col("_key").alias("_cut_key"))
    )


def assign_segments(keyed: DataFrame, group: Sequence[str], cuts: DataFrame, n_cuts: int, out: str) -> DataFrame:
    """Number (from 1) of the segment between cut keys a row falls into; no shuffle of the rows."""
    if n_cuts == 0:
        return keyed.withColumn(out, F.lit(1)).drop("_key", "_bucket")
    names = [f"_cut_{i}" for i in range(1, n_cuts + 1)]
    wide = cuts.groupBy(*group).pivot("_cut", list(range(1, n_cuts + 1))).agg(F.first("_cut_key"))
    wide = wide.select(*group, *[F.col(f"`{i}`").alias(n) for i, n in enumerate(names, start=1)])
    # A cut without a key has rank 0: every row lies beyond it.
    beyond = [F.coalesce((F.col("_key") > F.col(n)).cast("int"), F.lit(1)) for n in names]
    segment = sum(beyond[1:], beyond[0]) + F.lit(1)
    return (
        keyed.join(F.broadcast(wide), list(group), "left")
        .withColumn(out, segment)
        .drop("_key", "_bucket", *names)
    )


def _windows(wanted: DataFrame, text: bool) -> DataFrame:
    """``_low`` and ``_high`` around the key expected at each rank, as order keys are uniform; ranks 0 and ``_size`` need no key."""
    def edge(x: Column) -> Column:
        if text:
            digits = F.lpad(F.lower(F.hex(F.floor(x * 2.0**52).cast("bigint"))), 13, "0")
            return F.when(x <= 0, F.lit("")).when(x >= 1, F.lit("g")).otherwise(digits)
        scaled = F.floor((x - 0.5) * 2.0**64).cast("bigint")
        return F.when(x <= 0, F.lit(-(2**63))).when(x >= 1, F.lit(2**63 - 1)).otherwise(scaled)

    at, reach = F.col("_rank") / F.col("_size"), F.lit(REACH) / F.sqrt(F.col("_size").cast("double"))
    inner = F.when(F.col("_rank") == F.col("_size"), edge(F.lit(1.0)))
    return wanted.where("_size > 0").withColumns({
        n: F.when(F.col("_rank") > 0, inner.otherwise(edge(x))) for n, x in (("_low", at - reach), ("_high", at + reach))
    })


def _side_by_side(cuts: DataFrame, group: list[str], n_cuts: int, *columns: str) -> DataFrame:
    """One row per group, ``<column>_<cut>`` for each cut."""
    return cuts.groupBy(*group).agg(*[
        F.max(F.when(F.col("_cut") == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, n_cuts + 1) for c in columns
    ])


def segment_sums(keyed: DataFrame, group: Sequence[str], wanted: DataFrame, n_cuts: int, by: Sequence[str],
                 sums: dict[str, Column], out: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Sums per group, ``by`` and segment between cuts: ``assign_segments`` and an aggregation in one pass over the rows.

    ``wanted`` is as for ``cut_keys``, all cuts of a group with its rows as ``_size``. Keys are uniform, so a cut lies
    within a narrow window around its share of the keys. Rows outside all windows are summed at once;
    those inside, some 6 sqrt(n) per group and cut, are kept by key until the cut is found among them.
    A cut outside its window (keys that repeat a lot, or one case in 10^8) is found by ``cut_keys`` instead.
    """
    group, by = list(group), list(by)
    windows = materialize(_windows(wanted, isinstance(keyed.schema["_key"].dataType, StringType)), "windows")
    numbers = range(1, n_cuts + 1)

    def segment(key: str, edge: str) -> Column:
        # A cut without a key has rank 0: every row lies beyond it.
        return sum((F.coalesce((F.col(key) > F.col(f"{edge}_{i}")).cast("int"), F.lit(1)) for i in numbers), F.lit(1))

    inside = F.lit(False)
    for i in numbers:
        inside = inside | F.coalesce((F.col("_key") > F.col(f"_low_{i}")) & (F.col("_key") <= F.col(f"_high_{i}")), F.lit(False))
    totals = materialize(
        keyed.join(F.broadcast(_side_by_side(windows, group, n_cuts, "_low", "_high")), group, "left")
        .groupBy(*group, *by, segment("_key", "_high").alias(out), F.when(inside, F.col("_key")).alias("_open"))
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in sums.items()]), "segments")
    settled, kept = totals.where("_open is null"), totals.where("_open is not null")
    asked = windows.where("_rank > 0 and _rank < _size")
    # Outside all windows, a row lies below a cut if its segment does: one row per group and cut.
    below = asked.join(settled.groupBy(*group, out).agg(F.sum("_n").alias("_n")), group, "left").groupBy(*group, "_cut", "_rank", "_low", "_high").agg(
        F.coalesce(F.sum(F.when(F.col(out) <= F.col("_cut"), F.col("_n"))), F.lit(0)).alias("_below"))
    keys = kept.groupBy(*group, "_open").agg(F.sum("_n").alias("_n"))
    so_far = Window.partitionBy(*group, "_cut").orderBy("_open").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        keys.join(F.broadcast(below), group).where(F.col("_open") <= F.col("_high"))
        .withColumn("_end", F.col("_below") + F.sum("_n").over(so_far)).where(F.col("_end") >= F.col("_rank"))
        .groupBy(*group, "_cut", "_low").agg(F.min("_open").alias("_at"))
        .where(F.col("_at") > F.col("_low")).select(*group, "_cut", "_at")
    )
    found = materialize(found, "cuts")
    if not asked.join(found, [*group, "_cut"], "left_anti").isEmpty():
        cuts = cut_keys(keyed, bucket_counts(keyed, group), group, wanted, digits)
        placed = assign_segments(keyed, group, cuts, n_cuts, out)
        return placed.groupBy(*group, *by, out).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    cuts = windows.select(*group, "_cut", "_high").join(found, [*group, "_cut"], "left").withColumn("_at", F.coalesce("_at", "_high"))
    placed = kept.join(F.broadcast(_side_by_side(cuts, group, n_cuts, "_at")), group, "left").withColumn(out, segment("_open", "_at"))
    columns = [*group, *by, out, *sums]
    return settled.select(*columns).unionByName(placed.select(*columns)).groupBy(*group, *by, out).agg(*[F.sum(n).alias(n) for n in sums])


def running_totals(cells: DataFrame, group: Sequence[str], digits: Sequence[tuple[str, Column]], order: str,
                   sums: Sequence[str]) -> DataFrame:
    """Add ``cum_<s>``, the inclusive running total of each sum in ``order`` within ``group``.

    ``digits`` are coarse, order-preserving parts of ``order``, most significant
    first. Totals of coarse parts are carried down to finer ones, so each window
    sees one part only. The cells, one row per distinct value of ``order``, are
    written once because every level reads them.
    """
    group = list(group)
    names = [name for name, _ in digits]
    cells = materialize(cells.withColumns(dict(digits)), "cells")
    carried = None
    for depth in range(1, len(names) + 1):
        node, parent = group + names[:depth], group + names[: depth - 1]
        before = Window.partitionBy(*parent).orderBy(names[depth - 1]).rowsBetween(Window.unboundedPreceding, -1)
        level = cells.groupBy(*node).agg(*[F.sum(s).alias(s) for s in sums])
        level = level.select(
            *node, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_before_{s}") for s in sums]
        )
        if carried is not None:
            up = carried.withColumnsRenamed({f"_before_{s}": f"_up_{s}" for s in sums})
            level = level.join(up, parent).select(
                *node, *[(F.col(f"_before_{s}") + F.col(f"_up_{s}")).alias(f"_before_{s}") for s in sums]
            )
        carried = level
    node = group + names
    # By number of cells: partitions measured in compressed bytes hold many times their size in memory.
    tasks = max(1, math.ceil(cells.count() / CELLS_PER_TASK))  # counted from the file footers
    within = Window.partitionBy(*node).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cells.repartition(tasks, *node).join(carried, node)
        .withColumns({f"cum_{s}": F.sum(s).over(within) + F.col(f"_before_{s}") for s in sums})
        .drop(*names, *[f"_before_{s}" for s in sums])
    )


def unit_digits(score: Column) -> list[tuple[str, Column]]:
    """Two 12-bit digits of a score in [0, 1]; scaling by a power of two is exact."""
    first = F.floor(score * 4096)
    second = F.floor((score * 4096 - first) * 4096)
    return [("_d1", first), ("_d2", second)]


def number_digits(value: Column, kind: DataType) -> list[tuple[str, Column]]:
    """Digits of a number of any size and fraction, by its type.

    Whole numbers of up to 32 bits fall into blocks of 65,536, longer ones are split every 16 bits. Others go by sign and
    power of two (at most 4,200 digits), then by 16 and 16 bits of the fraction: at most 2^20 different doubles are left.
    """
    if isinstance(kind, (ByteType, ShortType, IntegerType)):
        return [("_d1", F.shiftright(value, 16))]
    if isinstance(kind, LongType):
        return [(f"_d{i}", F.shiftright(value, 64 - 16 * i)) for i in (1, 2, 3)]
    number = value.cast("double")
    size, sign = F.abs(number), F.signum(number)
    # Rounded logarithms and products never fall as numbers rise, which is all that digits need.
    power = F.floor(F.least(F.log2(size), F.lit(1100.0)))
    fraction = F.when(power < 1100, size / F.pow(F.lit(2.0), power)) * 65536.0
    first = F.floor(fraction)
    second = F.floor((fraction - first) * 65536.0)
    digits = [power + 1200, first, second]
    return [(f"_d{i}", F.coalesce(sign.cast("bigint") * d, F.lit(0).cast("bigint"))) for i, d in enumerate(digits, 1)]
