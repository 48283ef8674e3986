"""Duplicate treatment: exact, and weighted majority vote per feature profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from profilespark.spec import WEIGHT, TableSpec


def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop rows equal on every column, label included."""
    return df.dropDuplicates()


def unique_profiles(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*spec.features).distinct()


def label_votes(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows per (profile, label), whatever labels occur: pre-aggregated on the map side."""
    return df.groupBy(*spec.features, spec.target).agg(F.sum(spec.rows).alias("_votes"))


def profile_votes(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per profile: its rows, its labels, and the top count with the smallest and largest label that reach it.

    The vote is over labels that occur, so rows of an undeclared label count too. A null label has
    rows, but stands in no vote.
    """
    label = F.col(spec.target)
    voted = F.when(label.isNotNull(), F.col("_votes"))
    return label_votes(df, spec).groupBy(*spec.features).agg(
        F.sum("_votes").alias("_rows"), F.count(label).alias("_labels"),
        F.max(F.when(voted.isNotNull(), F.struct(voted.alias("n"), label.alias("label")))).alias("_last"),
        F.max(F.when(voted.isNotNull(), F.struct(voted.alias("n"), (-label).alias("label")))).alias("_first"),
    ).select(
        *spec.features, "_rows", "_labels", F.coalesce(F.col("_last.n"), F.lit(0)).alias("_top"),
        F.col("_last.label").alias("_winner"), (F.col("_last.label") == -F.col("_first.label")).alias("_clear"),
    )


def majority_from_votes(votes: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the majority label, weighted by its own support only; drop tied profiles."""
    return votes.where("_clear").select(*spec.features, F.col("_winner").cast("int").alias(spec.target), F.col("_top").alias(WEIGHT))


def weighted_majority_dedup(df: DataFrame, spec: TableSpec) -> DataFrame:
    return majority_from_votes(profile_votes(df, spec), spec)


def exact_dedup_report(df: DataFrame) -> DataFrame:
    """Rows before and after exact deduplication, from one count per distinct row."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    counts = distinct.agg(F.sum("_n").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    return counts.withColumn("exact_duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def weighted_dedup_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """What the vote did: ties dropped, conflicts resolved, mass kept and discarded."""
    top, kept = F.col("_top"), F.coalesce("_clear", F.lit(False))
    total = lambda c, value: F.sum(F.when(c, value).otherwise(F.lit(0).cast("bigint")))
    one = F.lit(1).cast("bigint")
    return profile_votes(df, spec).agg(
        F.sum("_rows").alias("rows_before"),
        F.count(F.lit(1)).alias("profiles_before"),
        total(kept, one).alias("profiles_kept"),
        total(~kept, one).alias("dropped_ties"),
        total(kept & (F.col("_labels") > 1), one).alias("resolved_conflicts"),
        total(kept, top).alias("retained_mass"),
        total(kept, F.col("_rows") - top).alias("minority_mass"),
        total(~kept, F.col("_rows")).alias("tied_mass"),
    )


def split_report(split: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows and retained mass on each side of a split."""
    mass = F.col(weight).cast("double") if weight else F.lit(1.0)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(mass).alias("mass"))


# Rows that one task spells out of a group of identical rows.
CHUNK = 1_000_000


def row_key(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Key for tables without one: digest of the row plus its occurrence number.

    Identical rows are counted (pre-aggregated) and spelled out again from the
    count. A row that occurs too often for one task is cut into chunks that are
    spread over the cluster; all others stay where they are.
    """
    columns = df.columns
    # As JSON: quoted texts and a null of its own, so different rows have different texts.
    text = F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    few = counted.where(F.col("_n") <= CHUNK).withColumn("_occurrence", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {CHUNK}")))
    spread = counted.where(F.col("_n") > CHUNK).withColumn("_chunk", chunk).repartition(*columns, "_chunk")
    last = F.least(F.col("_n"), (F.col("_chunk") + 1) * CHUNK)
    many = spread.withColumn("_occurrence", F.explode(F.sequence(F.col("_chunk") * CHUNK + 1, last))).drop("_chunk")
    return few.unionByName(many).select(
        F.concat(F.md5(text), F.lit("-"), F.col("_occurrence").cast("string")).alias(out), *columns
    )
