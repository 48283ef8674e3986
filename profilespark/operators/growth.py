"""Growing many trees at once, level by level, on counted profiles.

A table collapses to cells: distinct (features, label, weight) with a count of rows per fold. What a split trains on
is the total of a cell less the count of its held-out fold, so no row is copied for any fold. All fits of a search
(folds, candidates, the trees of forests) grow together: one pass per level aggregates the histograms of every open
node of every tree, chooses its cut, and routes the profiles on. Held-out profiles travel along without training mass,
so they arrive at their leaves as the trees are finished.

A bootstrap of n rows of a cell is one Poisson(n) draw, a function of the seed, the tree and the cell: the sum of n
Poisson(1) draws. The features that a node of a forest may use are the first by a hash of seed, tree, node and feature
among those that differ in the node. Nothing is drawn from a generator, so reruns and other engines draw the same.

Cuts lie halfway between neighbouring values of the node's training rows; every one is tried. The best has the largest
gain (rounded to 12 digits), then the earlier feature, then the lower cut. A node is split if it has ``min_split`` rows,
both sides keep ``min_leaf``, and the gain is positive. Rows are counted as drawn; impurity weighs them.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from profilespark.operators.trees import Node, predicted_label
from profilespark.session import materialize
from profilespark.spec import FAMILIES, SEED, TableSpec

#: Numbers of nodes are those of a heap, in 64 bits; stands for "no limit".
MAX_DEPTH = 60
#: Trees that grow together, so that the profiles on their way stay bounded.
TREES_AT_A_TIME = 4096
#: Profiles of trees that one task makes of cells: each may take a draw.
MEMBERS_PER_TASK = 50_000
#: The most tasks they are dealt to.
MAX_TASKS = 4096
#: Counts up to this are drawn by inversion of the exact distribution, larger ones by its normal expansion.
EXACT_DRAWS = 64
_NODE = ["fit", "tree", "node"]


@dataclass(frozen=True)
class Fit:
    """One training: a split of a group of cells, a parameter record, and the variants that share its growth.

    Split 0 trains on all folds of the group and holds out what is in none of them. ``variants`` are
    (name, max_depth, min_split): trees cut at a depth or a row count label as trees grown so.
    """

    fit: int
    group: int
    split: int
    features: tuple[int, ...]
    criterion: str = "gini"
    min_leaf: int = 1
    trees: int = 1
    bootstrap: bool = False
    tried: int | None = None
    variants: tuple[tuple[int, int, int], ...] = ((0, MAX_DEPTH, 2),)

    @property
    def row(self) -> tuple:
        return (
            self.fit, self.group, self.split, list(self.features), self.criterion, self.min_leaf, self.trees, self.bootstrap,
            len(self.features) if self.tried is None else self.tried, max(v[1] for v in self.variants), min(v[2] for v in self.variants), list(self.variants),
        )


_FIT = ("fit int, group int, split int, features array<int>, criterion string, min_leaf int, trees int, bootstrap boolean, tried int, "
        "depth int, min_split int, variants array<struct<name: int, depth: int, split: int>>")


def features_tried(value: object, k: int) -> int | None:
    """How many features a node of a forest may use, of k; None for all."""
    if value is None or str(value) == "None":
        return None
    if value in ("sqrt", "log2"):
        return max(1, math.isqrt(k) if value == "sqrt" else int(math.log2(k)))
    return max(1, int(float(value) * k))


# Cells


def cells_of(df: DataFrame, spec: TableSpec, n_splits: int, fold: Column, group: Column | int = 0) -> DataFrame:
    """``group, x, key, positive, weight, counts``: cells with their rows by fold (0: in none), written once.

    ``df`` may hold several groups and a row once per group; counts are taken on the map side first.
    """
    x = F.array(*[F.col(f).cast("double") for f in spec.features])
    text = F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in spec.features], F.col(spec.target).cast("string"), spec.mass.cast("string"))
    counted = df.select(
        (group if isinstance(group, Column) else F.lit(group)).cast("int").alias("group"), x.alias("x"), text.alias("key"),
        (F.col(spec.target) == spec.positive).alias("positive"), spec.mass.alias("weight"), fold.cast("int").alias("fold"),
    ).groupBy("group", "x", "key", "positive", "weight").agg(
        *[F.sum((F.col("fold") == i).cast("bigint")).alias(f"n_{i}") for i in range(n_splits + 1)])
    counts = F.array(*[F.col(f"n_{i}") for i in range(n_splits + 1)])
    return materialize(counted.select("group", "x", "key", "positive", "weight", counts.alias("counts")), "cells")


def training_count(counts: str, split: str) -> Column:
    """Rows of a cell that a split trains on: all in folds, less the held-out fold's."""
    folds = F.aggregate(F.slice(counts, 2, F.greatest(F.size(counts) - 1, F.lit(0))), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return folds - F.when(F.col(split) > 0, F.get(counts, F.col(split))).otherwise(0)


# Draws


def _uniform(text: Column, part: int) -> Column:
    """A number in [0, 1) from 13 hexadecimal digits of a digest."""
    return F.conv(F.substring(F.md5(text), 1 + 13 * part, 13), 16, 10).cast("double") / F.lit(float(16**13))


def poisson_table(most: int = EXACT_DRAWS) -> list[list[float]]:
    """Distribution functions of Poisson(0), Poisson(1), ..., as far as they are below 1."""
    out = []
    for n in range(most + 1):
        p = total = math.exp(-n)
        row, k = [total], 0
        while total < 1 - 1e-15 and k < n + 200:
            k += 1
            p *= n / k
            total += p
            row.append(total)
        out.append(row)
    return out


def poisson_draw(n: Column, text: Column) -> Column:
    """A Poisson(n) number that the text determines: by inversion, or for large n by the expansion of its quantiles."""
    table = F.from_json(F.lit(json.dumps(poisson_table())), "array<array<double>>")  # folded into one constant
    u = _uniform(text, 0)
    # Bound to a name, as a lambda computes what it holds for every element.
    small = F.get(F.transform(F.array(u), lambda x: F.size(F.filter(F.get(table, n.cast("int")), lambda c: c <= x))), F.lit(0))
    z = F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * _uniform(text, 1))
    large = F.round(n + F.sqrt(n.cast("double")) * z + (z * z - 1) / 6)
    return F.when(n <= EXACT_DRAWS, small).otherwise(F.greatest(large, F.lit(0.0))).cast("bigint")


# Growth


def _members(cells: DataFrame, fits: DataFrame, seed: int, tasks: int = 1) -> DataFrame:
    """Every profile of every tree at its root: training mass by label and rows as drawn, held-out mass by label.

    A small file of cells may make many profiles, so these are dealt to at least so many tasks.
    """
    cells = cells.repartition(tasks) if tasks > 1 else cells
    held = F.when(F.col("split") > 0, F.get("counts", F.col("split"))).otherwise(F.get("counts", F.lit(0)))
    rows = cells.join(F.broadcast(fits.select("fit", "group", "split", "features", "trees", "bootstrap", "variants")), "group")  # one row per fit
    rows = rows.select(
        "fit", F.transform("features", lambda i: F.get("x", i)).alias("x"), "key", "positive", "weight", "bootstrap",
        training_count("counts", "split").alias("n"), held.alias("held"), F.explode(F.sequence(F.lit(1), F.col("trees"))).alias("tree"),
        F.transform("variants", lambda v: F.lit(None).cast("double")).alias("settled"),
    ).where("n + held > 0")
    draw = poisson_draw(F.col("n"), F.concat(F.lit(f"{seed}/"), F.col("tree").cast("string"), F.lit("/"), F.col("key")))
    rows = rows.withColumn("n", F.when(F.col("bootstrap") & (F.col("n") > 0), draw).otherwise(F.col("n")))
    mass = lambda c, positive: F.sum(F.when(F.col("positive") == positive, F.col(c) * F.col("weight")).otherwise(0.0))
    return rows.groupBy("fit", "tree", "x", "settled").agg(
        mass("n", True).alias("a"), mass("n", False).alias("b"), F.sum("n").alias("n"), mass("held", True).alias("held_a"), mass("held", False).alias("held_b"),
    ).withColumn("node", F.lit(1).cast("bigint"))


def _impurity(a: Column, b: Column) -> Column:
    """Gini impurity or entropy in bits, as the fit says."""
    p, q = a / (a + b), b / (a + b)
    bits = lambda r: F.when(r > 0, -r * F.log2(r)).otherwise(0.0)
    return F.when(F.col("criterion") == "entropy", bits(p) + bits(q)).otherwise(1 - F.pow(p, F.lit(2)) - F.pow(q, F.lit(2)))


def _level() -> Column:
    """The level of a node, by its number: no literal, so the code generated for one level serves all others."""
    return F.length(F.bin("node")) - 1


def _cuts(live: DataFrame, fits: DataFrame, seed: int, subsets: bool) -> DataFrame:
    """The best cut of every node that has one: ``place`` of the feature and ``cut``."""
    long = live.select(*_NODE, "a", "b", "n", F.posexplode("x").alias("place", "value"))
    hist = long.groupBy(*_NODE, "place", "value").agg(*[F.sum(c).alias(c) for c in ("a", "b", "n")])
    feature = Window.partitionBy(*_NODE, "place")
    line = feature.orderBy("value")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = hist.withColumns({
        "after": F.lead("value").over(line), **{f"left_{c}": F.sum(c).over(upto) for c in ("a", "b", "n")}, **{f"all_{c}": F.sum(c).over(feature) for c in ("a", "b", "n")},
    }).where("after is not null")
    each = each.join(F.broadcast(fits.select("fit", "criterion", "min_leaf", "min_split", "depth", "tried", "features")), "fit")
    each = each.where((F.col("depth") > _level()) & (F.col("all_n") >= F.col("min_split")))
    left, whole = [F.col(f"left_{c}") for c in ("a", "b")], [F.col(f"all_{c}") for c in ("a", "b")]
    right = [F.greatest(w - x, F.lit(0.0)) for w, x in zip(whole, left)]
    share = lambda side: (side[0] + side[1]) / (whole[0] + whole[1])
    gain = _impurity(*whole) - share(left) * _impurity(*left) - share(right) * _impurity(*right)
    wide_enough = (F.col("left_n") >= F.col("min_leaf")) & (F.col("all_n") - F.col("left_n") >= F.col("min_leaf")) & (share(left) > 0) & (share(right) > 0)
    each = each.withColumn("gain", F.when(wide_enough, gain)).withColumn("cut", (F.col("value") + F.col("after")) / 2)
    best = each.groupBy(*_NODE, "place").agg(
        F.max(F.struct(F.round("gain", 12).alias("gain"), (-F.col("cut")).alias("low"))).alias("best"),
        F.first("tried").alias("tried"), F.first(F.get("features", F.col("place"))).alias("feature"))
    if subsets:
        # One row per node and feature: the first ``tried`` of those that differ in the node.
        drawn = F.md5(F.concat_ws("/", F.lit(str(seed)), "tree", "node", "feature"))
        best = best.withColumn("turn", F.row_number().over(Window.partitionBy(*_NODE).orderBy(drawn, "place"))).where("turn <= tried")
    best = best.where(F.col("best.gain") > 1e-12)
    chosen = F.max(F.struct(F.col("best.gain"), (-F.col("place")).alias("early"), F.col("best.low"))).alias("best")
    return best.groupBy(*_NODE).agg(chosen).select(*_NODE, (-F.col("best.early")).alias("place"), (-F.col("best.low")).alias("cut"))


@dataclass(frozen=True)
class Growth:
    """Grown trees: ``nodes`` (fit, tree, node, level, a, b, n, place, cut) and ``arrived``, the profiles at their leaves."""

    fits: DataFrame
    nodes: DataFrame
    arrived: DataFrame

    def held_out(self) -> DataFrame:
        """``fit, name, x, probability, held_a, held_b``: P(positive) of each held-out profile, averaged over the trees."""
        rows = self.arrived.where("held_a + held_b > 0").join(F.broadcast(self.fits.select("fit", "variants")), "fit")
        pairs = F.zip_with("variants", "settled", lambda v, s: F.struct(v["name"].alias("name"), s.alias("value")))
        each = rows.select("fit", "x", "held_a", "held_b", F.inline(pairs))
        return each.groupBy("fit", "name", "x").agg(
            F.round(F.avg("value"), 12).alias("probability"), F.max("held_a").alias("held_a"), F.max("held_b").alias("held_b"))

    def scores(self) -> DataFrame:
        """``fit, name, score``: weighted accuracy on the held-out profiles."""
        right = F.sum(F.when(F.col("probability") >= 0.5, F.col("held_a")).otherwise(F.col("held_b")))
        return self.held_out().groupBy("fit", "name").agg((right / F.sum(F.col("held_a") + F.col("held_b"))).alias("score"))


def _grow_batch(cells: DataFrame, fits: Sequence[Fit], seed: int) -> Growth:
    spark = cells.sparkSession
    table = spark.createDataFrame([f.row for f in fits], _FIT)
    subsets = any(f.tried is not None and f.tried < len(f.features) for f in fits)
    groups = Counter()
    for f in fits:
        groups[f.group] += f.trees
    made = sum(r["n"] * groups[r["group"]] for r in cells.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per group
    members = materialize(_members(cells, table, seed, min(MAX_TASKS, math.ceil(made / MEMBERS_PER_TASK))), "tree-members")
    nodes, arrived = [], []
    deepest = max(v[1] for f in fits for v in f.variants)
    for level in range(deepest + 1):
        live = members.where("n > 0")
        sums = live.groupBy(*_NODE).agg(*[F.sum(c).alias(c) for c in ("a", "b", "n")])
        if level < deepest:
            here = sums.join(_cuts(live, table, seed, subsets), _NODE, "left")
        else:
            here = sums.withColumns({"place": F.lit(None).cast("int"), "cut": F.lit(None).cast("double")})
        nodes.append(materialize(here.withColumn("level", _level()), "tree-nodes"))
        at = nodes[-1].select(*_NODE, "level", (F.col("a") / (F.col("a") + F.col("b"))).alias("value"), F.col("n").alias("node_n"), "place", "cut")
        moved = members.join(at, _NODE).join(F.broadcast(table.select("fit", "variants")), "fit")
        stops = lambda v: (v["depth"] <= F.col("level")) | (F.col("node_n") < v["split"]) | F.col("place").isNull()
        settled = F.zip_with("settled", "variants", lambda s, v: F.coalesce(s, F.when(stops(v), F.col("value"))))
        beyond = F.col("node") * 2 + (F.get("x", F.col("place")) > F.col("cut")).cast("bigint")
        moved = moved.select(
            "fit", "tree", "x", settled.alias("settled"), "a", "b", "n", "held_a", "held_b",
            F.when(F.col("place").isNotNull(), beyond).alias("node"))
        moved = materialize(moved.withColumn("done", F.col("node").isNull()), "tree-members", ["done"])
        arrived.append(moved.where("done").drop("done", "node"))
        members = moved.where("not done").drop("done")
        # A folder is written for profiles that go on where there are some, so their files tell without a job.
        if level == deepest or not any("/done=false/" in file for file in moved.inputFiles()):
            break
    stack = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(stack(parts[1:]))
    return Growth(table, stack(nodes), stack(arrived))


def grow(cells: DataFrame, fits: Sequence[Fit], seed: int = SEED, at_a_time: int = TREES_AT_A_TIME) -> Iterator[Growth]:
    """Grows the fits on their groups' cells, as many trees together as ``at_a_time`` allows (one fit at least)."""
    batch, trees = [], 0
    for fit in fits:
        if batch and trees + fit.trees > at_a_time:
            yield _grow_batch(cells, batch, seed)
            batch, trees = [], 0
        batch.append(fit)
        trees += fit.trees
    if batch:
        yield _grow_batch(cells, batch, seed)


# Models


def packed_trees(nodes: DataFrame) -> DataFrame:
    """One row per tree: its nodes as arrays in level order, with the place of each left child.

    In level order the children of the k-th split node (from 0) stand at 2k + 1 and 2k + 2.
    """
    order = Window.partitionBy("fit", "tree").orderBy("node")
    splits = F.sum(F.col("place").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = nodes.select(
        "fit", "tree", "node", "place", "cut", F.when(F.col("place").isNotNull(), 2 * splits - 1).cast("int").alias("left"),
        (F.col("a") / (F.col("a") + F.col("b"))).alias("value"))
    listed = placed.groupBy("fit", "tree").agg(F.sort_array(F.collect_list(F.struct("node", "place", "cut", "left", "value"))).alias("nodes"))
    return listed.select("fit", "tree", *[F.col(f"nodes.{c}").alias(c) for c in ("place", "cut", "left", "value")])


def arrive(profiles: DataFrame, trees: DataFrame, depth: int) -> DataFrame:
    """Adds ``leaf``, the value of the leaf that ``x`` reaches, to profiles joined with packed trees on (fit, tree)."""
    step = lambda i, _: F.when(F.get("place", i).isNull(), i).otherwise(
        F.get("left", i) + F.coalesce(F.get("x", F.get("place", i)) > F.get("cut", i), F.lit(True)).cast("int"))
    found = profiles.join(trees, ["fit", "tree"])
    return found.withColumn("leaf", F.get("value", F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)))


def score_by(df: DataFrame, by: str, models: Mapping[int, Fit], nodes: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the predictions of as many models as ``by`` has values; ``models`` names the fit of each."""
    table = df.sparkSession.createDataFrame([(at, f.fit, list(f.features), f.trees) for at, f in models.items()], "_by int, fit int, features array<int>, trees int")
    trees = packed_trees(nodes.where(F.col("fit").isin([f.fit for f in models.values()])))
    depth = nodes.agg(F.max("level")).first()[0]
    rows = df.withColumn("_all", F.array(*[F.col(f).cast("double") for f in spec.features]))
    seen = rows.select(F.col(by).cast("int").alias("_by"), "_all").distinct().join(F.broadcast(table), "_by")  # a row per model
    copies = seen.select("_by", "_all", "fit", F.transform("features", lambda i: F.get("_all", i)).alias("x"), F.explode(F.sequence(F.lit(1), F.col("trees"))).alias("tree"))
    found = arrive(copies, trees, depth).groupBy(F.col("_by").alias(by), "_all").agg(F.round(F.avg("leaf"), 12).alias("phishing_probability"))
    return rows.join(found, [by, "_all"]).drop("_all").withColumn("y_pred", predicted_label(F.col("phishing_probability")))


def box_conditions(nodes: DataFrame, selected: Sequence[str], n_trees: int) -> DataFrame:
    """The leaves of one model's node table in long form: ``tree, leaf, value, feature, bit, low, high``.

    The ancestors of a node are its number's leading bits, so every leaf meets the cuts above it in one join.
    """
    value = (F.col("a") / (F.col("a") + F.col("b")) / n_trees).alias("value")
    leaves = nodes.where(F.col("place").isNull()).select("tree", F.col("node").alias("leaf"), "level", value)
    up = F.transform(F.sequence(F.lit(1), F.col("level")), lambda k: F.struct(
        F.call_function("shiftright", F.col("leaf"), k).alias("node"), F.call_function("shiftright", F.col("leaf"), k - 1).bitwiseAND(1).alias("right")))
    paths = leaves.select("tree", "leaf", "value", F.inline_outer(F.when(F.col("level") > 0, up)))
    cuts = nodes.where(F.col("place").isNotNull()).select("tree", "node", "place", "cut")
    met = paths.join(cuts, ["tree", "node"], "left").groupBy("tree", "leaf", "value", "place").agg(
        F.coalesce(F.max(F.when(F.col("right") == 1, F.col("cut"))), F.lit(float("-inf"))).alias("low"),
        F.coalesce(F.min(F.when(F.col("right") == 0, F.col("cut"))), F.lit(float("inf"))).alias("high"))
    bit = F.row_number().over(Window.partitionBy("tree", "leaf").orderBy("place")) - 1
    feature = F.get(F.array(*[F.lit(f) for f in selected]), F.col("place"))
    return met.select("tree", "leaf", "value", feature.alias("feature"), bit.alias("bit"), "low", "high")


@dataclass(frozen=True)
class GrownModel:
    """One fitted tree or forest as tables; scoring collapses rows to profiles and walks each down the trees."""

    selected: tuple[str, ...]
    spec: TableSpec
    fit: int
    n_trees: int
    table: DataFrame
    trees: DataFrame
    depth: int

    @classmethod
    def of(cls, growth: Growth, fit: Fit, spec: TableSpec) -> "GrownModel":
        nodes = growth.nodes.where(F.col("fit") == fit.fit)
        depth = nodes.agg(F.max("level")).first()[0]
        return cls(tuple(spec.features[i] for i in fit.features), spec, fit.fit, fit.trees, nodes, materialize(packed_trees(nodes), "packed-trees"), depth or 0)

    @cached_property
    def nodes(self) -> list[Node]:
        """The nodes on the driver, for those who read the model itself; scoring does not."""
        return [
            Node(tree=r["tree"], node=r["node"], feature=None if r["place"] is None else self.selected[r["place"]], threshold=r["cut"],
                 left=None if r["place"] is None else 2 * r["node"], right=None if r["place"] is None else 2 * r["node"] + 1,
                 value=r["a"] / (r["a"] + r["b"]), rows=r["n"])
            for r in self.table.orderBy("tree", "node").collect()
        ]

    def conditions(self) -> DataFrame:
        """The leaves with the intervals that lead to them."""
        return box_conditions(self.table, self.selected, self.n_trees)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``phishing_probability`` and ``y_pred``; a missing value goes right."""
        rows = df.withColumn("_x", F.array(*[F.col(f).cast("double") for f in self.selected]))
        seen = rows.select(F.col("_x").alias("x")).distinct()
        copies = seen.select("x", F.lit(self.fit).alias("fit"), F.explode(F.sequence(F.lit(1), F.lit(self.n_trees))).alias("tree"))
        each = arrive(copies, self.trees, self.depth)
        found = each.groupBy(F.col("x").alias("_x")).agg(F.round(F.avg("leaf"), 12).alias("phishing_probability"))
        return rows.join(found, "_x").drop("_x").withColumn("y_pred", predicted_label(F.col("phishing_probability")))


def fit_of(family: str, params: Mapping[str, object], features: Sequence[int], *, fit: int = 0, group: int = 0, split: int = 0,
           variants: Sequence[tuple[int, int, int]] | None = None) -> Fit:
    """The fit of a classifier's parameter record (names without prefix) on chosen features."""
    if family not in FAMILIES:
        raise ValueError(f"No model family is named {family!r}; there are {list(FAMILIES)}.")
    shared = dict(fit=fit, group=group, split=split, features=tuple(features), criterion=str(params.get("criterion", "gini")), min_leaf=int(params.get("min_samples_leaf", 1)),
                  variants=tuple(variants or [(0, *limits(params))]))
    if family == FAMILIES[0]:
        return Fit(**shared)
    return Fit(**shared, trees=int(params.get("n_estimators", 100)), bootstrap=bool(params.get("bootstrap", True)),
               tried=features_tried(params.get("max_features", "sqrt"), len(features)))


def limits(params: Mapping[str, object]) -> tuple[int, int]:
    """Depth and least rows of a split node of a parameter record."""
    depth = params.get("max_depth")
    return MAX_DEPTH if depth is None else int(depth), int(params.get("min_samples_split", 2))


