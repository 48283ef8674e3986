"""Interventional Shapley values of tree models.

For a leaf with value v, a sample x and a background row z, let A be the path
features only x satisfies and B those only z satisfies. If every path feature is
satisfied by one of them, each feature of A gains (|A|-1)! |B|! / (|A|+|B|)! v
and each feature of B loses |A|! (|B|-1)! / (|A|+|B|)! v; averaged over the
background this is the exact Shapley value.

Which path features a row satisfies is a bit mask per leaf. Rows are collapsed to distinct profiles. A tree is one
row that holds the intervals of all its leaves, so a profile finds its masks of a whole tree in place, and no table of
conditions is joined by feature. Distinct (tree, leaf, mask) meet one row per leaf, with the background's masks of
that leaf as an array of at most as many entries as there are background rows; their number is bounded by the model
and the background, not by the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from profilespark.functions.exprs import direction
from profilespark.operators.trees import Node, leaf_conditions, used_features
from profilespark.session import materialize
from profilespark.spec import POSITIVE, TableSpec

# One bit each in a 64-bit mask.
MAX_PATH_FEATURES = 62


def leaf_rows(conditions: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per leaf with a path: ``tree, leaf, value, path``, the path's intervals (place of the feature, low, high] by bit."""
    place = (F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1).cast("int")
    interval = F.struct("bit", place.alias("place"), "low", "high")
    return conditions.where("feature is not null").groupBy("tree", "leaf", "value").agg(F.sort_array(F.collect_list(interval)).alias("path"))


def _masks(profiles: DataFrame, leaves: DataFrame, trees: Sequence[int]) -> DataFrame:
    """One row per (profile, leaf) with the bits of the path features it satisfies; a missing value satisfies none."""
    packed = leaves.groupBy("tree").agg(F.collect_list(F.struct("leaf", "path")).alias("leaves"))
    numbers = F.split(F.lit(",".join(map(str, trees))), ",").cast("array<int>")
    bit = lambda c, k: F.when((F.get("x", c["place"]) > c["low"]) & (F.get("x", c["place"]) <= c["high"]), F.call_function("shiftleft", F.lit(1).cast("bigint"), k)).otherwise(F.lit(0).cast("bigint"))
    mask = lambda path: F.aggregate(F.transform(path, bit), F.lit(0).cast("bigint"), lambda a, m: a.bitwiseOR(m))
    each = F.transform("leaves", lambda leaf: F.struct(leaf["leaf"].alias("leaf"), mask(leaf["path"]).alias("mask")))
    return profiles.withColumn("tree", F.explode(numbers)).join(packed, "tree").select("_profile", "_n", "tree", F.inline(each))


def _met() -> Column:
    """The background masks of a leaf that together with ``mask`` satisfy its path, and what either side gains or loses a feature."""
    # As doubles: the built-in factorial ends at 20, a path may test more features.
    products = F.array(*[F.lit(float(math.factorial(i))) for i in range(MAX_PATH_FEATURES + 1)])
    factorial = lambda n: F.get(products, n)
    mask = F.col("mask")
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.size("path")) - 1

    def met(z: Column) -> Column:
        x_bits, z_bits = mask.bitwiseAND(F.bitwise_not(z["mask"])), z["mask"].bitwiseAND(F.bitwise_not(mask))
        a, b = F.bit_count(x_bits), F.bit_count(z_bits)
        gain, loss = factorial(a - 1) * factorial(b) / factorial(a + b), factorial(a) * factorial(b - 1) / factorial(a + b)
        return F.struct(x_bits.alias("x"), z_bits.alias("z"), (gain * z["weight"]).alias("gain"), (loss * z["weight"]).alias("loss"))

    return F.transform(F.filter("base", lambda z: (mask.bitwiseOR(z["mask"]) == full) & (mask != z["mask"])), met)


def _part(c: Column, k: Column) -> Column:
    """What the k-th path feature of a leaf contributes to rows of a mask, summed over the background masks it met."""
    has = lambda bits: F.call_function("shiftright", bits, k).bitwiseAND(1) != 0
    one = lambda m: F.when(has(m["x"]), m["gain"]).when(has(m["z"]), -m["loss"]).otherwise(0.0)
    return F.struct(c["place"].alias("place"), (F.aggregate("met", F.lit(0.0), lambda s, m: s + one(m)) * F.col("value")).alias("share"))


def _profiles(df: DataFrame, features: list[str]) -> DataFrame:
    digest = F.md5(F.to_json(F.array(*[F.col(f) for f in features])))  # a missing value is a value of its own
    counted = df.select(*[F.col(f).cast("double") for f in features]).groupBy(*features).agg(F.count(F.lit(1)).alias("_n"))
    return counted.withColumn("_profile", digest)


def shapley_by_profile(samples: DataFrame, background: DataFrame, conditions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Contributions of every used feature for every distinct sample profile, one row per profile."""
    leaves = materialize(leaf_rows(conditions, features), "leaf-rows")
    trees = sorted(r["tree"] for r in leaves.select("tree").distinct().collect())  # one number per tree
    sample_profiles, base_profiles = _profiles(samples, features), _profiles(background, features)
    packed = lambda profiles: profiles.select("_profile", "_n", F.array(*features).alias("x"))
    masks = materialize(_masks(packed(sample_profiles), leaves, trees).drop("_n"), "shapley-masks")
    base = _masks(packed(base_profiles), leaves, trees).groupBy("tree", "leaf", "mask").agg(F.sum("_n").alias("weight"))
    base = base.groupBy("tree", "leaf").agg(F.collect_list(F.struct("mask", "weight")).alias("base"))
    of_leaf = materialize(leaves.join(base, ["tree", "leaf"]), "shapley-leaves")
    met = masks.select("tree", "leaf", "mask").distinct().join(of_leaf, ["tree", "leaf"]).withColumn("met", _met()).where(F.size("met") > 0)
    per_mask = materialize(met.select("tree", "leaf", "mask", F.transform("path", _part).alias("parts")), "shapley-parts")
    n_background = background.count()
    each = masks.join(per_mask, ["tree", "leaf", "mask"]).select("_profile", F.inline("parts"))
    wide = each.groupBy("_profile").pivot("place", list(range(len(features)))).agg(F.sum("share"))
    scaled = wide.select("_profile", *[(F.col(f"`{n}`") / F.lit(float(n_background))).alias(f"phi_{f}") for n, f in enumerate(features)])
    found = sample_profiles.drop("_n").join(scaled, "_profile", "left").drop("_profile")
    return found.withColumns({f"phi_{f}": F.coalesce(f"phi_{f}", F.lit(0.0)) for f in features})


def explained_rows(samples: DataFrame, background: DataFrame, nodes: Sequence[Node] | DataFrame, spec: TableSpec,
                   selected: Sequence[str] | None = None) -> DataFrame:
    """Key and features of every sample row with its ``contributions``, an array of
    ``(feature, feature_value, shap_value)`` over the selected features.

    ``nodes`` is a model as a list of nodes or as its table of leaf conditions. Selected features the model
    never splits on contribute exactly 0. One row per sample, so ranking and summing need no further shuffle.
    """
    if isinstance(nodes, DataFrame):
        conditions = nodes
        features = sorted(r["feature"] for r in nodes.select("feature").where("feature is not null").distinct().collect())  # one row per feature
    else:
        conditions, features = leaf_conditions(nodes, samples.sparkSession), used_features(nodes)
    selected = list(spec.features if selected is None else selected)
    rows = samples.select(spec.key, *spec.features)
    if features:
        by_profile = shapley_by_profile(samples, background, conditions, features)
        renamed = by_profile.withColumnsRenamed({f: f"_p_{f}" for f in features})
        same = [F.col(f).cast("double").eqNullSafe(F.col(f"_p_{f}")) for f in features]
        # One profile row per sample: adaptive execution broadcasts the profiles when
        # they are measured small and splits a hot profile otherwise.
        rows = rows.join(renamed, same).drop(*[f"_p_{f}" for f in features])
    cells = [
        F.struct(
            F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"),
            (F.col(f"phi_{f}") if f in features else F.lit(0.0)).alias("shap_value"),
        )
        for f in selected
    ]
    return rows.select(spec.key, *spec.features, F.array(*cells).alias("contributions"))


def shapley_contributions(explained: DataFrame, spec: TableSpec) -> DataFrame:
    """``row key, feature, feature_value, shap_value`` for every sample row and selected feature."""
    return explained.select(spec.key, F.inline("contributions"))


def contribution_table(explained: DataFrame, spec: TableSpec) -> DataFrame:
    """Contributions with absolute value, direction and rank within the sample.

    Sums that cancel up to the last bits count as no effect.
    """
    def order(c: Column) -> Column:
        return F.struct(-F.round(F.abs(c["shap_value"]), 12), c["feature"], c["feature_value"], c["shap_value"])

    ranked = F.array_sort(F.transform("contributions", order))
    value = F.col("_c.shap_value")
    return explained.select(spec.key, F.posexplode(ranked).alias("_position", "_c")).select(
        spec.key,
        (F.col("_position") + 1).alias("rank"),
        F.col("_c.feature").alias("feature"),
        F.col("_c.feature_value").alias("feature_value"),
        value.alias("shap_value"),
        F.abs(value).alias("absolute_shap_value"),
        direction(F.round(value, 12)).alias("direction"),
    )


def explanation_summary(explained: DataFrame, background: DataFrame, score: Callable[[DataFrame], DataFrame],
                        spec: TableSpec) -> DataFrame:
    """Prediction, base value, sum of contributions and additivity error per sample.

    ``score`` adds ``phishing_probability`` and ``y_pred`` to rows with the features.
    """
    base = score(background).agg(F.avg("phishing_probability").alias("base_value"), F.count(F.lit(1)).alias("background_size"))
    total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["shap_value"])
    rows = score(explained).select(
        spec.key, F.col("phishing_probability").alias("explained_phishing_probability"), "y_pred",
        total.alias("sum_of_shap_values"), F.lit(0).alias("_k"),
    ).join(F.broadcast(base.withColumn("_k", F.lit(0))), "_k")  # one row
    rebuilt = F.col("base_value") + F.col("sum_of_shap_values")
    return rows.select(
        spec.key,
        F.col("y_pred").alias("predicted_class"),
        F.lit(POSITIVE).alias("explained_class"),
        "explained_phishing_probability", "base_value", "sum_of_shap_values",
        rebuilt.alias("reconstructed_probability"),
        F.abs(rebuilt - F.col("explained_phishing_probability")).alias("absolute_additivity_error"),
        "background_size",
    )
