"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from profilespark.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of ``links`` (a, b).

    In each round every node points at its smallest neighbour, or itself, and every link is moved to
    where its ends point. Links within a node vanish, so the nodes that still have links shrink by
    half or more; the pointers of all rounds are then followed. Rounds are written to the shared
    folder. A node with very many links is one row per task before the shuffle.
    """
    links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")), "pointers")
        if roots is None:
            roots = points
        else:
            step = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = materialize(roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        moved = links
        for end in ("a", "b"):
            moved = moved.join(points.select(F.col("node").alias(end), F.col("root").alias(f"{end}_to")), end)
        moved = moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).where("a < b").distinct()
        links = materialize(moved, "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots
