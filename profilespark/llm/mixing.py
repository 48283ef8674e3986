"""Mixing sources to target weights: systematic sampling with repeats, in DataFrame functions only.

Every document of a source is expected ``target / source_size`` times. Documents stand in
line by size, the expected copies are summed along the line, one random offset per source is
added, and a document is emitted once per whole number that its stretch of the line crosses.
Neighbours in the line have similar sizes, so a source's taken words differ from its target by
about one document at most.

Places in the line are exact without any window over a source: a place is the number of
documents of smaller sizes, plus those in earlier buckets of two digits of a hash of doc_id,
plus the place within the last bucket. Each of these counts is a window over at most 256
counts (or over the different sizes of a source), so a source or a size that holds a third of
all rows is dealt out like any other.

Rows, nulls, ties: a null text has size 0 and is never taken for words; a null source is a
source of its own, ordered last; a null doc_id hashes as the empty string; repeated rows are
separate documents. A source whose documents are all empty has target 0 and is emitted 0 times.
An empty table gives an empty result. Further columns never clash: rows are carried as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.llm.common import register, table, text_of, words_of
from profilespark.session import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often, so no source's target exceeds so many times its size.
MOST = 3
SEED = "mix-1"

_SOURCE = ["no_source", "source_name"]
_CELL = [*_SOURCE, "size", "digit_1", "digit_2"]


def _sized(docs: DataFrame, carried: Column) -> DataFrame:
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        carried.alias("row"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source"), F.lit("")).alias("source_name"),
        F.size(words_of(text_of())).cast("bigint").alias("size"),
        digest.alias("digest"),
        F.substring(digest, 1, 2).alias("digit_1"),
        F.substring(digest, 3, 2).alias("digit_2"),
        F.col("doc_id").alias("id"),
    )


def _before(counts: DataFrame, within: list[str], order: str, name: str) -> DataFrame:
    """Adds how many documents stand before each row of counts, among the rows that agree in `within`."""
    line = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn(name, F.sum("n").over(line) - F.col("n"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: its size, target words, expected copies of a document and random offset.

    Targets are ``min(level * weight, most * size)`` where one level makes them sum to all sizes: what
    capping and resharing by weight ends in. With the sources ordered by ``most * size / weight``, those
    before some place are capped, and the level follows from the sums on either side of it. ``sizes`` has
    one row per source (no_source, source_name, source_size), so the windows over it hold the mix's
    definition and never documents.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("no_source", "source_name"))
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", share.cast("bigint")).withColumn("cap", F.col("source_size") * most)
    line = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "source_name")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumns({
        "all_sizes": F.sum("source_size").over(everything),
        "rest": F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"),
        "capped": F.sum("cap").over(upto) - F.col("cap"),
    })
    # The level if exactly the sources before this one are capped; the first that its own source does not exceed holds.
    level = (F.col("all_sizes") - F.col("capped")) / F.col("rest")
    fits = level <= F.col("cap") / F.col("weight")
    ranked = ranked.withColumn("level", F.min(F.when(fits, F.struct(F.col("capped"), level.alias("level")))).over(everything)["level"])
    target = F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double"))
    chance = F.md5(F.concat(F.lit(SEED + "|"), F.col("no_source").cast("string"), F.lit("|"), F.col("source_name")))
    return ranked.select(
        *_SOURCE, "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
        (F.conv(F.substring(chance, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)).alias("offset"),
    )


def _places(rows: DataFrame) -> DataFrame:
    """Per cell (source, size, two digits): how many documents stand before it, and its source's figures."""
    cells = rows.groupBy(*_CELL).agg(F.count("*").alias("n"))
    wide = cells.groupBy(*_CELL[:4]).agg(F.sum("n").alias("n"))
    sizes = wide.groupBy(*_CELL[:3]).agg(F.sum("n").alias("n"))
    sources = source_targets(sizes.groupBy(*_SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size")))
    by_size = _before(sizes, _SOURCE, "size", "before_size").drop("n")
    by_first = _before(wide, _CELL[:3], "digit_1", "before_first").drop("n")
    by_second = _before(cells, _CELL[:4], "digit_2", "before_second").drop("n")
    joined = by_second.join(by_first, _CELL[:4]).join(by_size, _CELL[:3]).join(sources, _SOURCE)
    before = F.col("before_size") + F.col("before_first") + F.col("before_second")
    return joined.select(*_CELL, before.alias("before"), "source_size", "target", "rate", "offset")


def mixing_copies(docs: DataFrame, carried: Column | None = None) -> DataFrame:
    """Every row of ``docs`` with its source's figures and the number of copies that the mix takes.

    The carried columns travel as the struct ``row`` in the only shuffle that whole rows go through.
    """
    narrow = materialize(_sized(docs, F.lit(None).cast("int")).drop("row"), "mix-sizes")
    rows = narrow.withColumn("row", F.struct(F.col("id").alias("doc_id"))) if carried is None else _sized(docs, carried)
    place = F.row_number().over(Window.partitionBy(*_CELL).orderBy("digest", "id")) - 1
    placed = rows.withColumn("place", place).join(_places(narrow), _CELL)
    start = F.col("before") + F.col("place")
    crossed = F.floor((start + 1) * F.col("rate") + F.col("offset")) - F.floor(start * F.col("rate") + F.col("offset"))
    copies = F.least(crossed, F.lit(MOST).cast("bigint"))
    return placed.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents: each row as often as it is taken, with the columns of ``docs``."""
    taken = mixing_copies(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return taken.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")


@register("op10_mixing", f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([1, 2, 3])[((row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), line AS (
  SELECT *, {MOST} * source_size AS cap, sum(source_size) OVER () AS all_sizes,
         sum(weight) OVER () - sum(weight) OVER o + weight AS rest,
         sum({MOST} * source_size) OVER o - {MOST} * source_size AS capped
  FROM sources WINDOW o AS (ORDER BY {MOST} * source_size / weight::DOUBLE, source IS NULL, source COLLATE "binary" ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT (all_sizes - capped)::DOUBLE / rest::DOUBLE AS level FROM line
  WHERE (all_sizes - capped)::DOUBLE / rest::DOUBLE <= cap::DOUBLE / weight ORDER BY capped LIMIT 1
), targets AS (
  SELECT source, source_size, least(level * weight, cap::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN least(level * weight, cap::DOUBLE) / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}|' || CASE WHEN source IS NULL THEN 'true' ELSE 'false' END || '|' || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS off
  FROM line, level
), placed AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, md5(doc_id::VARCHAR), doc_id) - 1 AS place FROM sized
)
SELECT doc_id, size, source_size, target,
       size * least({MOST}, (floor((place + 1) * rate + off) - floor(place * rate + off))::BIGINT) AS taken
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
""")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words that the mix takes of it."""
    copies = mixing_copies(table(spark, sf_dir, "documents"))
    return copies.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
