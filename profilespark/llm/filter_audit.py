"""Filter interaction audit: what five filters remove in every order, and their Shapley values.

Each document becomes a mask of the filters that it fails; masks are counted per part, before and in the
only shuffle of counts. From the mask counts the 32 coalitions of filters are tabulated: how many documents
(all, good ones, toxic ones) a coalition removes. Every step of every order is a difference of two coalitions.

Shapley values solve the constrained least squares problem that defines them: of all additive games, the one
nearest to the coalition table under the Shapley kernel whose sum is what all filters remove. Its normal
equations with the constraint are the same for all parts, so they are solved once, in rationals, for every
coalition as right-hand side; times 120 (the orders) the solution is whole numbers, which
expressions apply to the coalition tables of all parts.

A text is identical to another by SHA-256. Rows are narrowed to (doc_id, part, mask, digest) and written; the
smallest doc_id of each repeated digest meets them by a join that splits hot digests.

Rows, nulls, ties: a null text is empty, a null source is the part ''; a null doc_id has no smaller one, is no
one's smaller one and has no label; rows that share doc_id and text are not each other's duplicates; a
document with several labels is good (toxic) if one of them says so. An empty table gives an empty result.
Only doc_id, text and source are read, so other columns cannot clash.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.llm.common import register, table, text_of, words_of
from profilespark.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = "#$%&*|"
DUPLICATE = 1 << FILTERS.index("E")


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails filters A to D, in order."""
    n, length = F.size(words), F.length(text)
    return [
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MAX_CAPITAL_PERCENT * length,
        text.rlike("[" + "".join("\\" + c for c in SYMBOLS) + "]"),
    ]


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and the mask of failed filters (bit 0: the first) of every document."""
    texts = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_of().alias("text"))
    texts = texts.withColumn("words", words_of(F.col("text")))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(text_failures(F.col("text"), F.col("words")))]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    narrow = materialize(texts.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "audit-rows")
    # Written, so that its measured size decides the join, and a digest of very many rows can be split.
    first = narrow.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    first = materialize(first.where("rows > 1").select("digest", "first"), "audit-repeats")
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return narrow.join(first, "digest", "left").select("doc_id", "part", (F.col("mask") + F.when(again, DUPLICATE).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask: documents, good ones and toxic ones."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    marks = materialize(marks.where("good + toxic > 0"), "audit-labels")
    rows = masks.join(marks, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def coalition_table(counts: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """Per part: documents, and as arrays by coalition (bit k: filter k) what it removes of all, good and toxic ones."""
    size = 1 << n_filters
    removed = lambda c, s: F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0))
    tables = [F.array(*[removed(c, s) for s in range(size)]).alias(name) for c, name in (("n", "v"), ("good", "v_good"), ("toxic", "v_toxic"))]
    return counts.groupBy("part").agg(F.sum("n").alias("documents"), *tables)


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with matrix X = right, by elimination in rationals."""
    n = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    for k in range(n):
        pivot = next(i for i in range(k, n) if rows[i][k] != 0)
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k] != 0:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k])]
    return [row[n:] for row in rows]


def shapley_weights(n: int = len(FILTERS)) -> list[list[int]]:
    """Per filter the factors of the coalitions' values that give n! times its Shapley value.

    Minimises sum_S w(S) (v(S) - sum_{i in S} phi_i)^2 over phi with sum phi = v(all) - v(none), where
    w(S) = (n - 1) / (C(n, |S|) |S| (n - |S|)) for all S but none and all: the stationary point with one
    multiplier, for each unit vector of values as right-hand side.
    """
    size = 1 << n
    held = [[s >> i & 1 for i in range(n)] for s in range(size)]
    kernel = [Fraction(n - 1, comb(n, sum(z)) * sum(z) * (n - sum(z))) if 0 < sum(z) < n else Fraction(0) for z in held]
    # With n = 1 the constraint alone decides; any positive diagonal keeps the equations regular.
    normal = [[sum((kernel[s] * held[s][i] * held[s][j] for s in range(size)), Fraction(int(n == 1))) for j in range(n)] + [Fraction(1)] for i in range(n)]
    matrix = [*normal, [Fraction(1)] * n + [Fraction(0)]]
    right = [[kernel[s] * held[s][i] for s in range(size)] for i in range(n)]
    right.append([Fraction((s == size - 1) - (s == 0)) for s in range(size)])
    whole = [[x * factorial(n) for x in row] for row in solve(matrix, right)[:n]]
    assert all(x.denominator == 1 for row in whole for x in row)
    return [[int(x) for x in row] for row in whole]


def interaction_audit(coalitions: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the coalition tables."""
    n = len(filters)
    everything = (1 << n) - 1
    steps = []
    for order in permutations(range(n)):
        done = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(filters[i] for i in order), step, k, done, done | 1 << k, everything & ~(1 << k)))
            done |= 1 << k
    weighted = [F.aggregate(F.zip_with("v", F.array(*[F.lit(x).cast("long") for x in row]), lambda v, x: v * x), F.lit(0).cast("long"), lambda a, x: a + x)
                for row in shapley_weights(n)]
    # The n! n steps are fixed by the number of filters: every part is dealt all of them.
    listed = F.lit(";".join(",".join(map(str, s)) for s in steps))
    rows = coalitions.withColumn("values", F.array(*weighted)).withColumn("s", F.explode(F.split(listed, ";"))).withColumn("s", F.split("s", ","))
    numbers = {c: F.get("s", F.lit(k)).cast("int") for k, c in enumerate(("step", "filter", "before", "after", "others"), 1)}
    rows = rows.withColumns({"filter_order": F.get("s", F.lit(0)), **numbers})
    change = lambda table: F.get(table, F.col("after")) - F.get(table, F.col("before"))
    return rows.select(
        "part", "filter_order", "step", (F.col("documents") - F.get("v", F.col("after"))).alias("kept"), change("v").alias("removed"),
        (F.get("v", F.expr("shiftleft(1, filter)")) - change("v")).alias("redundant"),
        (F.get("v", F.lit(everything)) - F.get("v", F.col("others"))).alias("unique_fails"),
        change("v_good").alias("good_lost"), change("v_toxic").alias("toxic_lost"), F.get("values", F.col("filter")).alias("shapley"))


_LETTERS = "(VALUES " + ", ".join(f"('{c}', {1 << k})" for k, c in enumerate(FILTERS)) + ")"


@register("op13_filter_audit", f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n,
         CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[{SYMBOLS}]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS fails
  FROM docs LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters(c, b) AS (SELECT * FROM {_LETTERS} AS t(c, b)
), orders AS (
  SELECT l1.c || l2.c || l3.c || l4.c || l5.c AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits
  FROM letters l1, letters l2, letters l3, letters l4, letters l5 WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31 AND l1.b | l2.b | l3.b | l4.b | l5.b = 31
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS done FROM orders, range(1, 6) AS r(step)
), counted AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN fails & (done | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails & done = 0 AND fails & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails & done <> 0 AND fails & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fails & done = 0 AND fails & bit <> 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fails & done = 0 AND fails & bit <> 0 THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
""")
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every part, order and step, with its Shapley value times the orders."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return interaction_audit(coalition_table(mask_counts(failure_masks(docs), labels)))
