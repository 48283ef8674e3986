"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of a document, of its characters by class and of its common words, are compared
with those of all documents of its language by the Jensen-Shannon distance (base 2, 0 to 1).
Words are common if they make at least one in ``COMMON_SHARE`` of a language's words, so a
language has at most that many; a language is a reference if it has ``REFERENCE_WORDS`` words,
whatever share of all words they are. References are joined without a hint, so they are broadcast
only while they are measured small. References count every word of every document. Documents of
fewer than ``MIN_WORDS`` words, or of a language without a reference, are not judged by distance
(the minimum-length guards).

Counts on a document are expressions on its row: no words are shuffled but the counts of those that
may be common, by the counts of ``BUCKETS`` hash buckets a language.

Rows, nulls, ties: a null text has no words; a null lang is a language of its own; repeated rows
are judged alike, each as a row; an empty table gives an empty result. Only doc_id, text and lang
are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.llm.common import WHITE, count_of, register, table, text_of, words_of
from profilespark.session import materialize

MIN_WORDS = 50
REFERENCE_WORDS = 5_000
COMMON_SHARE = 500
#: Words of a language are first counted in so many buckets: one whose bucket is rarer than a common word is not common.
BUCKETS = 4096
#: Common words are looked up by a hash, in so many small maps a language.
MAPS = 64
#: Documents farther from their language than this are not kept.
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.47

#: Base rules.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Character classes beside white space, symbols and the rest (letters).
DIGITS = "0123456789"
PUNCTUATION = "!\"'(),-./:;?@[]^_`{}~+=\\"


def _count_among(text: Column, characters: str) -> Column:
    """How many characters are among some that are rare, so that runs of others are skipped as a whole."""
    escaped = "".join(c if c.isalnum() else "\\" + c for c in characters)
    return F.length(F.regexp_replace(text, f"[^{escaped}]+", "")).cast("bigint")


def _repeated_words(words: str) -> Column:
    """Words that lie in a window found twice or more in the text, the first one included."""
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def _covered(windows: str) -> Column:
    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), ranked)


def _places_of_repeats(ranked: str) -> Column:
    here = lambda i: F.get(ranked, i)["h"]
    again = F.filter(ranked, lambda x, i: (x["h"] == here(i - 1)) | (x["h"] == here(i + 1)))
    return F.sort_array(F.transform(again, lambda x: x["i"]))


def _union_of_windows(places: str) -> Column:
    steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def _counts(docs: DataFrame) -> DataFrame:
    """Words and the base counts. Each step is a column of its own, so that no array is built anew per element."""
    text = text_of()
    rows = docs.select(
        "doc_id", F.col("lang").isNull().alias("no_lang"), F.coalesce("lang", F.lit("")).alias("language"),
        text.alias("text"), words_of(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("lines"),
    )
    rows = rows.withColumns({
        "n_words": F.size("words").cast("bigint"),
        "n_chars": F.length("text").cast("bigint"),
        "n_white": count_of(F.col("text"), WHITE),
        "n_symbols": _count_among(F.col("text"), SYMBOLS),
        "n_digits": _count_among(F.col("text"), DIGITS),
        "n_punctuation": _count_among(F.col("text"), PUNCTUATION),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "windows": _repeated_words("words"),
    })
    rows = rows.withColumn("ranked", _covered("windows")).drop("windows")
    rows = rows.withColumn("places", F.when(F.col("ranked").isNotNull(), _places_of_repeats("ranked"))).drop("ranked")
    covered = F.when(F.col("places").isNotNull(), _union_of_windows("places")).otherwise(0)
    rows = rows.withColumn("n_repeat_words", covered.cast("bigint"))
    return rows.withColumn("word_chars", F.col("n_chars") - F.col("n_white"))


def _classes() -> Column:
    named = ["n_white", "n_symbols", "n_digits", "n_punctuation"]
    rest = F.col("n_chars")
    for c in named:
        rest = rest - F.col(c)
    return F.array(*named, rest)


_LANG = ["no_lang", "language"]


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _words(texts: DataFrame, *beside: str) -> DataFrame:
    """Every word in lower case: set apart first, then lowered, so that both run in generated code."""
    return texts.select(*_LANG, *beside, F.explode(words_of(text_of())).alias("word")).withColumn("word", F.lower("word"))


def _vocabulary(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How often the words occur that may be common, and how many words each reference language has.

    A word is at most as frequent as its bucket, so only words of buckets that could hold a common one
    are counted by themselves: the others, nearly all of a vocabulary, are never shuffled.
    """
    texts = docs.select(F.col("lang").isNull().alias("no_lang"), F.coalesce("lang", F.lit("")).alias("language"), "text")
    by_bucket = _words(texts).groupBy(*_LANG, _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n"))
    buckets = materialize(by_bucket, "word-buckets")
    totals = buckets.groupBy(*_LANG).agg(F.sum("n").alias("total")).where(F.col("total") >= REFERENCE_WORDS)
    # Written first, so that its measured size decides how it is joined; so are the flags, BUCKETS a language.
    totals = materialize(totals, "vocabulary-totals")
    frequent = buckets.join(totals, _LANG).where(F.col("n") * COMMON_SHARE >= F.col("total"))
    frequent = frequent.groupBy(*_LANG).agg(F.collect_list("bucket").alias("buckets"))
    flags = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda b: F.array_contains("buckets", b))
    frequent = materialize(frequent.select(*_LANG, flags.alias("frequent")), "frequent-buckets")
    words = _words(texts.join(frequent, _LANG), "frequent").where(F.get("frequent", _bucket(F.col("word"))))
    return materialize(words.groupBy(*_LANG, "word").agg(F.count("*").alias("n")), "vocabulary"), totals


def common_words(docs: DataFrame) -> DataFrame:
    """Per reference language: its common words in order, and how often each occurs."""
    counts, totals = _vocabulary(docs)
    joined = counts.join(totals, _LANG).where(F.col("n") * COMMON_SHARE >= F.col("total"))
    listed = joined.groupBy(*_LANG, "total").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("common"))
    listed = listed.withColumn("entries", F.transform("common.word", lambda w, k: F.struct(w.alias("word"), (k + 1).alias("number"))))
    in_map = lambda m: lambda e: _map(e["word"]) == m
    maps = F.array(*[F.map_from_entries(F.filter("entries", in_map(m))) for m in range(MAPS)])
    return listed.select(
        *_LANG, F.col("common.word").alias("common"),
        F.concat(F.col("common.n"), F.array(F.col("total") - F.aggregate("common.n", F.lit(0).cast("bigint"), lambda a, x: a + x))).alias("word_counts"),
        F.col("total").alias("word_total"), maps.alias("number_of"),
        F.array_max(F.transform("common.word", lambda w: F.octet_length(w))).alias("longest"),
    )


def _map(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(MAPS)).cast("int")


def _run_ends(ordered: str) -> Column:
    """Last places (from 1) of the runs of equal numbers in a sorted array."""
    places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: (i == F.size(ordered)) | (F.get(ordered, i - 1) != F.get(ordered, i)))


def _word_runs() -> Column:
    """How often each common word that occurs in the document does, by number, and all other words under the number after the last."""
    run = lambda e, j: F.struct(F.get("ordered", e - 1).alias("number"), (e - F.when(j > 0, F.get("ends", j - 1)).otherwise(0)).cast("bigint").alias("n"))
    other = F.struct((F.size("common") + 1).alias("number"), (F.size("words") - F.size("ordered")).cast("bigint").alias("n"))
    return F.concat(F.transform("ends", run), F.array(other))


def _shares(counts: str, total: str) -> Column:
    """``total`` is a column: an expression would be summed anew for every bin."""
    return F.transform(counts, lambda x: x.cast("double") / F.col(total))


def _distance(a: str, b: str) -> Column:
    """Jensen-Shannon distance of two distributions over the same bins."""
    gain = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    parts = lambda x, y: (gain(x, (x + y) / 2) + gain(y, (x + y) / 2)) / 2
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(a, b, parts), F.lit(0.0), lambda s, x: s + x)))


def _sparse_distance(runs: str, total: str, reference: str) -> Column:
    """The same distance where only bins that occur are listed: an absent one adds half of its reference share."""
    gain = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    share = lambda r: r["n"].cast("double") / F.col(total)
    usual = lambda r: F.get(reference, r["number"] - 1)
    part = lambda r: F.struct(((gain(share(r), (share(r) + usual(r)) / 2) + gain(usual(r), (share(r) + usual(r)) / 2)) / 2).alias("d"), usual(r).alias("q"))
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q"))
    add = lambda s, x: F.struct((s["d"] + x["d"]).alias("d"), (s["q"] + x["q"]).alias("q"))
    return F.aggregate(F.transform(runs, part), start, add, lambda s: F.sqrt(F.greatest(F.lit(0.0), s["d"] + (1 - s["q"]) / 2)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with the base counts, both distances (null where not judged) and the verdict."""
    # A row of COMMON_SHARE words at most per language: written first, so that its measured size decides how it is joined.
    words = materialize(common_words(docs), "common-words")
    rows = _counts(docs).join(words, _LANG, "left")
    short = F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: F.octet_length(w) <= F.col("longest"))
    numbers = F.filter(F.transform(short, lambda w: F.try_element_at(F.get("number_of", _map(w)), w)), lambda k: k.isNotNull())
    rows = rows.withColumn("ordered", F.sort_array(F.coalesce(numbers, F.array().cast("array<int>"))))
    rows = rows.withColumn("ends", _run_ends("ordered"))
    judged = F.col("common").isNotNull() & (F.col("n_words") >= MIN_WORDS)
    features = materialize(rows.select(
        "doc_id", *_LANG, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", judged.alias("judged"),
        "n_chars", _classes().alias("classes"), F.when(judged, _word_runs()).alias("runs"),
    ), "quality-features")
    sums = F.array(*[F.sum(F.get("classes", F.lit(k))) for k in range(5)])
    references = features.groupBy(*_LANG).agg(sums.alias("class_counts"), F.sum("n_chars").alias("class_total"))
    references = references.join(words.select(*_LANG, "word_counts", "word_total"), _LANG).select(
        *_LANG, _shares("class_counts", "class_total").alias("class_reference"), _shares("word_counts", "word_total").alias("word_reference"))
    rows = features.join(materialize(references, "language-references"), _LANG, "left")
    rows = rows.withColumn("class_shares", _shares("classes", "n_chars"))
    rows = rows.withColumns({
        "char_distance": F.when(F.col("judged"), F.round(_distance("class_shares", "class_reference"), 6)),
        "word_distance": F.when(F.col("judged"), F.round(_sparse_distance("runs", "n_words", "word_reference"), 6)),
    })
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    far = (F.col("char_distance") > MAX_CHAR_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"), "char_distance", "word_distance",
    )


_SQL_PUNCTUATION = PUNCTUATION.replace("'", "''")
_SQL_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_JS = """sqrt(greatest(0, list_sum(list_transform(list_zip({a}, {b}), lambda z: (
  (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END)
  + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END)) / 2))))"""


@register("op4_quality_rules", f"""
WITH base AS (
  SELECT doc_id, lang IS NULL AS no_lang, coalesce(lang, '') AS language, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), counted AS (
  SELECT doc_id, no_lang, language, len(words) AS n_words, length(text) AS n_chars,
         length(text) - length(translate(text, {_SQL_WHITE}, '')) AS n_white,
         length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
         length(text) - length(translate(text, '{DIGITS}', '')) AS n_digits,
         length(text) - length(translate(text, '{_SQL_PUNCTUATION}', '')) AS n_punctuation,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM base
), placed AS (
  SELECT doc_id, no_lang, language, unnest(words) AS w, unnest(range(len(words))) AS i FROM base
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w, w1, w2, w3, w4) AS copies FROM (
    SELECT doc_id, i, w, lead(w, 1) OVER d AS w1, lead(w, 2) OVER d AS w2, lead(w, 3) OVER d AS w3, lead(w, 4) OVER d AS w4
    FROM placed WINDOW d AS (PARTITION BY doc_id ORDER BY i)
  ) WHERE w4 IS NOT NULL
), repeats AS (
  SELECT doc_id, sum(least(5, coalesce(lead_i - i, 5))) AS n_repeat_words FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS lead_i FROM windows WHERE copies > 1
  ) GROUP BY doc_id
), vocabulary AS (
  SELECT no_lang, language, lower(w) AS word, count(*) AS n FROM placed GROUP BY ALL
), totals AS (
  SELECT * FROM (SELECT no_lang, language, sum(n) AS total FROM vocabulary GROUP BY ALL)
  WHERE total >= {REFERENCE_WORDS}
), common AS (
  SELECT no_lang, language, word, n, total FROM vocabulary JOIN totals USING (no_lang, language) WHERE n * {COMMON_SHARE} >= total
), reference AS (
  SELECT no_lang, language, list(word ORDER BY word) AS common, list(n ORDER BY word) AS n, total - sum(n) AS other FROM common GROUP BY no_lang, language, total
), found AS (
  SELECT p.doc_id, c.word, count(*) AS n FROM placed p JOIN common c ON p.no_lang = c.no_lang AND p.language = c.language AND lower(p.w) = c.word GROUP BY ALL
), histograms AS (
  SELECT d.doc_id, list(coalesce(f.n, 0) ORDER BY c.word) AS h, any_value(d.n_words) - coalesce(sum(f.n), 0) AS other
  FROM counted d JOIN common c USING (no_lang, language) LEFT JOIN found f ON f.doc_id = d.doc_id AND f.word = c.word GROUP BY d.doc_id
), classes AS (
  SELECT no_lang, language, [sum(n_white), sum(n_symbols), sum(n_digits), sum(n_punctuation), sum(n_chars - n_white - n_symbols - n_digits - n_punctuation)] AS c
  FROM counted GROUP BY ALL
), shares AS (
  SELECT d.*, list_transform([n_white, n_symbols, n_digits, n_punctuation, n_chars - n_white - n_symbols - n_digits - n_punctuation], lambda x: x::DOUBLE / n_chars) AS cp,
         list_transform(k.c, lambda x: x::DOUBLE / list_sum(k.c)) AS cq,
         list_transform(list_append(h.h, h.other), lambda x: x::DOUBLE / d.n_words) AS wp,
         list_transform(list_append(r.n, r.other), lambda x: x::DOUBLE / (list_sum(r.n) + r.other)) AS wq,
         coalesce(x.n_repeat_words, 0) AS n_repeat_words, r.common IS NOT NULL AND d.n_words >= {MIN_WORDS} AS judged
  FROM counted d LEFT JOIN reference r USING (no_lang, language) LEFT JOIN histograms h USING (doc_id)
  LEFT JOIN classes k USING (no_lang, language) LEFT JOIN repeats x USING (doc_id)
), judged AS (
  SELECT *, CASE WHEN judged THEN round({_JS.format(a='cp', b='cq')}, 6) END AS char_distance,
         CASE WHEN judged THEN round({_JS.format(a='wp', b='wq')}, 6) END AS word_distance,
         n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed
  FROM shares
)
SELECT doc_id, n_words, n_chars - n_white AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(char_distance > {MAX_CHAR_DISTANCE} OR word_distance > {MAX_WORD_DISTANCE}, false) AS kept,
       char_distance, word_distance
FROM judged
""")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    return quality_rules(table(spark, sf_dir, "documents"))
