"""Document fingerprints by one-permutation MinHash with optimal densification, in DataFrame functions only.

A text is the set of its five-word shingles. Each shingle is hashed once; the leading bits of the hash
choose one of ``BINS`` bins, and a bin keeps its least hash. A bin without a shingle borrows: it follows a
fixed sequence of bins of its own, a 2-universal hash of (bin, attempt), to the first that has one
(A. Shrivastava, "Optimal Densification for Fast and Accurate Minwise Hashing", 2017), so two sets borrow
alike as far as their bins are filled alike. A fingerprint packs the low ``BITS`` bits of every bin. Two
fingerprints agree in a bin with probability J + (1 - J) / 2^BITS, which the estimate of the similarity J is
corrected for (P. Li, A. C. König, "b-Bit Minwise Hashing", 2010).

All of it is expressions on the row, in time proportional to the text. The first filled bin in a sequence is
looked for in the first ``ATTEMPTS`` places; where they are all empty, or ``FEW`` bins are filled at most (in texts
of few shingles), the filled bin that comes first in the sequence is chosen by its place there, which is the same bin.

Rows, nulls, ties: a null text is empty; a text without words has the empty fingerprint, which is like another
empty one (1) and unlike any other (0); a text of one to four words is one shingle; repeated rows
have equal fingerprints; an empty table gives an empty result. Only doc_id and text are read, so other
columns cannot clash.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.llm.common import register, table, text_of, words_of
from profilespark.session import materialize

SHINGLE = 5
#: Bins (a power of two) and packed bits of each (4: a digit of the hexadecimal fingerprint).
BIN_BITS, BITS = 9, 4
BINS = 1 << BIN_BITS
#: Places of a bin's sequence that are tried before the filled bins are ranked.
ATTEMPTS = 64
#: Filled bins that are ranked at once, as that is less work than trying places.
FEW = 10
#: The sequence of bin j is (START[j] + STEP[j] t) mod PRIME for t = 0, 1, ...; a prime over BINS, so it visits every bin.
PRIME = 521
_RNG = random.Random(12)
START = [_RNG.randrange(PRIME) for _ in range(BINS)]
STEP = [_RNG.randrange(1, PRIME) for _ in range(BINS)]
#: STEP inverted modulo PRIME: bin i stands at (i - START[j]) BACK[j] mod PRIME in the sequence of bin j.
BACK = [pow(s, -1, PRIME) for s in STEP]

#: Rows that a bucket of consecutive documents holds on average, and the most buckets there are.
ROWS_A_BUCKET = 2_048
MAX_BUCKETS = 65_536


#: Low bits of a hash below those of its bin; all of them set marks the end of a bin.
_REST = 64 - BIN_BITS
_END = (1 << _REST) - 1
#: Digits of a fingerprint in one 64-bit number.
_DIGITS = 64 // BITS


def _fixed(values: list[int], kind: str = "int") -> Column:
    """A literal array of any length, as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _shingle_hashes(words: str) -> Column:
    """Hashes of all runs of five words, given the hashes of the words."""
    starts = F.slice(words, F.lit(1), F.size(words) - SHINGLE + 1)
    return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, SHINGLE)]))


def _bin(h: Column) -> Column:
    return F.shiftright(h, _REST)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the packed fingerprint of a text column: an array of 64-bit numbers, null for a text without words.

    Each step is a column of its own or the value of ``_let``, so that no array is built anew per element.
    """
    words, hashes, bins = (f"{name}_{c}" for c in ("words", "sorted", "bins"))
    rows = rows.withColumn(words, F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w)))
    # A text of fewer words is one shingle, of all its words.
    few = F.array(F.aggregate(words, F.lit(42).cast("long"), lambda a, w: F.xxhash64(a, w)))
    shingles = F.when(F.size(words) >= SHINGLE, _shingle_hashes(words)).otherwise(few)
    # The end of each bin is sorted along, so every bin has a least value; an empty bin's is its end. The sequences (of
    # bins below 0 and from 0) hold no null, which lets Spark sort plain numbers.
    ends = [F.sequence(F.lit(_END - (1 << 63)), F.lit(-1).cast("bigint"), F.lit(1 << _REST)), F.sequence(F.lit(_END), F.lit((1 << 63) - 1), F.lit(1 << _REST))]
    rows = rows.withColumn(hashes, F.when(F.size(words) > 0, F.sort_array(F.concat(shingles, *ends)))).drop(words)
    # Before the first hash stands null, which is in no bin.
    least = F.filter(hashes, lambda h, i: ~_bin(h.bitwiseXOR(F.get(hashes, i - 1))).eqNullSafe(0))
    rows = rows.withColumn(bins, _let(F.transform(least, lambda h: F.when(h.bitwiseAND(_END) != _END, h)), _filled_up)).drop(hashes)
    digit = lambda a, h: F.shiftleft(a, BITS).bitwiseOR(h.bitwiseAND((1 << BITS) - 1))
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // _DIGITS - 1)), lambda w: F.aggregate(
        F.slice(bins, w * _DIGITS + 1, _DIGITS), F.lit(0).cast("bigint"), digit))
    return rows.withColumn(name, F.when(F.col(bins).isNotNull(), packed)).drop(bins)


def _filled_up(bins: Column) -> Column:
    """The bins, each empty one (null) with the value that it borrows."""
    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(bins, i).isNotNull())
    return _let(filled, lambda f: F.transform(bins, lambda h, j: F.coalesce(h, _borrowed(bins, f, j))))


def _borrowed(bins: Column, filled: Column, j: Column) -> Column:
    """The value of the first filled bin in an empty bin's sequence."""
    tried = [F.get(bins, F.get(_fixed([(a + b * t) % PRIME for a, b in zip(START, STEP)]), j)) for t in range(ATTEMPTS)]
    start, back = F.get(_fixed(START), j), F.get(_fixed(BACK), j)
    ranked = F.transform(filled, lambda i: F.pmod((i - start) * back, F.lit(PRIME)) * BINS + i)
    first = F.get(bins, F.pmod(F.array_min(ranked), F.lit(BINS)))
    return F.when(F.size(filled) <= FEW, first).otherwise(F.coalesce(*tried, first))


def fingerprint_text(packed: Column) -> Column:
    """The fingerprint in hexadecimal, empty for a text without words."""
    return F.array_join(F.transform(F.coalesce(packed, F.array().cast("array<bigint>")), lambda x: F.lpad(F.lower(F.hex(x)), _DIGITS, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the Jaccard similarity of two texts' shingles by their packed fingerprints, corrected for chance."""
    ones = sum(1 << (BITS * k) for k in range(_DIGITS))

    def agreeing(x: Column, y: Column) -> Column:
        differ = x.bitwiseXOR(y)
        for k in (1 << n for n in range(BITS.bit_length() - 1)):  # the lowest bit of a digit collects the others
            differ = differ.bitwiseOR(F.shiftrightunsigned(differ, k))
        return _DIGITS - F.bit_count(differ.bitwiseAND(ones))

    agree = F.aggregate(F.zip_with(a, b, agreeing), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    estimate = F.greatest(F.lit(0.0), (agree / F.lit(BINS) - chance) / (1 - chance))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(estimate)


# The next document


_BUCKET = ["bucket", "part"]
#: Parts that the rows of one doc_id are dealt to where it fills whole buckets, by the leading bits of the text's hash.
_PARTS = 256


def _cuts(docs: DataFrame, rows_a_bucket: int) -> tuple[list[int], list[int]]:
    """Existing doc_ids that begin buckets, at most MAX_BUCKETS, and those of them that fill a bucket on their own."""
    n = docs.count()
    k = min(MAX_BUCKETS, max(1, -(-n // rows_a_bucket)))
    found = docs.select(F.percentile_approx("doc_id", _fixed([j / k for j in range(1, k)], "double"), max(10_000, 20 * k)).alias("cuts")).first()[0] if k > 1 else None
    found = found or []
    return sorted(set(found)), sorted({a for a, b in zip(found, found[1:]) if a == b})


def _bucketed(docs: DataFrame, cuts: list[int], hot: list[int]) -> DataFrame:
    """Adds the bucket and part of every row: in their order, rows stand by doc_id (null first) and hash of the text."""
    width = 256
    heads = _fixed(cuts[::width], "bigint")
    blocks = F.transform(F.split(F.lit(";".join(",".join(map(str, cuts[i:i + width])) for i in range(0, len(cuts), width))), ";"),
                         lambda x: F.split(x, ",").cast("array<bigint>"))
    upto = lambda a: F.size(F.filter(a, lambda c: c <= F.col("doc_id")))
    rows = docs.withColumn("block", upto(heads) if cuts else F.lit(0))
    bucket = F.when(F.col("doc_id").isNull(), -1).when(F.col("block") == 0, 0).otherwise((F.col("block") - 1) * width + upto(F.get(blocks, F.col("block") - 1)))
    rows = rows.withColumn("bucket", bucket.cast("int") if cuts else F.when(F.col("doc_id").isNull(), -1).otherwise(0)).drop("block")
    dealt = F.col("doc_id").isNull() | F.coalesce(F.array_contains(_fixed(hot, "bigint"), F.col("doc_id")), F.lit(False))
    # A doc_id that fills buckets is a cut, so the others of its bucket are larger and come after all of its parts.
    return rows.withColumn("part", F.when(dealt, F.shiftright("hash", 56).cast("int")).otherwise(_PARTS))


def with_next(docs: DataFrame, carried: list[str], rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """Adds ``next_{c}`` of every carried column: its value in the document that follows by doc_id, after the last the first's.

    Rows (doc_id, text, ...) are dealt to buckets of consecutive doc_ids, in one shuffle; the first row of each bucket is
    dealt to the bucket before as well. Rows of one doc_id follow by the hash of the text.
    """
    ids = docs.select("doc_id")
    cuts, hot = _cuts(ids, rows_a_bucket)
    keys = _bucketed(docs.select("doc_id", F.xxhash64("text").alias("hash")), cuts, hot)
    firsts = materialize(keys.groupBy(*_BUCKET).agg(F.min(F.struct("doc_id", "hash")).alias("first")), "bucket-firsts")
    # One row per bucket, of which there are at most MAX_BUCKETS and _PARTS for each doc_id that fills one.
    line, every = Window.orderBy(*_BUCKET), Window.partitionBy()
    here = F.struct(*_BUCKET)
    before = F.coalesce(F.lag(here).over(line), F.max(here).over(every))
    firsts = firsts.select(*_BUCKET, F.col("first.doc_id").alias("first_id"), F.col("first.hash").alias("first_hash"), before.alias("before"))
    rows = _bucketed(docs.withColumn("hash", F.xxhash64("text")), cuts, hot).join(F.broadcast(firsts), _BUCKET)
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash"))
    own = F.struct(F.col("bucket"), F.col("part"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("before.bucket").alias("bucket"), F.col("before.part").alias("part"), F.lit(True).alias("guest"))
    rows = rows.withColumn("at", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))))
    rows = rows.select(*docs.columns, "hash", "at.*")
    following = Window.partitionBy(*_BUCKET).orderBy("guest", "doc_id", "hash")
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(following) for c in carried})
    return rows.where(~F.col("guest")).select(*docs.columns, *[f"next_{c}" for c in carried])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text (whole, never null) and its packed fingerprint."""
    return with_fingerprint(docs.select("doc_id", text_of().alias("text")), "text", "fingerprint")


@register("op12_document_fingerprints")
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and their likeness to each other and to the next document."""
    rows = with_next(fingerprints(table(spark, sf_dir, "documents")), ["text", "fingerprint"])
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint")
    own = F.col("fingerprint")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint_text(own).alias("fingerprint"),
        fingerprint_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"), likeness(own, F.col("next_fingerprint")).alias("near_next"))
