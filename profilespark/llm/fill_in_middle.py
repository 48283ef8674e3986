"""Fill-in-the-middle rearrangement of documents, as a pipeline of ``pyarrow.compute`` kernels.

A text is cut into units: a word with the white space before it, or white space at the end. A batch of
texts is split into a list array of units, which is flattened with the index of each unit's text; a unit's
ordinal within its text gives its role (prefix, middle or suffix), units are filtered by role, lists are
rebuilt from the counts of each role, and ``binary_join`` makes pieces and outputs. All of it runs on bytes:
the separator between units is a byte that UTF-8 never holds, so no text can clash with it.

Where a document is cut, and in which form it leaves, follows from a hash of the seed and its doc_id alone,
so reruns, retried tasks and other partitionings give the same output. Work is narrow; a task holds a
batch of at most ``BATCH_BYTES`` of texts, or one longer text.

Rows, nulls, ties: a null text is empty; an empty text has no units and stays as it is, as does a text that
holds a marker (it could not be told apart from an inserted one); a null doc_id hashes as the empty string;
rows that share a doc_id are drawn alike, each as a row; an empty table gives an empty result. Only doc_id
and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.llm.common import map_arrow, register, table, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of 100 documents, how many are rearranged, and of 100 of those, how many have the suffix first.
RATE, SUFFIX_FIRST = 50, 80

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: A byte that is in no UTF-8 text.
_BETWEEN = b"\xff"
_NOTHING = pa.scalar(b"", pa.large_binary())
BATCH_BYTES = 16 << 20

PLAIN, PSM, SPM = "plain", "psm", "spm"
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def by_bytes(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of texts of at most ``most`` bytes together; a longer text comes alone."""
    for batch in batches:
        start, held = 0, 0
        for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _mod(x: pa.Array, divisor: pa.Array | int) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, divisor), divisor))


def _rebuilt(units: pa.Array, role: pa.Array, counts: pa.Array) -> pa.Array:
    """The units of a role as one binary per text; ``counts`` says how many each text has."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units.filter(role)), _NOTHING)


def pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Number of units of every text, and its prefix, middle and suffix (binary).

    The cuts are ``first`` and ``second`` modulo the number of units and one; the prefix ends at the smaller.
    """
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), pattern=f"({UNIT})", replacement=rb"\1" + _BETWEEN)
    split = pc.split_pattern(marked, pattern=_BETWEEN)  # an empty piece stands behind the last unit
    n = pc.subtract(pc.list_value_length(split).cast(pa.int64()), 1)
    one, two = _mod(first, pc.add(n, 1)), _mod(second, pc.add(n, 1))
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    units, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    starts = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(range(len(units)), pa.int64()), starts.take(parent))
    low_here, high_here = low.take(parent), high.take(parent)
    prefix = _rebuilt(units, pc.less(ordinal, low_here), low)
    middle = _rebuilt(units, pc.and_(pc.greater_equal(ordinal, low_here), pc.less(ordinal, high_here)), pc.subtract(high, low))
    suffix = _rebuilt(units, pc.and_(pc.greater_equal(ordinal, high_here), pc.less(ordinal, n.take(parent))), pc.subtract(n, high))
    return n, prefix, middle, suffix


def _forms(texts: pa.Array, third: pa.Array, fourth: pa.Array, rate: int, suffix_first: int) -> pa.Array:
    stays = pc.or_(pc.equal(pc.binary_length(texts), 0), pc.greater_equal(_mod(third, 100), rate))
    for marker in (PREFIX, SUFFIX, MIDDLE):
        stays = pc.or_(stays, pc.match_substring(texts, marker))
    moved = pc.if_else(pc.less(_mod(fourth, 100), suffix_first), SPM, PSM)
    return pc.if_else(stays, PLAIN, moved)


def rearranged(batch: pa.RecordBatch, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> pa.RecordBatch:
    """The outputs of a batch of (doc_id, text, h1, h2, h3, h4)."""
    texts = batch.column("text")
    h1, h2, h3, h4 = (batch.column(f"h{k}") for k in range(1, 5))
    form = _forms(texts, h3, h4, rate, suffix_first)
    n, prefix, middle, suffix = pieces(texts, h1, h2)
    mark = {m: pa.scalar(m.encode(), pa.large_binary()) for m in (PREFIX, SUFFIX, MIDDLE)}
    psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, _NOTHING)
    spm = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, _NOTHING)
    plain = pc.equal(form, PLAIN)
    output = pc.if_else(plain, texts.cast(pa.large_binary()), pc.if_else(pc.equal(form, PSM), psm, spm))
    chars = lambda piece: pc.if_else(plain, None, pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), n, form, chars(prefix), chars(middle), output.cast(pa.large_string()).cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _draws(seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars (null if plain) and the output text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *_draws(seed))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            yield rearranged(batch, rate, suffix_first)

    return map_arrow(rows, found, _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts that hold a marker are plain, so every marker was inserted."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda k: F.get(parts, F.lit(k))
    prefix = F.when(form == PSM, part(1)).otherwise(part(2))
    suffix = F.when(form == PSM, part(2)).otherwise(part(1))
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, part(3), suffix))


@register("op11_fill_in_middle", f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNIT}') AS u,
         sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), draws AS (
  SELECT *, len(u) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN '{PLAIN}'
              WHEN h4 % 100 < {SUFFIX_FIRST} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM draws
), cut AS (
  SELECT *, coalesce(array_to_string(u[1:low], ''), '') AS p, coalesce(array_to_string(u[low + 1:high], ''), '') AS m,
         coalesce(array_to_string(u[high + 1:n], ''), '') AS s
  FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN length(p) END AS prefix_chars, CASE WHEN form <> '{PLAIN}' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN text WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, form and pieces of every document, with digests of its output and of the text rebuilt from it."""
    rows = fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
