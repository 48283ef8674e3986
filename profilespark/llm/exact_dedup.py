"""Exact dedup by an extendible-hash index on shared files.

The key of a text is a 64-bit hash of it without white space. The directory doubles: starting from
one bucket of all keys, every bucket that holds more bytes than its capacity is split on the next
leading bit of the key, down to ``MAX_DEPTH`` bits. What cannot be split (a key that many rows
share) gets overflow pages, dealt by doc_id. The directory is made from byte counts by leading bits,
at most 2^MAX_DEPTH numbers, so its size is bounded; capacity is a page of ``PAGE_BYTES`` or, on
larger inputs, as many bytes as keep buckets that few.

Each bucket page is a range of keys with one owner task. It receives its entries in key order,
chains the different texts of one key, comparing bytes, and writes the page: one entry per row with
its place in the chain, and the bytes once per different text. Where a bucket has several pages,
their first entries meet in a second owner, which chains them the same way. No list of doc_ids,
texts or keys is gathered on the driver, and a task holds the rows of one key in one page at most.

Rows, nulls, ties: a null text counts as empty; a null doc_id comes after all others; of rows that
agree in text and doc_id exactly one is kept. An empty table gives an empty result.
Only doc_id and text are read for the index, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.llm.common import WHITE, map_arrow, register, small_batches, table, text_of
from profilespark.session import materialize

PAGE_BYTES = 256 * 1024
MAX_DEPTH = 18

_LINK = ["bucket", "page", "key", "link"]


def keyed(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """doc_id, length of the text, and the text without white space with its key (fewer bits force collisions in tests)."""
    bare = F.translate(text_of(), WHITE, "")
    key = F.xxhash64(bare)
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.length(text_of()).alias("n_chars"), bare.alias("bare"),
        (F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits) if key_bits < 64 else key).alias("key"),
    )


def _cell(max_depth: int) -> Column:
    """The leading bits of the key; in two shifts, as a shift by 64 would be none."""
    return F.shiftrightunsigned(F.shiftrightunsigned("key", 1), 63 - max_depth).cast("int")


def directory(rows: DataFrame, page_bytes: int = PAGE_BYTES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Cells of ``max_depth`` leading key bits, each with its bucket (that bucket's smallest cell) and the bucket's pages.

    The byte counts of the cells, 2^max_depth numbers at most, are all that the doubling needs.
    """
    counts = rows.groupBy(_cell(max_depth).alias("cell")).agg(F.sum(F.octet_length("bare") + F.lit(64)).cast("long").alias("bytes")).toArrow()
    load = np.zeros(1 << max_depth, np.int64)
    cells = np.sort(counts["cell"].to_numpy())
    load[counts["cell"].to_numpy()] = counts["bytes"].to_numpy()
    capacity = max(page_bytes, int(load.sum()) * 4 >> max_depth)
    depth = np.full(load.size, max_depth)
    for bits in range(max_depth, -1, -1):  # the last that is written is the fewest bits at which the bucket fits
        held = load.reshape(1 << bits, -1).sum(axis=1)
        depth[np.repeat(held <= capacity, load.size >> bits)] = bits
    # An Arrow table, as pandas would stay in every worker that imports this module.
    found = pa.table({
        "cell": pa.array(cells, pa.int32()),
        "bucket": pa.array(cells >> (max_depth - depth[cells]) << (max_depth - depth[cells]), pa.int32()),
        "pages": pa.array(np.where(depth[cells] == max_depth, np.maximum(1, -(-load[cells] // capacity)), 1), pa.int32()),
    })
    return rows.sparkSession.createDataFrame(found)


class _Chain:
    """The different texts of one key in the order in which they came, with the rows that hold them."""

    def __init__(self):
        self.bodies: list[bytes] = []
        self.link_of: dict[bytes, int] = {}

    def place(self, body: bytes) -> tuple[int, bool]:
        """The text's link in the chain, and whether it is new. A dict of bytes compares whole texts."""
        link = self.link_of.setdefault(body, len(self.bodies))
        if link == len(self.bodies):
            self.bodies.append(body)
            return link, True
        return link, False


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of (bucket, page, key, longest text first, doc_id): the first entry of a link is its best."""
    current, chain = None, _Chain()
    for batch in small_batches(batches):
        columns = [batch.column(c).to_pylist() for c in ("bucket", "page", "key", "body")]
        links, firsts, bodies = [], [], []
        for bucket, page, key, body in zip(*columns):
            if (bucket, page, key) != current:
                current, chain = (bucket, page, key), _Chain()
            link, first = chain.place(body)
            links.append(link)
            firsts.append(first)
            bodies.append(body if first else None)
        chained = {"link": pa.array(links, pa.int32()), "first": pa.array(firsts, pa.bool_()), "body": pa.array(bodies, pa.binary())}
        names = batch.schema.names
        kept = [n for n in names if n != "body"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *chained.values()], names=[*kept, *chained])


def _owned(entries: DataFrame, schema: str, *ties: str) -> DataFrame:
    """Deals entries to the owners of their pages, in order, and chains them there."""
    order = ["bucket", "page", "key", F.desc("n_chars"), F.col("id").asc_nulls_last(), *ties]
    return map_arrow(entries.repartition("bucket", "page").sortWithinPartitions(*order), _chained, schema)


def build_index(docs: DataFrame, page_bytes: int = PAGE_BYTES, max_depth: int = MAX_DEPTH, key_bits: int = 64) -> DataFrame:
    """The index of ``docs`` on shared files: one chained entry per row."""
    rows = keyed(docs, key_bits)
    cells = materialize(directory(rows, page_bytes, max_depth), "directory")
    # 2^max_depth cells at most, whatever the input: this broadcast is bounded.
    placed = rows.withColumn("cell", _cell(max_depth)).join(F.broadcast(cells), "cell")
    page = F.pmod(F.xxhash64(F.coalesce("id", F.monotonically_increasing_id()), "n_chars"), F.col("pages")).cast("int")
    entries = placed.select(
        "bucket", page.alias("page"), "pages", "key", "id", "n_chars", F.sha2("bare", 256).alias("text_sha256"), F.encode("bare", "utf-8").alias("body"))
    schema = "bucket int, page int, pages int, key long, id long, n_chars int, text_sha256 string, link int, first boolean, body binary"
    return materialize(_owned(entries, schema), "index-pages")


def classes(index: DataFrame) -> DataFrame:
    """Per row of the index: the row that stays (keep_id), the size of its class, whether it stays, and the text's digest."""
    links = index.groupBy(*_LINK).agg(
        F.count("*").alias("n"), F.max("pages").alias("pages"), F.max(F.when(F.col("first"), F.struct("id"))).alias("best"),
        F.max("text_sha256").alias("text_sha256"))
    links = materialize(links, "index-links")
    alone = links.where("pages = 1").select(
        *_LINK, F.lit(True).alias("stays"), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), "text_sha256")
    # Buckets of several pages: each page's first entries of a text meet in a second owner.
    heads = index.where("first and pages > 1").select(*_LINK, "id", "n_chars", "body").join(links.select(*_LINK, "n", "text_sha256"), _LINK)
    heads = heads.select(
        "bucket", F.lit(0).alias("page"), "key", "id", "n_chars", F.col("page").alias("from_page"), F.col("link").alias("from_link"), "n", "text_sha256", "body")
    schema = "bucket int, page int, key long, id long, n_chars int, from_page int, from_link int, n long, text_sha256 string, link int, first boolean, body binary"
    merged = materialize(_owned(heads, schema, "from_page", "from_link").drop("body", "page"), "index-heads")
    text = ["bucket", "key", "link"]
    whole = merged.groupBy(*text).agg(F.sum("n").alias("group_size"), F.max(F.when(F.col("first"), F.struct("id"))).alias("best"))
    paged = merged.join(whole, text).select(
        "bucket", F.col("from_page").alias("page"), "key", F.col("from_link").alias("link"),
        F.col("first").alias("stays"), F.col("best.id").alias("keep_id"), "group_size", "text_sha256")
    rows = index.select(*_LINK, "id", "first").join(alone.unionByName(paged), _LINK)
    return rows.select("id", "keep_id", "group_size", (F.col("first") & F.col("stays")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns of ``docs``: of equal texts the longest, then the smallest doc_id.

    Rows that agree in doc_id and text are told apart by their place among rows of the same doc_id.
    """
    same = [F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("known_id"), "text_sha256"]
    key = ["no_id", "known_id", "text_sha256"]
    stays = classes(build_index(docs)).where("kept").select(*same).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.length(text_of()).alias("n_chars"), F.sha2(F.translate(text_of(), WHITE, ""), 256).alias("text_sha256"),
    ).select("row", "n_chars", *same)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("n_chars"), F.xxhash64("row")))
    return rows.withColumn("nth", nth).where("nth = 1").join(stays, key, "left_semi").select("row.*")


@register("op2_exact_dedup", """
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS b FROM documents
), classes AS (
  SELECT doc_id, b, first_value(doc_id) OVER (PARTITION BY b ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY b) AS group_size FROM bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(b) AS text_sha256 FROM classes
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the document that stays for its text, and how many share the text."""
    return classes(build_index(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")
