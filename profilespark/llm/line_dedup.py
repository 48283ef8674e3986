"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A run is a bucketed, sorted table in the shared folder: line hash, in how many documents the
batch holds it, the largest doc_id, and whether this run is the first to hold it. A new batch of
documents is aggregated to its own lines (map-side first, so a line of a third of all documents
is one row per task), merge-joined with the runs on their buckets without shuffling them again,
and added as a run of level 0: ``first`` marks the lines that the anti-join found in no run.
When a level holds ``FAN_OUT`` runs, they are merged into one of the next level. Counts add up
and maxima combine over runs in any order, so the totals do not depend on batches or compaction
(nor on ``first``, which tells new lines from known ones for those who feed batches).

Line hashes have 128 bits. Rows, nulls, ties: a null or empty text is one empty line; rows are
separate documents even if they share a doc_id, and all rows with the largest doc_id keep the
line; a null doc_id is less than any other, and where all holders are null, all keep it. An
empty table gives an empty result. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from profilespark.llm.common import WHITE, register, table, text_of
from profilespark.session import materialize, scratch_path

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches that the registered query feeds one after the other, and runs of a level that are merged into one.
BATCHES = 4
FAN_OUT = 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["hash_1", "hash_2"]


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("hash_1"), F.xxhash64(F.lit("second"), key).alias("hash_2")]


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, place (from 0) and hash of every line of a document that is long enough.

    ``first`` marks one line of each hash in a document. Places are sorted by hash within the row.
    """
    keys = F.transform(F.split(F.translate(text_of(), _UPPER, _LOWER), "\n"), lambda x: F.btrim(x, F.lit(WHITE)))
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("text_hash"), keys.alias("keys"))
    at = F.filter(F.transform("keys", lambda x, i: F.when(F.length(x) >= min_chars, F.struct(*_hashes(x), i.alias("place")))), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "text_hash", F.sort_array(at).alias("at"))
    before = lambda i: F.get("at", i - 1)
    marked = F.transform("at", lambda x, i: F.struct(
        x["hash_1"].alias("hash_1"), x["hash_2"].alias("hash_2"), x["place"].alias("place"),
        ((i == 0) | (before(i)["hash_1"] != x["hash_1"]) | (before(i)["hash_2"] != x["hash_2"])).alias("first")))
    return rows.select("doc_id", "text_hash", F.inline(marked))


class LineRuns:
    """The runs of one corpus: a folder of bucketed tables and the list of them by level."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []

    def _write(self, run: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        run.repartition(self.buckets, *_HASH).write.format("parquet").option("path", scratch_path(self.spark, name)) \
            .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Takes the runs out of the catalog; nothing may read them afterwards. Their files go with the application."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels, self.names = [], []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of long lines: joins them, once per document, with every run, then writes them as a run of their own."""
        batch = lines.where("first").groupBy(*_HASH).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        known = F.lit(False)
        for k, run in enumerate(self.runs):
            batch = batch.join(run.where("first").select(*_HASH, F.lit(True).alias(f"in_{k}")), _HASH, "left")
            known = known | F.coalesce(F.col(f"in_{k}"), F.lit(False))
        run = self._write(batch.select(*_HASH, "n_docs", "max_doc", (~known).alias("first")))
        self._place(run, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            merged = self._write(self._merged(self.levels[level]))
            self.levels[level] = []
            self._place(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One row per line: merge joins of the runs on their buckets, each line once per run.

        Not a union with an aggregate: Spark 4.1 takes a union of bucketed tables for dealt out by the
        buckets and skips the shuffle, but does not always read the same buckets together.
        """
        merged = runs[0].select(*_HASH, "n_docs", "max_doc", "first")
        for run in runs[1:]:
            other = run.select(*_HASH, F.col("n_docs").alias("n_2"), F.col("max_doc").alias("max_2"), F.col("first").alias("first_2"))
            merged = merged.join(other, _HASH, "full").select(
                *_HASH, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_2", F.lit(0))).alias("n_docs"),
                F.greatest("max_doc", "max_2").alias("max_doc"),  # passes over nulls
                (F.coalesce("first", F.lit(False)) | F.coalesce("first_2", F.lit(False))).alias("first"))
        return merged

    def totals(self) -> DataFrame:
        """Every line seen so far: in how many documents, and the largest doc_id."""
        return self._merged(self.runs)


def dedup_lines(docs: DataFrame, lines: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """Every document with the lines it keeps joined again: doc_id, n_lines, n_dropped, kept_text.

    ``lines`` are the long lines of ``docs`` as added to the runs, in one batch or several. A document meets the places of its dropped lines, and keeps all others in time linear in its lines.
    """
    # Written, so that the join below deals out both sides itself and Spark can split a line of very many documents.
    common = materialize(runs.totals().where(F.col("n_docs") >= min_docs).select(*_HASH, "max_doc"), "common-lines")
    elsewhere = F.col("max_doc").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("max_doc")))
    drops = lines.join(common, _HASH).where(elsewhere)
    # Rows that share doc_id and text drop the same places.
    drops = drops.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(F.collect_set("place").alias("drops"))
    texts = docs.select("doc_id", text_of().alias("text"), F.xxhash64(text_of()).alias("text_hash"))
    both = texts.join(drops, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    both = both.withColumn("lines", F.when(F.col("drops").isNotNull(), F.split("text", "\n")))
    stays = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops")), lambda i: F.get("lines", i))
    both = both.select("doc_id", "text", F.when(F.col("drops").isNotNull(), stays).alias("stays"))
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    return both.select(
        "doc_id", n_lines.alias("n_lines"),
        F.when(F.col("stays").isNull(), F.lit(0)).otherwise(n_lines - F.size("stays")).cast("bigint").alias("n_dropped"),
        F.when(F.col("stays").isNull(), F.col("text")).otherwise(F.array_join("stays", "\n")).alias("kept_text"),
    )


def batches(docs: DataFrame, n: int = BATCHES) -> tuple[DataFrame, list[DataFrame]]:
    """The long lines of all documents, written once, and the same as batches by ranges of doc_id."""
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    width = max(1, -(-(hi - lo + 1) // n))
    batch = F.coalesce(F.floor((F.col("doc_id") - lo) / width), F.lit(0)).cast("int")
    lines = materialize(long_lines(docs).withColumn("batch", batch), "lines", ["batch"])
    return lines.drop("batch"), [lines.where(F.col("batch") == k).drop("batch") for k in range(n)]


@register("op7_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, unnest(list) AS line, unnest(range(len(list))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS list FROM documents)
), keyed AS (
  SELECT *, trim(translate(line, '{_UPPER}', '{_LOWER}'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS max_doc FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), marked AS (
  SELECT k.*, (c.key IS NOT NULL AND k.doc_id < c.max_doc) AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 characters or more that five documents hold stay only in the largest doc_id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines, parts = batches(docs)
    runs = LineRuns(spark)
    for part in parts:
        runs.add(part)
    kept = dedup_lines(docs, lines, runs)
    runs.drop()  # what the result needs of them is written
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
