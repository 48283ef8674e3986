"""Token counts as delta-maintained rollups.

Documents are counted once, where they lie. Every batch of changes becomes signed rows per document
and tokenizer version: an insert adds its counts, a delete takes away what the committed batches hold
for the document, a revised count does both. The batch's sums by source, language and tokenizer
version are written next to them, and the totals of the corpus are the sums of those sums.

A batch is committed by the success marker that Spark writes last, when all tasks of the second table
are done. A batch that was interrupted is not read and is overwritten when it comes again; one that
was committed is left alone, so delivering it twice changes nothing. Sums are exact integers and
do not depend on the order of batches.

Rows, nulls, ties: a null text has no tokens but counts as a document; null sources and languages
are groups of their own; a row with a null doc_id can be inserted but not deleted or revised; rows that share
a doc_id are separate documents when inserted and change together; deleting or revising what
is not there does nothing or inserts. An empty batch is committed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.llm.common import map_arrow, register, small_batches, table, text_of, words_of
from profilespark.llm.tokens import WORD_BPE, word_ids
from profilespark.session import materialize, scratch_path

WORDS = "words-1"
WORD_BPE_49K = "word-bpe-49k-1"
#: Batches that the registered query delivers one after the other.
BATCHES = 4

GROUP = ["source", "lang", "tokenizer"]
_SUMS = ["n_docs", "n_tokens"]


def count_tokens(docs: DataFrame, tokenizer: str = WORD_BPE) -> DataFrame:
    """doc_id, source, lang, tokenizer version and tokens: a row per document and version."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer)
        for batch in small_batches(batches):
            n = [len(ids) // 4 for ids in encode(batch.column("text").to_pylist())]
            names = ["doc_id", "source", "lang", "n_words"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int64())], names=[*names, "n_bpe"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.size(words_of(text_of())).cast("long").alias("n_words"), text_of().alias("text"))
    rows = map_arrow(rows, counted, "doc_id long, source string, lang string, n_words long, n_bpe long")
    versions = F.array(
        F.struct(F.lit(WORDS).alias("tokenizer"), F.col("n_words").alias("n_tokens")),
        F.struct(F.lit(WORD_BPE_49K).alias("tokenizer"), F.col("n_bpe").alias("n_tokens")))
    return rows.select("doc_id", "source", "lang", F.inline(versions))


class TokenRollup:
    """The rollup of a folder: ``ledger/<batch>`` holds signed rows per document, ``totals/<batch>`` their sums."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or scratch_path(spark, "token-rollup")

    def _store(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = path(self.folder)
        return path, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Batches with a success marker, in order of their names."""
        path, store = self._store()
        root = path(f"{self.folder}/totals")
        if not store.exists(root):
            return []
        names = [s.getPath().getName() for s in store.listStatus(root)]
        return sorted(n for n in names if store.exists(path(f"{self.folder}/totals/{n}/_SUCCESS")))

    def _read(self, kind: str) -> DataFrame:
        key = "doc_id long, " if kind == "ledger" else ""
        schema = f"{key}source string, lang string, tokenizer string, n_docs long, n_tokens long"
        batches = self.committed()
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{kind}/{b}" for b in batches])

    def current(self, ids: DataFrame) -> DataFrame:
        """What the committed batches hold for some documents (a table of doc_id)."""
        rows = self._read("ledger").join(ids.distinct(), "doc_id", "left_semi")
        return rows.groupBy("doc_id", *GROUP).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("n_docs <> 0 or n_tokens <> 0")

    def commit(self, batch: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None, revised: DataFrame | None = None) -> bool:
        """Applies a batch unless it is committed already; returns whether it was applied.

        ``inserts`` and ``revised`` have doc_id, source, lang, tokenizer and n_tokens; ``deletes`` has doc_id.
        """
        if batch in self.committed():
            return False
        columns = ["doc_id", *GROUP, *_SUMS]
        signed = self.spark.createDataFrame([], "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long")
        added = lambda rows: rows.withColumn("n_docs", F.lit(1).cast("long")).select(*columns)
        taken = lambda rows: rows.withColumns({c: -F.col(c) for c in _SUMS}).select(*columns)
        if inserts is not None:
            signed = signed.unionByName(added(inserts))
        if deletes is not None:
            signed = signed.unionByName(taken(self.current(deletes.select("doc_id"))))
        if revised is not None:
            old = self.current(revised.select("doc_id")).join(revised.select("doc_id", "tokenizer").distinct(), ["doc_id", "tokenizer"], "left_semi")
            signed = signed.unionByName(taken(old)).unionByName(added(revised))
        ledger = f"{self.folder}/ledger/{batch}"
        signed.write.mode("overwrite").parquet(ledger)
        rows = self.spark.read.schema(signed.schema).parquet(ledger)
        rows.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in _SUMS]).write.mode("overwrite").parquet(f"{self.folder}/totals/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        sums = self._read("totals").groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in _SUMS])
        return sums.where("n_docs <> 0 or n_tokens <> 0")


@register("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all documents, which arrive in batches by doc_id; the last one is delivered twice.

    The first range arrives with drafts of its counts, which are revised; the second is deleted and inserted again.
    """
    docs = table(spark, sf_dir, "documents")
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    batch = F.coalesce(F.floor((F.col("doc_id") - lo) * BATCHES / (hi - lo + 1)), F.lit(0)).cast("int")
    counts = materialize(count_tokens(docs).withColumn("batch", batch), "token-counts", ["batch"])
    parts = [counts.where(F.col("batch") == k).drop("batch") for k in range(BATCHES)]
    known = F.col("doc_id").isNotNull()  # others cannot be revised
    drafts = parts[0].withColumn("n_tokens", F.when(known, F.floor(F.col("n_tokens") / 2)).otherwise(F.col("n_tokens")))
    rollup = TokenRollup(spark)
    for k, rows in [*enumerate([drafts, *parts[1:]]), (BATCHES - 1, parts[-1])]:
        rollup.commit(f"load-{k}", inserts=rows)
    rollup.commit("revise-0", revised=parts[0].where(known))
    rollup.commit("unload-1", deletes=parts[1].select("doc_id"))
    rollup.commit("unload-1-again", inserts=parts[1])
    return rollup.totals()
