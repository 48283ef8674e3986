"""The pipeline's stages against brute force, and as a whole."""

from __future__ import annotations

import collections
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from profilespark.llm import exact_dedup, mixing
from profilespark.llm.common import map_arrow
from tests.llm.tables import documents, frame, odd_rows
from tests.llm.test_operators import brute_classes

FILTERS = dict(corpus_pipeline.STAGES[:4])


def run_stage(spark, name, rows, clashing=True):
    return dict(corpus_pipeline.STAGES)[name](spark, frame(spark, rows, clashing), "")


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing sources", "packing"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_tables(name, spark):
    assert run_stage(spark, name, []).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_do_not_crash(name, spark):
    got = run_stage(spark, name, odd_rows())
    if name in FILTERS:
        assert got.columns == frame(spark, [], True).columns
    assert got.count() > 0


def test_language_stage_drops_texts_without_language(spark):
    kept = {r.doc_id for r in run_stage(spark, "language ID", documents()).collect()}
    assert not kept & {105, 106, 107, 108} and set(range(40)) <= kept


def test_exact_stage_keeps_the_longest(spark):
    rows = documents()
    kept = sorted(r.doc_id for r in run_stage(spark, "exact dedup", rows).collect())
    best = {}
    for doc_id, text, *_ in rows:
        body = "".join((text or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"}))
        best[body] = min(best.get(body, (1, 0)), (-len(text or ""), doc_id))
    assert kept == sorted(i for _, i in best.values())


def test_near_stage_keeps_one_of_each_class(spark):
    kept = sorted(r.doc_id for r in run_stage(spark, "MinHash near-dedup", documents()).collect())
    assert kept == sorted(i for i, c in brute_classes(documents()).items() if i == c)


def test_mixing_stage_repeats_documents(spark):
    rows = documents()
    copies = {r.row.doc_id: r.copies for r in mixing.mixing_copies(frame(spark, rows)).collect()}
    got = collections.Counter(r.doc_id for r in run_stage(spark, "mixing sources", rows).collect())
    assert got == {k: n for k, n in copies.items() if n}


def test_whole_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    once = {r.doc_id: r.text for r in docs.collect()}
    ids = {p.doc_id for p in pieces}
    assert ids <= set(once)
    # Equal texts are there once, and each document's tokens as often as it is taken.
    kept = exact_dedup.classes(exact_dedup.build_index(docs)).where("kept").select("id").collect()
    assert ids <= {r.id for r in kept}
    tokens, whole = collections.Counter(), {}
    for p in pieces:
        tokens[p.doc_id] += p.length
        whole[p.doc_id] = p.doc_tokens
    assert all(tokens[i] % whole[i] == 0 and tokens[i] // whole[i] <= 3 for i in ids)
    single = [p for p in pieces if tokens[p.doc_id] == whole[p.doc_id]]
    assert len(single) > 10
    assert corpus_pipeline.ORACLE_SQL is None and docs.where(F.col("doc_id").isNull()).count() == 0


def _hoarding(batches):
    """Frees 60 MB below something that stays; tells its process and its memory at start and end."""
    import os

    import pyarrow as pa

    def kb():
        return next(int(line.split()[1]) for line in open("/proc/self/status") if line.startswith("RssAnon"))

    for batch in batches:
        start = kb()
        held = [bytes(2_000) for _ in range(30_000 * batch.column("n")[0].as_py())]
        if held:
            pa.stays = bytes(2_000)
        del held
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (os.getpid(), start, kb())], names=["pid", "start", "end"])


def test_a_worker_gives_back_what_a_task_freed(spark):
    """Workers wait beside the executor's heap until the next stage needs them."""
    schema = "pid long, start long, end long"
    hoarder = map_arrow(spark.range(1, 2, 1, 1).select(F.col("id").alias("n")), _hoarding, schema).collect()[0]
    assert hoarder.end > hoarder.start + 30_000
    later = map_arrow(spark.range(0, 96, 1, 96).select(F.lit(0).alias("n")), _hoarding, schema).collect()
    found = [r.start for r in later if r.pid == hoarder.pid]
    assert found and max(found) < hoarder.start + (hoarder.end - hoarder.start) / 2


def test_workers_of_the_index_do_not_load_pandas():
    code = "import sys, profilespark.llm.exact_dedup; sys.exit('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}).returncode == 0
