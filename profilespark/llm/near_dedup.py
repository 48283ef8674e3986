"""MinHash near-dedup with DartMinHash sketches.

Documents are weighted sets of five-word shingles, weighted by how often they occur. A sketch of
``BANDS * ROWS`` coordinates is cut into bands; documents that agree in a band are candidates. A pair
of similarity 0.8 is missed by all bands with a probability of about 0.0001, more similar ones
far more rarely. Candidates are compared exactly, by the weighted Jaccard similarity of their whole
texts, and linked from ``MIN_SIMILARITY`` on. Classes are the connected components of the links.

Copies (texts of the same words) are collapsed first and stand for one text. Within a band's bucket
not all pairs are compared: every text is compared with the bucket's smallest doc_id. Texts of buckets
that then still hold several components meet again by their rarest shingles: two texts of similarity
0.8 share one among the rarest fifth of either, early enough to leave room for all that they must
share (the prefix and position filters of exact set joins), so only texts of different components
that share one so are compared. No bucket is capped, and no link between
components is lost that the bands found.

Texts are read once more for the candidates only: a Bloom filter of fixed size over the candidates' doc_ids lets
their texts through where they are read, so no text is shuffled that is not to be compared.

Rows, nulls, ties: a document without a word, or with a null text or doc_id, is a class of its own;
a text of one to four words is one shingle; rows that share a doc_id are texts of one node, so they may
be linked through each other's copies; the class is named by its smallest doc_id. An empty table
gives an empty result. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from profilespark.llm import dart_minhash, shingles
from profilespark.llm.common import map_arrow, register, small_batches, table, text_of
from profilespark.llm.components import connected_components
from profilespark.session import materialize

MIN_SIMILARITY = 0.8
BANDS = 30
ROWS = 6
#: Slots in which shingles are counted to tell rare ones; collisions only cost time.
SLOT_BITS = 18
#: Bits of the filter that picks the texts of candidates, as a power of two (8 MB).
FILTER_BITS = 26
#: Parsed texts that a comparing task remembers.
REMEMBERED = 16

SKETCH = "doc_id long, digest_1 long, digest_2 long, n_words long, bands array<long>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        texts = batch.column("text").to_pylist()
        for start, block in shingles.blocks(texts):
            words, counts = shingles.word_hashes(block)
            digests = shingles.sequence_digests(words, counts)
            owner, element, weight, _ = shingles.shingles(block)
            ids = dart_minhash.sketch(owner, element, weight, len(block), BANDS * ROWS)
            keys = dart_minhash.bands(ids, ROWS).view(np.int64)
            offsets = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(start, len(block)), *(pa.array(d.view(np.int64)) for d in digests), pa.array(counts),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1))),
            ], names=["doc_id", "digest_1", "digest_2", "n_words", "bands"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digests and number of the words, and the band hashes of every row."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), _sketched, SKETCH)


def _similarities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parsed: OrderedDict[int, tuple] = OrderedDict()

    def sets(node: int, text: str) -> tuple:
        if node in parsed and parsed[node][0] == text:
            parsed.move_to_end(node)
        else:
            _, h, n, _ = shingles.shingles([text])
            parsed[node] = (text, (h, n))
            if len(parsed) > REMEMBERED:
                parsed.popitem(last=False)
        return parsed[node][1]

    for batch in small_batches(batches):
        a, b, text_a, text_b = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
        found = [shingles.similarity(sets(i, x), sets(j, y)) for i, j, x, y in zip(a, b, text_a, text_b)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact similarity of pairs (a, b) of nodes, given their texts (node, text)."""
    joined = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    joined = joined.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    found = map_arrow(joined.select("a", "b", "text_a", "text_b"), _similarities, "a long, b long, similarity double")
    return found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in small_batches(batches):
        for _, block in shingles.blocks(batch.column("text").to_pylist()):
            _, h, _, _ = shingles.shingles(block)
            counts += np.bincount(_slot(h), minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """About how many texts hold the shingles of each slot: 2^SLOT_BITS numbers, whatever the input."""
    slots = map_arrow(texts.select("text"), _count_shingles, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in slots.toArrow().to_batches():
        counts[batch.column("slot").to_numpy()] = batch.column("n").to_numpy()
    return counts


def prefixes(block: list[str], counts: np.ndarray, similarity: float = MIN_SIMILARITY) -> tuple[np.ndarray, ...]:
    """The rarest shingles of every text: text number, token, the token's place from 0, and the text's tokens.

    A shingle that a text holds k times is k tokens, so the weighted similarity is that of sets of tokens.
    Of n tokens in any order that is the same for all texts, the first n - ceil(s n) + 1 hold one of every
    text of similarity s or more, among that one's first tokens; with rare tokens first, that means little else.
    """
    owner, h, weight, _ = shingles.shingles(block)
    of = np.repeat(np.arange(len(h)), weight)
    copy = np.arange(len(of)) - np.repeat(np.cumsum(weight) - weight, weight)
    owner, token = owner[of], shingles.mix(h[of] + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((token, counts[_slot(h)][of], owner))
    owner, token = owner[order], token[order]
    n = np.bincount(owner, minlength=len(block))
    place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
    first = place < (n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1)[owner]
    return owner[first], token[first], place[first], n[owner[first]]


def rare_tokens(texts: DataFrame) -> DataFrame:
    """node, root and the prefix tokens, with place and number, of texts (node, root, text)."""
    shared = texts.sparkSession.sparkContext.broadcast(shingle_counts(texts))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for start, block in shingles.blocks(batch.column("text").to_pylist()):
                owner, token, place, n = prefixes(block, shared.value)
                at = pa.array(start + owner)
                columns = [batch.column("node").take(at), batch.column("root").take(at), *(pa.array(c.view(np.int64)) for c in (token, place, n))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "root", "token", "place", "n"])

    return map_arrow(texts.select("node", "root", "text"), found, "node long, root long, token long, place long, n long")


def _place(node: Column) -> tuple[Column, Column]:
    """Word and bit of a node in the filter."""
    slot = F.pmod(F.xxhash64(node), F.lit(1 << FILTER_BITS))
    return F.shiftright(slot, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int")).alias("bit")


def node_filter(nodes: DataFrame) -> DataFrame:
    """A Bloom filter of one hash over nodes as rows of 64 bits: at most 2^(FILTER_BITS - 6) of them, whatever the input."""
    return nodes.select(*_place(F.col("node"))).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def in_filter(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose node the filter holds, and few others, without shuffling them; the joins that follow are exact."""
    word, bit = _place(F.col("node"))
    marked = rows.select("*", word, bit).join(F.broadcast(found), "word")
    return marked.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("word", "bit", "bits")


def near_links(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Links (a, b) between nodes (smallest doc_ids of texts) whose components are the classes."""
    known = marks.where("n_words > 0 and doc_id is not null")
    nodes = known.groupBy("digest_1", "digest_2", "n_words").agg(F.min_by(F.struct("doc_id", "bands"), "doc_id").alias("one"))
    rows = materialize(nodes.select(F.col("one.doc_id").alias("node"), F.explode("one.bands").alias("band")), "bands")
    stars = materialize(rows.groupBy("band").agg(F.min("node").alias("star"), F.count("*").alias("n")).where("n > 1"), "stars")
    buckets = materialize(rows.join(stars, "band"), "buckets")
    pairs = buckets.where("node > star").select(F.col("star").alias("a"), F.col("node").alias("b")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), text_of().alias("text"))
    texts = materialize(in_filter(texts, node_filter(buckets)), "candidate-texts")
    compared = materialize(compare(pairs, texts), "compared")
    linked = compared.where(F.col("similarity") >= MIN_SIMILARITY).select("a", "b")

    # Buckets of two are finished. In larger ones texts of different components may still be similar.
    roots = connected_components(linked)
    rooted = buckets.where("n > 2").join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "rooted-buckets")
    several = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
    open_ = materialize(rooted.join(several, "band", "left_semi").select("node", "root").distinct(), "open-nodes")
    if open_.isEmpty():
        return linked
    tokens = materialize(rare_tokens(texts.join(open_, "node")), "rare-tokens")
    # In a token's group, texts are compared with all but those of their own component; the largest
    # component of the group is not compared with itself.
    held = tokens.groupBy("token", "root").agg(F.count("*").alias("texts"))
    major = held.groupBy("token").agg(F.max_by("root", F.struct("texts", "root")).alias("major"), F.count("*").alias("roots")).where("roots > 1")
    shared = materialize(tokens.join(major.drop("roots"), "token"), "shared-tokens")
    minor = shared.where("root <> major").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "place", "n")])
    # The first token that two texts share is followed by all others that they do, in both.
    left = F.least(F.col("x_n") - F.col("x_place"), F.col("n") - F.col("place"))
    enough = left >= MIN_SIMILARITY / (1 + MIN_SIMILARITY) * (F.col("x_n") + F.col("n")) - 1e-9
    rest = minor.join(shared.drop("major"), "token").where((F.col("x_root") != F.col("root")) & enough)
    rest = rest.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct().join(compared, ["a", "b"], "left_anti")
    last = compare(rest, texts).where(F.col("similarity") >= MIN_SIMILARITY).select("a", "b")
    return linked.unionByName(materialize(last, "late-links"))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, group_size and kept (the class is named by it) for every row."""
    marks = materialize(sketches(docs), "sketches")
    roots = connected_components(near_links(docs, marks))
    key = ["digest_1", "digest_2", "n_words"]
    texts = marks.where("n_words > 0").groupBy(*key).agg(F.min("doc_id").alias("node"))
    texts = texts.join(roots, "node", "left").select(*key, F.coalesce("root", "node").alias("root"))
    # Written, as the sizes below: the joins with rows then deal out both sides, and Spark can split a hot text or class.
    texts = materialize(texts, "text-roots")
    rows = marks.select("doc_id", *key).join(texts, key, "left").withColumn("class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")))
    rows = materialize(rows.select("doc_id", "class_id"), "near-classes")
    sizes = materialize(rows.where("class_id is not null").groupBy("class_id").agg(F.count("*").alias("group_size")), "class-sizes")
    return rows.join(sizes, "class_id", "left").select(
        "doc_id", "class_id", F.coalesce("group_size", F.lit(1)).alias("group_size"), F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest doc_id, with the columns of ``docs``.

    Rows of a null doc_id stay; of rows that share a kept doc_id the first by their hash stays.
    """
    keep = near_classes(docs.select("doc_id", "text")).where("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("row")))
    kept = rows.where("doc_id is not null").withColumn("nth", first).where("nth = 1").join(keep, "doc_id", "left_semi")
    return kept.select("row.*").unionByName(rows.where("doc_id is null").select("row.*"))


@register("op3_minhash_dedup")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_classes(table(spark, sf_dir, "documents"))
