"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are tokenized where they lie and packed in groups of neighbours, so nothing is shuffled.
A document gives whole windows of 2048 ids as long as it can; its rest is cut evenly into pieces of
at most ``PIECE`` ids. The pieces of a group are partial partitions of k windows each, one window
filled. The two partial partitions with the largest spread between their fullest and emptiest window
are merged again and again, the fullest window of one with the emptiest of the other, until one
partition is left, whose windows are nearly equal. Where one exceeds 2048, k rises and the group is
dealt anew. k starts at the least possible number.

Whole windows are given as soon as their document is read; only rests, under a window each, wait for
their group. A group has ``GROUP`` to twice as many of them (fewer only where a partition has fewer),
so memory is bounded by those rests and the ids of 16 MB of text or one longer text, and time by the
group's size, whatever the table's. Sequence ids are numbered within a partition, so a task that is
run again on the same input gives the same rows.

Rows, nulls, ties: a null text is empty and gives the end id alone; a null doc_id is passed on;
repeated rows are packed as often as they occur; an empty table gives an empty result. Only doc_id
and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.llm.common import map_arrow, register, small_batches, table, text_of
from profilespark.llm.fill_in_middle import by_bytes
from profilespark.llm.tokens import REMEMBERED, WORD_BPE, word_ids

WINDOW = 2048
PIECE = 512
GROUP = 1024
END_ID = 1
#: Chunks that a worker remembers where packing is all it does: less time for more memory.
REMEMBERED_ALONE = 1_000_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split()[0] for f in PIECES.split(", ")]
_END = np.array([END_ID], dtype="<u4").tobytes()


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, 0 to k - 1, of every size, by largest differencing over k-tuples of sums."""
    sums: list[np.ndarray | None] = []
    merges: list[tuple[int, int, np.ndarray] | None] = []
    heap = []
    for i, size in enumerate(sizes.tolist()):
        alone = np.zeros(k, np.int64)
        alone[-1] = size
        sums.append(alone)
        merges.append(None)
        heap.append((-size, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]  # ascending meets descending: opposing imbalances
        order = np.argsort(both, kind="stable")
        both = both[order] - both[order[0]]
        sums[a] = sums[b] = None
        sums.append(both)
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(both[-1]), len(sums) - 1))
    window = np.zeros(len(sizes), np.int64)
    open_ = [(heap[0][1], np.arange(k))] if heap else []
    while open_:
        node, windows = open_.pop()
        if merges[node] is None:
            window[node] = windows[-1]
            continue
        a, b, order = merges[node]
        own = np.empty(k, np.int64)
        own[order] = windows
        open_ += [(a, own), (b, own[::-1])]
    return window


def balanced_windows(sizes: np.ndarray, capacity: int = WINDOW) -> tuple[np.ndarray, int]:
    """The window of every size, and their number: the first k from the least possible on at which none exceeds the capacity."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        fullest = int(np.bincount(window, weights=sizes, minlength=k).max()) if len(sizes) else 0
        if fullest <= capacity:
            return window, k
        k += max(1, int(k * (fullest - capacity) / capacity / 2))


def _cut(rest: int, piece: int) -> list[int]:
    """Lengths of the pieces of the ids that are left of a document after its whole windows."""
    parts = -(-rest // piece)
    return [rest // parts + (j < rest % parts) for j in range(parts)]


@dataclass(frozen=True, slots=True)
class Rest:
    """What is left of a document after its whole windows: where it starts, its ids, and the ids of the whole document."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int


def whole_windows(doc_id: int | None, ids: bytes, first_sequence: int, window: int = WINDOW) -> tuple[list[tuple], Rest]:
    """Rows of ``PIECES`` for the windows that a document fills, and its rest."""
    n = len(ids) // 4
    rows = [
        (doc_id, at, window, zlib.crc32(ids[4 * at:4 * (at + window)]), n, first_sequence + i, 0)
        for i, at in enumerate(range(0, n - n % window, window))
    ]
    return rows, Rest(doc_id, n - n % window, ids[4 * (n - n % window):], n)


def pack_group(rests: list[Rest], first_sequence: int, window: int = WINDOW, piece: int = PIECE) -> tuple[list[tuple], int]:
    """Rows of ``PIECES`` for the rests of documents, and the number of sequences."""
    pieces = []
    for rest in rests:
        at = 0
        for length in _cut(len(rest.ids) // 4, piece):
            pieces.append((rest, at, length))
            at += length
    if not pieces:
        return [], 0
    where, k = balanced_windows(np.array([p[2] for p in pieces]), window)
    # A window that gets no piece is no sequence: those that do are numbered without gaps.
    number = {w: first_sequence + i for i, w in enumerate(sorted(set(where.tolist())))}
    rows, filled = [], [0] * k
    for (rest, at, length), w in zip(pieces, where.tolist()):
        rows.append((rest.doc_id, rest.start + at, length, zlib.crc32(rest.ids[4 * at:4 * (at + length)]), rest.doc_tokens, number[w], filled[w]))
        filled[w] += length
    return rows, len(number)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=_NAMES)


def pack(docs: DataFrame, tokenizer: str = WORD_BPE, window: int = WINDOW, piece: int = PIECE, group: int = GROUP,
         remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece of a document: where it is cut, what it holds, and its place in a sequence."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer, remembered)
        sequence = TaskContext.get().partitionId() << 33
        held: list[Rest] = []
        for batch in small_batches(by_bytes(batches)):
            whole = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                rows, rest = whole_windows(doc_id, ids + _END, sequence, window)
                sequence += len(rows)
                whole += rows
                if rest.ids:
                    held.append(rest)
                if len(held) == 2 * group:
                    rows, used = pack_group(held[:group], sequence, window, piece)
                    held, sequence = held[group:], sequence + used
                    yield _record(rows)
            if whole:
                yield _record(whole)
        if held:
            yield _record(pack_group(held, sequence, window, piece)[0])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), packed, PIECES)


@register("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), remembered=REMEMBERED_ALONE)
