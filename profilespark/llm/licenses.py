"""License scan by ordered signature rules.

Hundreds of hand-written expressions (``license_rules``) are gated by keywords: one automaton finds
the keywords of all rules in a pass over the text's words, and only their rules search the text.
Overlaps are resolved by priority and containment: detections are taken by falling priority, then
length, then place and label, and one whose interval lies within that of a detection taken before is
suppressed. Detections of the base phrases take part, but are never suppressed.

Texts are scanned whole where they lie; nothing is shuffled, and a task holds one batch of rows.
Rows, nulls, ties: a null text is empty; a null doc_id is passed on; repeated rows are scanned alike;
equal intervals of equal priority keep the label first in order; an empty table gives an empty
result. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.llm.common import map_arrow, register, small_batches, table, text_of
from profilespark.llm.license_rules import WORD, Rule, base_rules, signature_rules

SPANS = "doc_id long, n_words long, detections array<struct<label:string,start:int,end:int,word:int,priority:int,base:boolean,suppressed:boolean>>"
_SPAN = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("word", pa.int32()), ("priority", pa.int32()),
                   ("base", pa.bool_()), ("suppressed", pa.bool_())])


@dataclass
class Detection:
    label: str
    start: int
    end: int
    priority: int
    base: bool
    word: int | None = None
    suppressed: bool = False


class Scanner:
    """The rules in order, and the automaton of their keywords."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = [*base_rules(), *signature_rules()] if rules is None else rules
        self.words = re.compile(f"{WORD}+").findall
        self.gaps = re.compile(r"[\W_]+")  # as the rules read them; beyond ASCII more than lies between words
        self.keywords = ahocorasick.Automaton()
        gated: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            gated.setdefault(" ".join(self.words(rule.keyword)), []).append(i)
        for keyword, numbers in gated.items():
            self.keywords.add_word(keyword, numbers)
        self.keywords.make_automaton()

    def scan(self, text: str) -> tuple[int, list[Detection]]:
        """The number of words, and all detections with those suppressed marked."""
        text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        words = self.words(text)
        plain = " ".join(words) if text.isascii() else self.gaps.sub(" ", text)
        open_rules = {i for _, numbers in self.keywords.iter(plain) for i in numbers}
        found = [
            Detection(rule.label, m.start(), m.end(), rule.priority, rule.base)
            for rule in (self.rules[i] for i in sorted(open_rules)) for m in rule.pattern.finditer(text)
        ]
        if found:
            resolve(found)
            at = words_before = 0
            for d in sorted((d for d in found if d.base), key=lambda d: d.start):
                words_before += len(self.words(text[at:d.start]))
                at, d.word = d.start, words_before
        return len(words), found


def resolve(found: list[Detection]) -> None:
    """Marks what lies within a detection of higher rank.

    Of the intervals taken so far only those within no other matter; ordered by start, their ends rise
    too, so the last that starts no later has the farthest end.
    """
    starts: list[int] = []
    ends: list[int] = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
        k = bisect_right(starts, d.start)
        if k and ends[k - 1] >= d.end:
            d.suppressed = not d.base
            continue
        low, high = bisect_left(starts, d.start), bisect_right(ends, d.end)
        starts[low:max(low, high)], ends[low:max(low, high)] = [d.start], [d.end]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, words and detections (label, span, first word of base phrases, priority) of every document."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in small_batches(batches):
            counts, spans = [], []
            for text in batch.column("text").to_pylist():
                n, found = scanner.scan(text)
                counts.append(n)
                spans.append([d.__dict__ for d in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "n_words", "detections"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), scanned, SPANS)


@register("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places and labels of every document, and the labels that the rules keep."""
    rows = scan_licenses(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("base", F.filter("detections", lambda d: d["base"])).withColumn("kept", F.filter("detections", lambda d: ~d["suppressed"]))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(f"{c}.label"))), ",")
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.word").cast("bigint").alias("first_word"), F.array_max("base.word").cast("bigint").alias("last_word"),
        labels("base").alias("base_labels"), labels("kept").alias("labels"),
        F.coalesce(F.array_max("kept.priority") / F.lit(100.0), F.lit(0.0)).alias("score"),
        F.size("kept").cast("bigint").alias("n_detections"),
    )
