"""Language identification by bit-sliced Bloom filters over character n-grams.

One array of slots serves all languages: a slot holds a bit per language, and an n-gram sets its
language's bit in ``HASHES`` slots. The AND of those slots answers in one step which languages
contain the n-gram. A document's answers are counted per language; from each count the hits that
chance alone would give (the share of the language's set bits to the power of ``HASHES``, times the
n-grams) are taken away; the language with the largest rest is predicted, and its share of the
document's n-grams is the score.

Learnt are the n-grams that make at least one in ``GRAM_SHARE`` of a language's n-grams, from about
``SAMPLE`` training documents of it (those with the smallest hashes of doc_id), whole texts. So a
language has at most GRAM_SHARE n-grams, and the filter has 2^SLOT_BITS slots of 8 bytes per 64
languages, however many documents there are; the driver holds that and it is broadcast. Languages are
all that a training document names, in code point order, however few of the documents name them.

N-grams are 3 and 4 characters within a word and the blanks beside it, of the lower-case text with
everything but letters read as blanks. Rows, nulls, ties: a null text or one without a letter is
``und`` with score 0; a null doc_id is never held out nor trained on; of languages with equal
counts the first in code point order is predicted; repeated rows are predicted alike; an empty
table, or one that nothing can be learnt from, gives ``und``. Only doc_id, text and (for training)
lang are read, so other columns cannot clash. Texts beyond ``SEGMENT`` characters are read in segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from profilespark.llm.common import map_arrow, register, small_batches, table
from profilespark.session import materialize

SAMPLE = 3_000
GRAM_SHARE = 50_000
SLOT_BITS = 20
HASHES = 3
SEGMENT = 1 << 18
UNKNOWN = "und"

_BLANK = np.uint64(32)
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_FINISH = np.uint64(0xFF51AFD7ED558CCD)
_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Of every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, and the text that each is of."""
    texts = [t.lower() for t in texts]
    joined = "\n".join(texts)
    lengths = np.array([len(t) + 1 for t in texts])
    codes = np.frombuffer(f"\n{joined}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.concatenate([[0], np.repeat(np.arange(len(texts)), lengths)])
    letter = _is_letter()[codes]
    stays = letter.copy()
    stays[1:] |= letter[:-1]  # the blank behind a word
    stays[0] = True
    letter, owner = letter[stays], owner[stays]
    codes = np.where(letter, codes[stays].astype(np.uint64), _BLANK)
    hashes, owners = [], []
    for n in (3, 4):
        size = len(codes) - n + 1
        if size <= 0:
            continue
        inside = letter[1:size + 1].copy()
        for k in range(2, n - 1):
            inside &= letter[k:size + k]
        at = np.flatnonzero(inside)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h += codes[at + k] * _FACTORS[k]
            h ^= h >> np.uint64(31)
        h *= _FINISH
        h ^= h >> np.uint64(32)
        hashes.append(h)
        owners.append(owner[at + 1])
    return (np.concatenate(hashes), np.concatenate(owners)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, int))


def _segments(text: str) -> list[str]:
    """The text in segments, cut at blanks."""
    out, start = [], 0
    while len(text) - start > SEGMENT:
        end = text.find(" ", start + SEGMENT)
        if end < 0:
            break
        out.append(text[start:end])
        start = end
    return [*out, text[start:]]


def _blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Segments of the texts, with the text's number, in blocks of about SEGMENT characters."""
    numbers, block, held = [], [], 0
    for i, text in enumerate(texts):
        for part in _segments(text or ""):
            numbers.append(i)
            block.append(part)
            held += len(part)
            if held >= SEGMENT:
                yield numbers, block
                numbers, block, held = [], [], 0
    if block:
        yield numbers, block


def slots_of(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(20 * j)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for j in range(HASHES)]


@dataclass(frozen=True)
class LanguageFilter:
    """``planes`` holds a row of slots per 64 languages."""

    languages: tuple[str, ...]
    planes: np.ndarray

    def chance(self) -> np.ndarray:
        """Of every language, how likely an n-gram that was never learnt is found all the same."""
        full = [np.count_nonzero(self.planes[k // 64] >> np.uint64(k % 64) & np.uint64(1)) / self.planes.shape[1] for k in range(len(self.languages))]
        return np.array(full) ** HASHES

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: its n-grams, and how many of them each language contains."""
        total = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(self.languages), len(texts)), np.int64)
        for numbers, block in _blocks(texts):
            h, owner = grams(block)
            owner = np.array(numbers)[owner]
            total += np.bincount(owner, minlength=len(texts))
            where = slots_of(h)
            for p, plane in enumerate(self.planes):
                mask = plane[where[0]]
                for slot in where[1:]:
                    mask &= plane[slot]
                for k in range(64 * p, min(64 * p + 64, len(self.languages))):
                    hits[k] += np.bincount(owner[(mask >> np.uint64(k % 64) & np.uint64(1)).astype(bool)], minlength=len(texts))
        return total, hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        total, hits = self.counts(texts)
        chance = self.chance()[:, None]
        rest = np.clip((hits - total * chance) / (1 - chance).clip(1e-9), 0, None)
        best = rest.argmax(axis=0)
        score = np.clip(rest.max(axis=0) / total.clip(1), 0, 1)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, total)], np.where(total > 0, score, 0.0).tolist()


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        number = np.array(batch.column("number").to_pylist())
        for numbers, block in _blocks(batch.column("text").to_pylist()):
            h, owner = grams(block)
            language = number[np.array(numbers)[owner]]
            for k in np.unique(language):
                found, n = np.unique(h[language == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), k), pa.int32()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["number", "gram", "n"])


def learn_languages(docs: DataFrame, sample: int = SAMPLE) -> LanguageFilter:
    """The filter of the languages that the training documents (doc_id, text, lang) name."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    named = sorted((r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect())  # a row per language
    if not named:
        return LanguageFilter((), np.zeros((0, 1 << SLOT_BITS), np.uint64))
    drawn = [(lang, k, float(min(1.0, sample / n))) for k, (lang, n) in enumerate(named)]
    drawn = docs.sparkSession.createDataFrame(drawn, "lang string, number int, bar double")
    draw = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") / 2**32
    # The driver holds a row per language anyway; a join, as an expression per language could not be compiled.
    chosen = labelled.select("lang", "text", draw.alias("draw")).join(F.broadcast(drawn), "lang").where(F.col("draw") < F.col("bar")).select("number", "text")
    counts = materialize(map_arrow(chosen, _count_grams, "number int, gram long, n long").groupBy("number", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = counts.groupBy("number").agg(F.sum("n").alias("total"))
    learnt = counts.join(F.broadcast(totals), "number").where(F.col("n") * GRAM_SHARE >= F.col("total"))
    slots = F.array(*[F.shiftrightunsigned("gram", 20 * j).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for j in range(HASHES)])
    planes = np.zeros((-(-len(named) // 64), 1 << SLOT_BITS), np.uint64)
    marked = learnt.select(F.explode(slots).alias("slot"), F.floor(F.col("number") / 64).cast("int").alias("plane"), F.expr("shiftleft(1L, number % 64)").alias("bit"))
    for r in marked.groupBy("plane", "slot").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():  # a row per slot at most
        planes[r.column("plane").to_numpy(), r.column("slot").to_numpy()] = r.column("bits").to_numpy().view(np.uint64)
    return LanguageFilter(tuple(lang for lang, _ in named), planes)


def identify(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """The rows of ``docs``, carried as the struct ``row``, with lang_pred and score.

    The text is the column ``text``, or where there is none that of the row, so that it travels once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^SLOT_BITS slots of 8 bytes per 64 languages

    separate = "text" in docs.columns

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column("text") if separate else pc.struct_field(batch.column("row"), "text")
            langs, scores = shared.value.predict(texts.to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    schema = T.StructType([docs.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(docs.select("row", *(["text"] if separate else [])), predicted, schema)


@register("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; one in four is held out from training."""
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = identify(docs.select(F.struct("doc_id", held_out().alias("held_out")).alias("row"), "text"), model)
    return found.select("row.*", "lang_pred", "score")
