"""Small hand-made tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["row", "size", "id", "key", "bucket", "page", "n", "copies", "words", "common", "batch", "node", "root", "band", "place", "digest", "copy", "nth"]

WORDS = {
    "en": "the and of to in is that for it with as was on be by this have from or had".split(),
    "de": "der die und das nicht von sie ist des sich mit dem dass ein eine auf für".split(),
}


def prose(lang: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    stems = {"en": "thing walk house light river stone cloud table", "de": "haus straße licht fluss stein wolke tisch größe"}[lang].split()
    return " ".join(rng.choice(WORDS[lang]) if rng.random() < 0.5 else rng.choice(stems) + rng.choice(["s", "ed", "en", "ing", ""]) for _ in range(n))


def changed(text: str, every: int) -> str:
    words = text.split(" ")
    return " ".join(f"changed{i}" if i % every == every - 1 else w for i, w in enumerate(words))


def documents() -> list[tuple]:
    """Unique doc_ids; nulls and empty texts among them."""
    base = prose("en", 400, 1)
    line = "This line is long enough to count and stands in many documents"
    rows = [(i, prose("en" if i % 3 else "de", 30 + 7 * i, i), "en" if i % 3 else "de", f"src{i % 4}") for i in range(40)]
    rows += [
        (100, base, "en", "src0"), (101, base, "en", "src1"), (102, base.replace(" ", "\t\n"), "en", None), (103, changed(base, 100), "en", "src0"),
        (104, changed(base, 40), "en", "src2"), (105, None, None, None), (106, "", "en", "src1"), (107, " \t\r\n", None, "src1"), (108, "...!?", "en", None),
        (109, "MIT License", "en", "src3"), (110, "A", None, "src0"), (111, "ÄÖÜ ß x CC-BY gnu\nGeneral-Public license\x0b", "de", "é"),
        (112, "the same words again and again " * 40, "en", "src0"), (113, prose("en", 20_000, 7), "en", "src0"), (114, "x" * 300_000, None, "src0"),
    ]
    rows += [(200 + i, f"{prose('en', 20, 900 + i)}\n  {line.upper() if i % 2 else line}\t\n{line}", "en", "src0") for i in range(7)]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def frame(spark: SparkSession, rows: list[tuple], clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(rows, DOCS)
    if clashing:
        for name in CLASHING:
            docs = docs.selectExpr("*", f"concat('{name}-', doc_id) AS `{name}`")
    return docs


def odd_rows() -> list[tuple]:
    """Null and shared doc_ids and repeated rows, besides the documents."""
    text = prose("en", 60, 3)
    return [*documents(), (None, text, "en", "src0", 1), (None, text, "en", "src0", 1), (None, None, None, None, None), (7, text, "en", "src1", 2), (7, text, "en", "src1", 2), (7, text, "en", "src1", 2)]
