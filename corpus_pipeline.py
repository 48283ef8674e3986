"""A training corpus from the documents: language, exact and near copies, mixture, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.llm.exact_dedup import exact_dedup
from profilespark.llm.language_id import UNKNOWN, held_out, identify, learn_languages
from profilespark.llm.mixing import mix
from profilespark.llm.near_dedup import near_dedup
from profilespark.llm.packing import pack
from profilespark.session import materialize

#: A document stays if its language holds at least this share of its n-grams.
MIN_LANGUAGE_SCORE = 0.2
#: Chunks whose tokens a worker remembers: the workers keep them while the other stages run.
REMEMBERED = 25_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learnt from them; those of no language go."""
    model = learn_languages(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text without its white space."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, remembered=REMEMBERED)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources", mixture),
    ("packing", packing),
]

#: Tokens and language scores are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
