"""From raw documents to packed training sequences: toxic texts and near copies go, then repeated passages; sources are
mixed and the texts packed. Every stage works on all that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import save, workspace
from kinfold.llm.jaccard import one_of_each
from kinfold.llm.mixing import mix, word_count
from kinfold.llm.packing import pack
from kinfold.llm.queries import MAX_REPEATS, table, vocabulary
from kinfold.llm.suffixes import remove_repeats
from kinfold.llm.toxicity import toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Columns of documents that operators know; others go through a stage under names that no operator uses.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")

TOXIC_FROM = 0.3
SIMILARITY = "0.8"
SHINGLE = 5


def with_columns_apart(stage: Stage) -> Stage:
    """The stage with columns of other names renamed on the way in and back on the way out, values unchanged."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: c if c in KNOWN else f"aside_{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(a) for c, a in aside.items()]), sf_dir)
        return out.select(*[F.col(a).alias(c) for c, a in aside.items()])

    return run


@with_columns_apart
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") < TOXIC_FROM).select(*docs.columns)


@with_columns_apart
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, SIMILARITY, SHINGLE)


@with_columns_apart
def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings; half a character that a cut leaves goes as well."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    found = remove_repeats(docs, carry=others)
    text = F.col("kept_text")
    columns = {c: F.col(f"carried.`{c}`") for c in others} | {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*[columns[c].alias(c) for c in docs.columns])


@with_columns_apart
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, word_count(), max_repeats=MAX_REPEATS).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", without_near_copies),
    ("suffix_dedup", without_repeated_passages),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned scores and tokenization have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = save(scratch, stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
