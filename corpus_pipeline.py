"""Documents to token sequences: languages, quality, near-duplicates, repeated passages, packing.

Every stage takes the documents that its predecessor kept, from a table that is written and read again, and works on all of
them. All but the last return the columns of ``documents``. A document is named by its doc_id: what a stage rejects, it
rejects with all rows of that id. Rows without doc_id take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sectoria.llm.chosen_path import near_duplicates, of_ids
from sectoria.llm.languages import document_items, fused_languages
from sectoria.llm.neighbours import THRESHOLD, scored
from sectoria.llm.packing import packed, token_pieces
from sectoria.llm.repeats import remove_repeats
from sectoria.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents whose id is not rejected."""
    return of_ids(docs, rejected, "left_anti").select(*COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: at least one letter, and a language with half of the posterior."""
    docs = docs.where(F.col("doc_id").isNotNull())
    return _without(docs, fused_languages(document_items(docs), ["doc_id"]).where(~F.col("kept")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours call good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs.select(*COLUMNS), labels).where(F.col("score") >= THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return _without(docs, near_duplicates(docs, width=5, percent=80).where(~F.col("kept")))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that stand earlier; a character stays unless all its bytes go."""
    kept = remove_repeats(docs, with_text=True, carried=("lang", "source"))
    return kept.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars")
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(token_pieces(docs))


STAGES = [
    ("language", keep_languages),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("packing", pack),
]

# Classifier, randomised join, suffix order and tokenizer are beyond SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
