"""The operators of this package on the given tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoded, encoding_digests
from .cascade import JUDGED_SQL, judged
from .centroids import clustered, clustered_sql
from .chats import CHATS_SQL, rendered_chats
from .chosen_path import near_duplicates
from .fingerprints import near_fingerprints
from .kdtree import NEAREST_SQL, nearest
from .languages import document_items, fused_languages, page_items
from .manifest import manifest, manifest_sql
from .neighbours import quality_scores
from .packing import packed, token_pieces
from .pages import extracted
from .repeats import remove_repeats


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_chats(spark: SparkSession, folder: str) -> DataFrame:
    return rendered_chats(table(spark, folder, "conversations"))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(table(spark, folder, "pages"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op10_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(encoded(table(spark, folder, "documents")))


def op3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return fused_languages(document_items(table(spark, folder, "documents")), ["doc_id"])


def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    return fused_languages(page_items(table(spark, folder, "pages")), ["page_id"])


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(token_pieces(table(spark, folder, "documents")))


def op11_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector")))


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents"))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return near_fingerprints(table(spark, folder, "documents"))


QUERIES = {
    "op1_chats": op1_chats,
    "op2_repeats": op2_repeats,
    "op3_nearest": op3_nearest,
    "op4_language": op4_language,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_extraction": op8_extraction,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_encoding": op10_encoding,
    "op11_clusters": op11_clusters,
    "op12_manifest": op12_manifest,
    "op13_fingerprints": op13_fingerprints,
    "page_languages": page_languages,
}

SQL: dict[str, str] = {
    "op1_chats": CHATS_SQL,
    "op3_nearest": NEAREST_SQL,
    "op5_quality_rules": JUDGED_SQL,
    "op11_clusters": clustered_sql(),
    "op12_manifest": manifest_sql(),
}
