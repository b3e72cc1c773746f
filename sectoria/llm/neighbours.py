"""Quality of texts by the votes of their nearest labelled neighbours in a latent semantic space.

Texts are bags of hashed byte trigrams and of words that repeat the word before them, weighted by how rare a feature is
over all documents. The space is spanned by the
leading singular vectors of a bounded sample of labelled rows; their latent vectors and labels go to every task. For every
document the cosines with all of them are computed block by block, and the labels of the ``NEIGHBOURS`` nearest are
averaged, weighted by a power of the cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bytetext import Rolling, byte_column, released, text_chunks, word_spans

BUCKETS = 4096
# One more feature counts the words that repeat the word before; it weighs as much as so many trigrams.
FEATURES = BUCKETS + 1
REPEAT_WEIGHT = 8.0
LATENT = 64
# Bound of the labelled sample; all its vectors are sent to every task (LABELLED * LATENT numbers).
LABELLED = 2048
NEIGHBOURS = 15
SHARPNESS = 4
THRESHOLD = 0.7
BLOCK = 128


@dataclass(frozen=True)
class LatentModel:
    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def feature_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams for every text, case kept, and last of repeated words; texts below three bytes have none."""
    texts = len(offsets) - 1
    counts = np.zeros((texts, FEATURES), dtype=np.int64)
    if len(data) < 3:
        return counts
    values = data.astype(np.uint32)
    joined = values[:-2] | values[1:-1] << np.uint32(8) | values[2:] << np.uint32(16)
    codes = ((joined * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)).astype(np.int64)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    inside = owner[:-2] == owner[2:]
    places = (owner[:-2] * BUCKETS + codes)[inside]
    counts[:, :BUCKETS] = np.bincount(places, minlength=texts * BUCKETS).reshape(texts, BUCKETS)
    starts, stops, _ = word_spans(data, offsets)
    if len(starts) > 1:
        words = Rolling(data).ranges(starts, stops)
        again = (words[1:] == words[:-1]) & (owner[starts[1:]] == owner[starts[:-1]])
        counts[:, BUCKETS] = np.bincount(owner[starts[1:][again]], minlength=texts)
    return counts


def count_blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """Counts of at most ``size`` texts at a time, whose bytes are bounded too."""
    data, offsets = byte_column(column)
    for low, high in text_chunks(offsets):
        for first in range(low, high, size):
            places = offsets[first : min(first + size, high) + 1]
            yield first, feature_counts(data[places[0] : places[-1]], places - places[0])


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rows of length one; a text without features stays zero."""
    rows = np.log1p(counts.astype(np.float32)) * rarity
    rows[:, BUCKETS] *= REPEAT_WEIGHT
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _bucket_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    holding, texts = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for _, counts in count_blocks(batch.column("text")):
            holding += (counts > 0).sum(axis=0)
            texts += len(counts)
    # Bucket -1 counts the texts.
    bucket = np.append(np.flatnonzero(holding), -1)
    yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.append(holding[holding > 0], texts))], names=["bucket", "n"])


def rarity_of(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every bucket over all documents."""
    counted = (
        docs.select("text")
        .mapInArrow(released(_bucket_documents), "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = {r.bucket: r.n for r in counted.collect()}
    holding = np.array([found.get(b, 0) for b in range(FEATURES)])
    return np.log((1 + found.get(-1, 0)) / (1 + holding)).astype(np.float32) + np.float32(0.05)


def held_out(doc_id: Column) -> Column:
    """Rows set aside: crc32 of the id as text leaves 2 when divided by 4; a null id is not set aside."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """Text and label of at most ``bound`` rows that are not held out, the same ones at every run."""
    wanted = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most ``bound`` rows: safe to send to every task.
    found = texts.join(F.broadcast(wanted), "doc_id")
    return found.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def leading_axes(rows: np.ndarray, count: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    count = min(count, *rows.shape)
    axes = np.random.default_rng(7).standard_normal((rows.shape[1], min(count + 16, min(rows.shape)))).astype(np.float32)
    for _ in range(5):
        axes, _ = np.linalg.qr(rows.T @ (rows @ axes))
    _, _, turn = np.linalg.svd(rows @ axes, full_matrices=False)
    return (axes @ turn.T)[:, :count].astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fitted(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> LatentModel:
    """Space and labelled vectors; without labelled rows there are none."""
    rarity = rarity_of(docs)
    sample = labelled_sample(docs, labels, bound).toArrow().sort_by("doc_id")
    if not sample.num_rows:
        return LatentModel(rarity, np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    column = sample.column("text").combine_chunks()
    rows = np.vstack([weighted(counts, rarity) for _, counts in count_blocks(column)])
    axes = leading_axes(rows, LATENT)
    return LatentModel(rarity, axes, _unit(rows @ axes), sample.column("quality").to_numpy().astype(np.float32))


def votes(model: LatentModel, counts: np.ndarray) -> np.ndarray:
    """Weighted share of label 1 among the nearest neighbours of every row of counts."""
    share = float(model.labels.mean()) if len(model.labels) else 0.5
    scores = np.full(len(counts), share)
    full = counts.any(axis=1)
    if not len(model.labels) or not full.any():
        return scores
    cosines = _unit(weighted(counts[full], model.rarity) @ model.axes) @ model.vectors.T
    near = min(NEIGHBOURS, cosines.shape[1])
    # The order of equal cosines must not matter: all that reach the last place vote.
    last = np.partition(cosines, -near, axis=1)[:, -near]
    weight = np.where(cosines >= last[:, None], np.maximum(cosines, 0.0) ** SHARPNESS, 0.0)
    total = weight.sum(axis=1)
    scores[full] = np.where(total > 0, (weight @ model.labels) / np.maximum(total, 1e-30), share)
    return np.clip(scores, 0.0, 1.0)


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for first, counts in count_blocks(batch.column("text")):
                scores[first : first + len(counts)] = votes(shared.value, counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """All columns of ``docs`` and its ``score``; a column of that name is replaced."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, bound))
    rows = docs.drop("score")
    return rows.mapInArrow(released(_scores(model)), T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """Quality of every whole text: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= THRESHOLD).

    Labels are learnt from at most ``bound`` rows that are not held out; of several labels of one document the majority
    counts, half counts as 1. Texts below three bytes and null get the share of label 1 in the sample; without labelled
    rows every score is 0.5. A null doc_id stays null, repeated rows get a row each, further columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(texts, labels, bound).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
