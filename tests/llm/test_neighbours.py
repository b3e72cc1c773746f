"""Votes against a plain version, and held-out accuracy on the given labels."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.llm import neighbours as N


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = N.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in labels]
    right = np.mean([r.predicted == labels[r.doc_id] for r in unseen])
    assert right >= 0.98, right
    good = [r.score for r in unseen if labels[r.doc_id]]
    bad = [r.score for r in unseen if not labels[r.doc_id]]
    better, even = (np.mean([f(g, b) for g in good for b in bad]) for f in (lambda g, b: g > b, lambda g, b: g == b))
    assert better + even / 2 >= 0.98


def test_votes_equal_a_plain_version():
    rng = np.random.default_rng(1)
    counts = rng.poisson(0.02, (40, N.FEATURES))
    rarity = rng.random(N.FEATURES).astype(np.float32)
    rows = N.weighted(counts, rarity)
    axes = N.leading_axes(rows, 8)
    model = N.LatentModel(rarity, axes, N._unit(rows @ axes), (rng.random(40) < 0.6).astype(np.float32))
    fresh = rng.poisson(0.02, (9, N.FEATURES))
    for score, row in zip(N.votes(model, fresh), N.weighted(fresh, rarity) @ axes):
        cosines = [float(v @ row / np.linalg.norm(row)) for v in model.vectors]
        near = sorted(range(40), key=lambda i: -cosines[i])[: N.NEIGHBOURS]
        weight = [max(cosines[i], 0) ** N.SHARPNESS for i in near]
        assert score == pytest.approx(sum(w * model.labels[i] for w, i in zip(weight, near)) / sum(weight), abs=1e-4)


def test_axes_are_the_leading_singular_vectors():
    rows = np.random.default_rng(2).standard_normal((30, 50)).astype(np.float32) * np.linspace(1, 30, 50, dtype=np.float32)
    exact = np.linalg.svd(rows)[2][:4]
    assert np.allclose(np.abs(N.leading_axes(rows, 4).T @ exact.T).diagonal(), 1, atol=0.05)


def test_labels_of_held_out_rows_are_not_learnt(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    changed = labels.withColumn("quality", F.when(N.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in N.quality_scores(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in N.quality_scores(docs, changed).collect()}


def test_nulls_repeats_clashing_columns_and_no_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0), (None, 1), (4, None), (5, 0)], "doc_id long, quality int")
    docs = documents((1, "good words here"), (3, "### $$$"), (3, "### $$$"), (None, "good words"), (4, None), (5, ""), (6, "ab"))
    docs = docs.withColumns({"score": F.lit("x"), "quality": F.lit(7), "bucket": F.lit(0)})
    rows = N.quality_scores(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= N.THRESHOLD) for r in rows)
    assert {r.score for r in N.quality_scores(docs, labels.where("false")).collect()} == {0.5}
    assert N.quality_scores(docs.where("false"), labels).collect() == []
