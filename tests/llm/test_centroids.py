"""Clusters against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.llm import centroids
from sectoria.llm.queries import SQL, op11_clusters

from .sqlcheck import check_sql

SCHEMA = "vec_id long, vector array<float>"


def plain(rows, clusters=16, rounds=3, length=64):
    kept = []
    for i, vector in rows:
        if vector is not None and len(vector) == length and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(64.0 * float(np.float32(x))) for x in vector]))
    named = [r for r in kept if r[0] is not None]
    means = [v for _, v in sorted(named, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:clusters]]
    if not means:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for c in range(len(means)):
            own = [v for (_, v), f in zip(kept, found) if f == c]
            if own:
                means[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [nearest(v) for _, v in kept]
    total = sum(d for d, _ in last)
    result = []
    for (i, _), (d, c) in zip(kept, last):
        digest = hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()
        result.append((i, c, d, sum(e for e, f in last if f == c), total, digest))
    return result


def check(spark, rows, **options):
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in centroids.clustered(vectors, **options).collect()]
    assert sorted(found, key=str) == sorted(plain(rows, **options), key=str)


def test_query_equals_its_sql(spark, folder):
    check_sql(spark, folder, op11_clusters, SQL["op11_clusters"])


@pytest.mark.parametrize("spread", ["clusters", "few values", "copies"])
def test_plain_rounds(spark, spread):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        if spread == "clusters":
            vector = rng.normal(rng.integers(-3, 4), 0.3, 6)
        elif spread == "few values":
            vector = rng.integers(-1, 2, 6) / 64
        else:
            vector = np.ones(6) if i % 3 else rng.normal(0, 1, 6)
        rows.append((i, [float(x) for x in vector]))
    check(spark, rows, clusters=7, rounds=4, length=6)


def test_bounds_spare_evaluations_and_lose_none(monkeypatch):
    """Far clusters with slowly moving centroids: most distances are never evaluated again."""
    rng = np.random.default_rng(5)
    heads = rng.integers(-2000, 2000, (8, 16))
    vectors = np.concatenate([h + rng.integers(-60, 60, (300, 16)) for h in heads])
    history = [heads.astype(np.int64)]
    known = np.stack([centroids.squared(vectors, c) for c in history[0]], axis=1)
    rounds, cluster, evaluated = np.zeros_like(known), known.argmin(axis=1), 0
    plainly = centroids.squared

    def counting(rows, means):
        nonlocal evaluated
        evaluated += len(rows)
        return plainly(rows, means)

    monkeypatch.setattr(centroids, "squared", counting)
    for _ in range(6):
        history.append(history[-1] + rng.integers(-8, 9, heads.shape))
        cluster = centroids.assigned(vectors, known, rounds, cluster, np.stack(history))
        exact = np.stack([plainly(vectors, c) for c in history[-1]], axis=1)
        assert (cluster == exact.argmin(axis=1)).all()
        assert (known[rounds == len(history) - 1] == exact[rounds == len(history) - 1]).all()
    assert evaluated < 0.1 * 6 * known.size


def test_displacement_is_one_norm_not_a_sum_of_drifts():
    there_and_back = np.array([[[0, 0]], [[30, 40]], [[0, 0]]])
    assert centroids.displacements(there_and_back).tolist() == [[0.0], [50.0], [0.0]]


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]),
        (1, None),
        (2, [None, 1.0]),
        (3, [math.inf, 1.0]),
        (4, [math.nan, 1.0]),
        (5, []),
        (6, [1.0, 2.0, 3.0]),
        (7, [-0.0001, 0.00001]),
        (8, [1e5, -1e5]),
        (None, [5.0, 5.0]),
        (9, [1.0, 2.0]),
        (9, [1.0, 2.0]),
        (9, [1.5, 2.0]),
    ]
    check(spark, rows, clusters=3, rounds=2, length=2)
    check(spark, rows, clusters=16, rounds=3, length=2)


def test_huge_components_are_cut(spark):
    rows = [(i, [x] * 64) for i, x in enumerate([3e38, -3e38, 1.0, 2.0])]
    found = centroids.clustered(spark.createDataFrame(rows, SCHEMA), clusters=2).collect()
    assert len(found) == 4 and all(r.distance >= 0 for r in found)


def test_clashing_columns_and_no_rows(spark):
    rows = [(i, [float(i), 0.0]) for i in range(9)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    clashing = vectors.withColumns({n: F.lit("x") for n in ("cluster", "known", "rounds", "distance")})
    plainly = centroids.clustered(vectors, clusters=2, length=2).collect()
    assert sorted(centroids.clustered(clashing, clusters=2, length=2).collect()) == sorted(plainly)
    assert centroids.clustered(vectors.where("false")).collect() == []
    assert centroids.clustered(vectors.withColumn("vec_id", F.lit(None)), length=2).collect() == []
