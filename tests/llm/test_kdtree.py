"""Largest inner products against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.llm import kdtree
from sectoria.llm.queries import SQL, op3_nearest

from .sqlcheck import check_sql

SCHEMA = "vec_id long, vector array<float>"


def plain(rows, ids, k=10):
    def whole(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            return None
        return [math.floor(1024.0 * float(np.float32(x))) for x in vector]

    known = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    result = set()
    for q, vector in known:
        if q in ids:
            low, high = kdtree.LONG
            products = [(sum(a * b for a, b in zip(vector, v)), i) for i, v in known if i != q and len(v) == len(vector)]
            scores = sorted((-min(max(s, low), high), i) for s, i in products)
            result |= {(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)}
    return result


def check(spark, rows, ids, k=10):
    vectors = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(r) for r in kdtree.nearest(vectors, vectors.where(F.col("vec_id").isin(list(ids))), k).collect()]
    assert sorted(found) == sorted(plain(rows, ids, k)) and len(found) == len(set(found))


def test_query_equals_its_sql(spark, folder):
    check_sql(spark, folder, op3_nearest, SQL["op3_nearest"])


@pytest.mark.parametrize("spread", ["clusters", "few values", "copies"])
def test_all_pairs(spark, monkeypatch, spread):
    monkeypatch.setattr(kdtree, "SHARD", 150)
    monkeypatch.setattr(kdtree, "SEED", 30)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        if spread == "clusters":
            vector = rng.normal(rng.integers(4), 0.1, 8)
        elif spread == "few values":
            vector = rng.integers(-1, 2, 8).astype(float)
        else:
            vector = np.ones(8) if i % 3 else rng.normal(0, 1, 8)
        rows.append((i, [float(x) for x in vector]))
    random.Random(1).shuffle(rows)
    check(spark, rows, set(range(0, 700, 50)))


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]),
        (1, None),
        (2, [None, 1.0]),
        (3, [math.inf, 1.0]),
        (4, [math.nan, 1.0]),
        (5, [3e38, -3e38]),
        (6, [1e9, 1e9]),
        (7, [-0.0001, 0.00001]),
        (8, [1.0, 2.0, 3.0]),
        (9, []),
        (10, []),
        (None, [1.0, 1.0]),
        (11, [1e6, 1e6]),
    ]
    check(spark, rows, {0, 1, 3, 5, 6, 8, 9, 11})


def test_repeats_clashing_columns_and_no_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [2.0])]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({"shard": F.lit("x"), "bound": F.lit(1), "length": F.lit(0)})
    found = kdtree.nearest(vectors, vectors.where("vec_id = 0"), 3).orderBy("rank").collect()
    assert [(r.rank, r.vec_id) for r in found] == [(1, 1), (2, 1), (3, 2)]
    assert kdtree.nearest(vectors.where("false"), vectors, 3).collect() == []
    assert kdtree.nearest(vectors, vectors.where("false"), 3).collect() == []
