"""Centroid clustering with bounds that are loosened by the norm of a centroid's whole displacement.

Every vector keeps, for every centroid, its distance when it was last evaluated and the round of that evaluation. All rounds'
centroids are kept, so a stored distance is loosened by the norm of the displacement from then to now, which is at most the
sum of the rounds' drifts. Only where these bounds leave the nearest centroid open are distances evaluated again, in
integers. Vectors and bounds are a table that every round writes anew; only the centroids go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE = 64
# Components are at most so large, that a squared distance of 64 of them fits into a long.
LIMIT = 1 << 27
LONG = (1 << 63) - 1
# Bounds are doubles; so much of their size is left as a margin for rounding.
MARGIN = 1e-9
# Differences of so many vectors to one centroid are formed at once.
BLOCK = 4096


def _whole(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors of ``length`` finite components as integers."""
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("vector")
            right = np.flatnonzero(vectors.value_lengths().fill_null(-1).to_numpy() == length)
            ids, vectors = ids.take(pa.array(right)), vectors.take(pa.array(right))
            numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), length)
            finite = np.isfinite(numbers).all(axis=1)
            numbers = np.clip(np.floor(numbers[finite] * SCALE), -LIMIT, LIMIT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids.filter(pa.array(finite)), _lists(numbers)], names=["vec_id", "vector"])

    return run


def _lists(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances to one centroid, or row by row to as many centroids."""
    result = np.empty(len(vectors), dtype=np.int64)
    for i in range(0, len(vectors), BLOCK):
        part = slice(i, i + BLOCK)
        difference = vectors[part].astype(np.int64) - (centroid if centroid.ndim == 1 else centroid[part])
        result[part] = np.einsum("ij,ij->i", difference, difference)
    return result


def displacements(history: np.ndarray) -> np.ndarray:
    """Norms of the displacement of every centroid from each earlier round to the last one: round x centroid."""
    moved = (history[-1][None] - history).astype(np.float64)
    return np.sqrt((moved**2).sum(axis=2))


def assigned(vectors: np.ndarray, known: np.ndarray, rounds: np.ndarray, cluster: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Nearest centroid of each vector, ties to the smaller number; evaluated distances go into ``known`` and ``rounds``.

    ``known`` are squared distances and ``rounds`` when they were evaluated, both vector x centroid.
    """
    now, centroids = len(history) - 1, history[-1]
    every = np.arange(len(vectors))
    moved = displacements(history)[rounds, np.arange(len(centroids))[None, :]]
    distance = np.sqrt(known.astype(np.float64))
    slack = MARGIN * (1 + distance + moved)
    lower, upper = distance - moved - slack, (distance + moved + slack)[every, cluster]

    def evaluate(rows: np.ndarray, numbers: np.ndarray) -> None:
        known[rows, numbers] = squared(vectors[rows], centroids[numbers])
        rounds[rows, numbers] = now

    # A centroid may be the nearest, or as near, if its lower bound reaches the upper bound of the present one.
    def open_to(rows: np.ndarray) -> np.ndarray:
        reached = lower[rows] <= upper[rows, None]
        reached[np.arange(len(rows)), cluster[rows]] = False
        return reached

    rows = np.flatnonzero(open_to(every).any(axis=1))
    stale = rows[rounds[rows, cluster[rows]] != now]
    evaluate(stale, cluster[stale])
    upper[rows] = np.sqrt(known[rows, cluster[rows]].astype(np.float64)) * (1 + MARGIN) + MARGIN
    reached = open_to(rows)
    places, numbers = np.nonzero(reached & (rounds[rows] != now))
    evaluate(rows[places], numbers)
    # Evaluated distances alone decide; the nearest centroid is among them.
    candidates = np.where(rounds[rows] == now, known[rows], LONG)
    result = cluster.copy()
    result[rows] = candidates.argmin(axis=1)
    return result


STATE = "vec_id long, vector array<int>, cluster int, known array<long>, rounds array<tinyint>"


def _batch(ids: pa.Array, vectors: pa.Array, cluster: np.ndarray, known: np.ndarray, rounds: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, vectors, pa.array(cluster.astype(np.int32)), _lists(known), _lists(rounds.astype(np.int8))],
        names=["vec_id", "vector", "cluster", "known", "rounds"],
    )


def _first_round(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            known = np.stack([squared(vectors, c) for c in centroids], axis=1)
            yield _batch(batch.column("vec_id"), batch.column("vector"), known.argmin(axis=1), known, np.zeros_like(known))

    return run


def _next_round(history: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, width = history.shape[1:]
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            known = _matrix(batch.column("known"), count).copy()
            rounds = _matrix(batch.column("rounds"), count).astype(np.int64)
            cluster = assigned(vectors, known, rounds, batch.column("cluster").to_numpy().astype(np.int64), history)
            yield _batch(batch.column("vec_id"), batch.column("vector"), cluster, known, rounds)

    return run


SUMS = "cluster int, n long, sums array<long>"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of the vectors of every cluster, batch by batch; sums of a batch fit into longs."""
    for batch in batches:
        cluster = batch.column("cluster").to_numpy()
        if not len(cluster):
            continue
        vectors = _matrix(batch.column("vector"), len(batch.column("vector")[0])).astype(np.int64)
        numbers, places, n = np.unique(cluster, return_inverse=True, return_counts=True)
        sums = np.zeros((len(numbers), vectors.shape[1]), dtype=np.int64)
        np.add.at(sums, places, vectors)
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(n), _lists(sums)], names=["cluster", "n", "sums"])


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by the floor of their vectors' means; empty clusters keep theirs."""
    parts = state.select("cluster", "vector").mapInArrow(_sums, SUMS)
    long = parts.select("cluster", "n", F.posexplode("sums").alias("place", "value"))
    totals = long.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    )
    result = centroids.copy()
    for row in totals.collect():  # one row per centroid and component
        result[row.cluster, row.place] = int(row.total) // row.n
    return result


def centroid_digest(centroid: np.ndarray) -> str:
    return sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def clustered(vectors: DataFrame, clusters: int = 16, rounds: int = 3, length: int = 64, seed: int = 1) -> DataFrame:
    """Cluster of every vector after ``rounds`` rounds and a last assignment.

    ``vectors`` holds ``vec_id`` and ``vector``; components x count as floor(64 * x), at most ``LIMIT`` away from 0. Vectors of
    another length, null ones, and those with a null or non-finite component take no part. The first centroids are the
    ``clusters`` vectors with the smallest sha256 of ``<seed>:<vec_id>``; with fewer vectors there are fewer centroids.
    Ties go to the centroid of the smaller number. Vectors without id never start a centroid, but have a row; repeated rows
    count each. Result: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``; no vectors with id give no rows. Sums beyond a long are cut to the largest one. Other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    whole = cut_lineage(named.mapInArrow(_whole(length), "vec_id long, vector array<int>"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = whole.where(F.col("vec_id").isNotNull()).orderBy(order, "vector").limit(clusters).collect()
    if not first:
        schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], schema)
    history = [np.array([row.vector for row in first], dtype=np.int64)]
    state = cut_lineage(whole.mapInArrow(_first_round(history[0]), STATE))
    for _ in range(rounds):
        history.append(_moved(state, history[-1]))
        state = cut_lineage(state.mapInArrow(_next_round(np.stack(history)), STATE))
    return _measured(state, history[-1])


def _distances(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cluster = _matrix(batch.column("vector"), centroids.shape[1]), batch.column("cluster")
            distance = squared(vectors, centroids[cluster.to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), cluster, pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return run


def _measured(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Distances to the last centroids and their sums by cluster and in all."""
    kind = "vec_id long, cluster int, distance long"
    rows = cut_lineage(state.select("vec_id", "cluster", "vector").mapInArrow(_distances(centroids), kind))
    totals = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    sums = {row.cluster: int(row.total) for row in totals}  # one row per centroid
    table = [
        (number, min(total, LONG), min(sum(sums.values()), LONG), centroid_digest(centroids[number]))
        for number, total in sums.items()
    ]
    known = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def clustered_sql(clusters: int = 16, rounds: int = 3, length: int = 64, seed: int = 1) -> str:
    """SQL of :func:`clustered` on ``embeddings``."""
    parts = [
        f"""whole AS (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c, v FROM whole
  WHERE vec_id IS NOT NULL QUALIFY c < {clusters})""",
    ]
    distance = "CAST(list_sum(list_transform(list_zip(w.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    for t in range(rounds + 1):
        parts.append(
            f"""a{t} AS (SELECT r, least.c AS c, least.d AS d FROM (SELECT w.r, min({{'d': {distance}, 'c': k.c}}) AS least
  FROM whole w, c{t} k GROUP BY w.r))"""
        )
        if t < rounds:
            parts.append(
                f"""m{t} AS (SELECT c, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT a.c, unnest(w.v) AS x,
  generate_subscripts(w.v, 1) AS p FROM a{t} a JOIN whole w USING (r)) GROUP BY c, p),
c{t + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM c{t} k LEFT JOIN (SELECT c,
  list((s - ((s % n) + n) % n) // n ORDER BY p) AS v FROM m{t} GROUP BY c) m ON m.c = k.c)"""
            )
    last = rounds
    return f"""WITH {", ".join(parts)}
SELECT w.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{last} a JOIN whole w USING (r) JOIN c{last} k ON k.c = a.c"""
