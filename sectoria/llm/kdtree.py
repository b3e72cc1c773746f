"""Exact search of the largest inner products with one KD-tree per shard.

Vectors are dealt into shards of about ``SHARD`` rows, and the queries go, in blocks, to every shard. A shard's tree splits
at the median of its widest dimension and keeps the tight box of every node. The inner product of a query with any vector
of a box is at most the sum over the dimensions of the larger product with the box's two sides. Nodes are visited from the
highest bound down and the search ends where a bound falls below the k-th best score. That score is propagated: every
query starts with the k-th best of a bounded seed of vectors, so most shards are left after few nodes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SHARD = 2048
LEAF = 64
# Vectors whose scores give the first bound; sent to every task.
SEED = 512
SCALE = 1024.0
LONG = (-(1 << 63), (1 << 63) - 1)
FOUND = "query_id long, vec_id long, score long"


def exact_kind(*arrays: np.ndarray) -> type:
    """Number type in which inner products of these integer-valued arrays are exact."""
    largest = [float(np.abs(a).max()) if a.size else 0.0 for a in arrays]
    size = max(1, *(a.shape[-1] for a in arrays))
    bound = size * max(largest) ** 2 if len(largest) == 1 else size * largest[0] * largest[1]
    return np.float64 if bound < 2**52 else np.int64 if bound < 2**61 else object


def as_kind(array: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in array], dtype=object).reshape(array.shape)
    return array.astype(kind)


def cut_long(numbers: np.ndarray) -> np.ndarray:
    """Numbers of any size cut to 64 bits; other kinds hold none beyond."""
    return np.clip(numbers, *LONG) if numbers.dtype == object else numbers


class Tree:
    """KD-tree over the rows of an integer-valued matrix."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors = ids, vectors
        self.rows: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._leaf = leaf
        self._build(np.arange(len(ids)))
        self.boxes = np.vstack(self.low), np.vstack(self.high)

    def _build(self, rows: np.ndarray) -> int:
        node = len(self.rows)
        part = self.vectors[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        self.rows.append(rows)
        self.children.append(None)
        self.low.append(low)
        self.high.append(high)
        if len(rows) > self._leaf and (high > low).any():
            widest = int(np.argmax(high - low))
            order = np.argsort(part[:, widest], kind="stable")
            half = len(rows) // 2
            self.rows[node] = None
            self.children[node] = self._build(rows[order[:half]]), self._build(rows[order[half:]])
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product that a vector in a node's box can have: one row per query."""
        low, high = self.boxes
        return cut_long(np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T)

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, k: int, least) -> list[tuple[int, int]]:
        """Best ``k`` of (score, -id) among rows of other ids with scores of at least ``least``; smaller ids win ties."""
        best: list[tuple[int, int]] = []
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if least is not None and -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if least is None or bounds[child] >= least:
                        heapq.heappush(waiting, (-bounds[child], child))
                continue
            rows = self.rows[node]
            ids, scores = self.ids[rows], cut_long(self.vectors[rows] @ query)
            fit = ids != own
            if least is not None:
                fit &= (scores >= least).astype(bool)
            ids, scores = ids[fit], scores[fit]
            for i in np.lexsort((ids, [-s for s in scores] if scores.dtype == object else -scores))[:k]:
                entry = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                least = best[0][0] if least is None else max(least, best[0][0])
        return best


def _quantized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as whole numbers in doubles; a vector that is null or holds null or no finite number is left out."""
    for batch in batches:
        ids, vectors = [], []
        for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
            values = vector.values
            if vec_id is None or values is None or values.null_count:
                continue
            numbers = np.floor(values.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            if np.isfinite(numbers).all():
                ids.append(vec_id)
                vectors.append(numbers)
        ends = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int32)
        flat = np.concatenate(vectors) if vectors else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, type=pa.int64()), pa.ListArray.from_arrays(ends, flat)], names=["vec_id", "vector"]
        )


def _matrix(rows: list[pa.Array]) -> np.ndarray:
    """Equal-length lists as a matrix."""
    return np.vstack([np.vstack([v.values.to_numpy() for v in part]) if len(part) else np.zeros((0, 0)) for part in rows])


def _first_bounds(seed, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds: list[float | None] = []
            for own, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector"), strict=True):
                query = vector.values.to_numpy()
                ids, vectors = seed.value.get(len(query), (np.zeros(0), np.zeros((0, len(query)))))
                others = vectors[ids != own]
                kind = exact_kind(query, others)
                scores = np.sort(as_kind(others, kind) @ as_kind(query[None, :], kind)[0]) if len(others) >= k else None
                # A bound that a double does not hold exactly is lowered, which stays right.
                bounds.append(None if scores is None else np.nextafter(float(scores[-k]), -np.inf))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(bounds, type=pa.float64())],
                names=["vec_id", "vector", "bound"],
            )

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come shard by shard, first its vectors and then the queries."""
        shard, ids, parts, tree = None, [], [], None

        for batch in batches:
            shards = np.array(batch.column("shard").to_pylist())
            queried = batch.column("queried").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((shards[1:] != shards[:-1]) | (queried[1:] != queried[:-1])) + 1
            for low, high in zip([0, *change], [*change, len(shards)], strict=True):
                part = batch.slice(low, high - low)
                if shards[low] != shard:
                    shard, ids, parts, tree = shards[low], [], [], None
                own, vectors = part.column("vec_id").to_numpy(), part.column("vector")
                if not queried[low]:
                    ids.append(own)
                    parts.append(vectors)
                    continue
                if not parts:
                    continue
                queries = _matrix([vectors])
                if tree is None:
                    matrix = _matrix(parts)
                    kind = exact_kind(matrix)
                    tree = Tree(np.concatenate(ids), as_kind(matrix, kind))
                if (needed := exact_kind(queries, tree.vectors)) is not tree.vectors.dtype.type:
                    kind = object if object in (needed, tree.vectors.dtype.type) else np.int64
                    tree = Tree(tree.ids, as_kind(_matrix(parts), kind))
                queries = as_kind(queries, object if tree.vectors.dtype == object else tree.vectors.dtype.type)
                limits = part.column("bound").to_pylist()
                found: list[tuple[int, int, int]] = []
                for first in range(0, len(queries), 256):
                    bounds = tree.bounds(queries[first : first + 256])
                    for i, limit in enumerate(bounds, start=first):
                        for score, other in tree.search(int(own[i]), queries[i], limit, k, limits[i]):
                            found.append((int(own[i]), -other, score))
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
                    )

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """Largest inner products of every query with all vectors of other ids: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both inputs hold ``vec_id`` and ``vector``; components x count as floor(1024 * x). Rows without id, and vectors that are
    null or hold null or no finite number, take no part. Vectors of another length than the query's are not compared. Ties
    go to the smaller id; repeated rows are found as often as they stand. Of several queries of one id the smallest vector
    counts. Scores beyond 64 bits are cut to the nearest long before they are compared.
    """
    spark = vectors.sparkSession
    kind = "vec_id long, vector array<double>"
    whole = cut_lineage(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "vector").mapInArrow(_quantized, kind))
    asked = (
        queries.select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
        .mapInArrow(_quantized, kind)
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
    )
    seed: dict[int, list] = {}
    for row in whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED).collect():
        seed.setdefault(len(row.vector), []).append(row)
    shared = spark.sparkContext.broadcast(
        {n: (np.array([r.vec_id for r in rows]), np.array([r.vector for r in rows]).reshape(len(rows), n)) for n, rows in seed.items()}
    )
    sizes = whole.groupBy(F.size("vector").alias("length")).agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("shards"))
    sizes = cut_lineage(sizes)
    total = sizes.agg(F.sum("shards")).first()[0] or 1

    def dealt(df: DataFrame, shard) -> DataFrame:
        return df.join(sizes, F.size("vector") == F.col("length")).withColumn("shard", shard)

    stored = dealt(whole, F.pmod(F.xxhash64("vec_id"), F.col("shards"))).withColumns(
        {"queried": F.lit(False), "bound": F.lit(None).cast("double")}
    )
    bounded = asked.mapInArrow(_first_bounds(shared, k), kind + ", bound double")
    sent = dealt(bounded, F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("queried", F.lit(True))
    names = ("length", "shard", "queried", "vec_id", "vector", "bound")
    found = (
        stored.select(*names)
        .unionByName(sent.select(*names))
        .withColumn("shard", F.concat_ws("/", "length", "shard"))
        .repartitionByRange(int(total), "shard")
        .sortWithinPartitions("shard", "queried", "vec_id")
        .mapInArrow(_search(k), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


NEAREST_SQL = """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vector, c.vector) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.vector) = len(c.vector) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10"""
