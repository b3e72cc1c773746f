"""Near-duplicate documents by a set similarity join over chosen paths.

Documents are sets of word shingles; equal sets are one class. Every tree branches the classes by minwise tokens: a class
goes down the path that starts with its smallest shingle under a hash function of the tree. Nodes of at most ``SMALL``
classes are compared exhaustively. Larger nodes branch again, by ``BRANCHES`` tokens at every further level. What is still
large at the last level is a crowd of copies: it is dealt into random chunks, each with the member next to the crowd's
consensus, and compared exhaustively within the chunk. That links most of a crowd cheaply; the members of crowds that are
not in one component then go through an exact join (``crowd_links``).

At similarity s a tree of one level keeps a pair together with probability s, every further level with
``1 - (1 - s) ** BRANCHES``. With s = 0.85, ``TREES`` = 8 trees miss a linked pair with probability below 3e-7 if its
nodes are small at once, and below 2e-6 after all levels, inside a crowd as outside. Links are confirmed on whole sets,
never on sketches.

The first tree alone is compared and linked first; of the other trees only nodes with classes that are not linked yet are
looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bytetext import LOWER, byte_column, mixed, released, text_chunks, word_hashes, word_spans

TREES = 8
LEVELS = 3
BRANCHES = 2
SMALL = 16
CHUNK = 10
# The exact join takes a shingle as common if its bucket, of 2 ** BUCKET_BITS, stands in more than COMMON members of crowds.
COMMON = 64
BUCKET_BITS = 26
BLOCK = 2000
# More than the blocks of one size class; numbers of blocks stay below 2^31.
BLOCKS = 1 << 20
# Ids that may be sent to every task: at most some 20 MB.
FEW_IDS = 1_000_000
PER_TREE = 1 + (LEVELS - 1) * BRANCHES
FUNCTIONS = TREES * PER_TREE
# Three bits of every minwise token make a sketch of 2 * 60 bits. At similarity 0.85 about 9 of them differ, with a
# deviation of 4; 36 leaves a margin of more than six deviations.
SKETCH_BITS = 3
FAR_BITS = 36
SEEDS = mixed(np.arange(1, FUNCTIONS + 1, dtype=np.uint64))
FACTORS = mixed(np.arange(1001, FUNCTIONS + 1001, dtype=np.uint64)) | np.uint64(1)
SIGNED = "doc_id long, n_shingles long, digest binary, tokens array<long>, sketch_a long, sketch_b long"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text, A-Z lower-cased; texts with fewer words have one shingle."""
    lowered = LOWER[data]
    starts, stops, before = word_spans(lowered, offsets)
    words = word_hashes(lowered, starts, stops)
    rows = max(0, len(words) - width + 1)
    joined = np.zeros(rows, dtype=np.uint64)
    for k in range(width):
        joined += words[k : k + rows] * FACTORS[k]
    joined = mixed(joined)
    sets = []
    for first, last in zip(before[:-1], before[1:], strict=True):
        if last - first >= width:
            sets.append(np.unique(joined[first : last - width + 1]))
        elif last > first:
            whole = (words[first:last] * FACTORS[: last - first]).sum(dtype=np.uint64) + np.uint64(last - first)
            sets.append(mixed(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(words[:0])
    return sets


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest hash of each set under every function; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    values, starts = np.concatenate(sets), np.cumsum(sizes) - sizes
    result = np.empty((len(sets), FUNCTIONS), dtype=np.uint64)
    for k in range(FUNCTIONS):
        hashed = (values ^ SEEDS[k]) * FACTORS[k]
        hashed ^= hashed >> np.uint64(32)
        hashed *= FACTORS[k - 1]
        result[:, k] = np.minimum.reduceat(hashed, starts)
    return result


def _sketch(tokens: np.ndarray) -> np.ndarray:
    low = mixed(tokens) & np.uint64((1 << SKETCH_BITS) - 1)
    places = np.arange(tokens.shape[1], dtype=np.uint64) * np.uint64(SKETCH_BITS)
    return (low << places).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            ids = batch.column("doc_id")
            for first, last in text_chunks(offsets):
                low, high = int(offsets[first]), int(offsets[last])
                sets = shingle_sets(data[low:high], offsets[first : last + 1] - low, width)
                full = np.flatnonzero([len(s) > 0 for s in sets])
                tokens = np.zeros((len(sets), FUNCTIONS), dtype=np.uint64)
                if len(full):
                    tokens[full] = minima([sets[i] for i in full])
                half = FUNCTIONS // 2
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first).cast(pa.int64()),
                        pa.array([len(s) for s in sets], type=pa.int64()),
                        pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], type=pa.binary()),
                        pa.ListArray.from_arrays(
                            np.arange(len(sets) + 1, dtype=np.int32) * FUNCTIONS, tokens.view(np.int64).ravel()
                        ),
                        pa.array(_sketch(tokens[:, :half])),
                        pa.array(_sketch(tokens[:, half:])),
                    ],
                    names=["doc_id", "n_shingles", "digest", "tokens", "sketch_a", "sketch_b"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            ids = batch.column("doc_id")
            for first, last in text_chunks(offsets):
                low, high = int(offsets[first]), int(offsets[last])
                sets = shingle_sets(data[low:high], offsets[first : last + 1] - low, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first).cast(pa.int64()),
                        pa.array([s.tobytes() for s in sets], type=pa.binary()),
                    ],
                    names=["rep", "shingles"],
                )

    return run


def _root(parents: list[int] | dict[int, int], i: int) -> int:
    while parents[i] != i:
        parents[i] = parents[parents[i]]
        i = parents[i]
    return i


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets have ``percent`` of their union in common."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def linked_pairs(reps: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that connect the members of one group; a pair that is connected already is not compared."""
    parents = list(range(len(reps)))
    for i in range(len(reps)):
        for j in range(i):
            a, b = sets[i], sets[j]
            small, large = sorted((len(a), len(b)))
            if 100 * small < percent * large or _root(parents, i) == _root(parents, j):
                continue
            if linked(a, b, percent):
                parents[_root(parents, i)] = _root(parents, j)
                yield reps[j], reps[i]


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their group; a group has few rows and may go over batches."""
        group, reps, sets = None, [], []

        def links() -> pa.RecordBatch | None:
            found = list(linked_pairs(reps, sets, percent))
            if not found:
                return None
            return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in zip(*found)], names=["a", "b"])

        for batch in batches:
            for key, rep, shingles in zip(
                batch.column("node").to_pylist(), batch.column("rep").to_pylist(), batch.column("shingles"), strict=True
            ):
                if key != group:
                    if (found := links()) is not None:
                        yield found
                    group, reps, sets = key, [], []
                reps.append(rep)
                sets.append(np.frombuffer(shingles.as_buffer(), dtype=np.uint64))
        if (found := links()) is not None:
            yield found

    return run


def connected(edges: DataFrame) -> DataFrame:
    """Smallest vertex reachable from every vertex of ``edges`` (``a``, ``b``): columns ``v``, ``component``.

    Labels go to neighbours, then every label is replaced by the label of the vertex it names, until nothing changes.
    """
    both = cut_lineage(
        edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
        .unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        .distinct()
    )
    labels = cut_lineage(both.groupBy("v").agg(F.least("v", F.min("u")).alias("component")))
    while True:
        near = (
            both.join(labels.select(F.col("v").alias("u"), "component"), "u")
            .groupBy("v")
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "v").select("v", F.least("component", "near").alias("named"), "component")
        names = labels.select(F.col("v").alias("named"), F.col("component").alias("next"))
        moved = cut_lineage(
            hooked.join(names, "named").select(
                "v", F.least("named", "next").alias("component"), F.col("component").alias("old")
            )
        )
        changed = moved.where(F.col("component") != F.col("old")).limit(1).count()
        labels = moved.select("v", "component")
        if not changed:
            return labels


def _branches(nodes: DataFrame, classes: DataFrame, level: int) -> DataFrame:
    """Next level of the paths: every member of ``nodes`` goes to one child for each of its next tokens."""
    member = nodes.select("rep", "tree", "node").join(classes, "rep")

    def token(branch: int):
        place = F.col("tree") * PER_TREE + 2 + (level - 2) * BRANCHES + branch
        return F.xxhash64("node", F.lit(branch), F.element_at("tokens", place.cast("int")))

    children = F.explode(F.array(*[token(b) for b in range(BRANCHES)])).alias("node")
    return member.select("rep", "n_shingles", "sketch_a", "sketch_b", "tree", children)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of nodes with at least two classes, with the node's size."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    return cut_lineage(rows.join(sizes, "node"))


def _chunks(crowd: DataFrame) -> DataFrame:
    """Large nodes dealt into random chunks, each with the member that agrees best with most bits of the node."""
    # One bit of every token is enough to tell the member that agrees with most.
    bits = range(0, FUNCTIONS // 2 * SKETCH_BITS, SKETCH_BITS)
    sketches = ("sketch_a", "sketch_b")
    sums = [F.sum(F.shiftright(s, i).bitwiseAND(F.lit(1))).alias(f"{s}_{i}") for s in sketches for i in bits]
    counted = crowd.groupBy("node").agg(F.count(F.lit(1)).alias("all"), *sums)

    def majority(sketch: str):
        each = [F.when(F.col(f"{sketch}_{i}") * 2 > F.col("all"), 1 << i).otherwise(0).cast("long") for i in bits]
        return sum(each[1:], each[0]).alias(f"most_{sketch}")

    consensus = cut_lineage(counted.select("node", *[majority(s) for s in sketches]))
    mask = F.lit(sum(1 << i for i in bits))
    distance = sum(F.bit_count(F.col(s).bitwiseXOR(F.col(f"most_{s}")).bitwiseAND(mask)) for s in sketches)
    columns = ("rep", "n_shingles", "sketch_a", "sketch_b")
    nearest = F.min_by(F.struct(*columns), F.struct(distance, "rep")).alias("pivot")
    pivots = crowd.join(consensus, "node").groupBy("node").agg(nearest)
    parts = F.ceil(F.col("size") / CHUNK)
    dealt = crowd.withColumn("part", F.pmod(F.xxhash64("rep", "node"), parts))
    heads = (
        crowd.select("tree", "node", "size")
        .distinct()
        .join(pivots, "node")
        .select("tree", "node", "pivot.*", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    )
    return (
        dealt.select(*heads.columns)
        .unionByName(heads)
        .withColumn("node", F.xxhash64("node", "part"))
        .drop("part")
        .dropDuplicates(["node", "rep"])
    )


def compared_groups(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups whose members are compared with each other: ``tree``, ``node``, ``members`` (id, size and sketch).

    The second table has the members of the crowds: ``node``, ``rep``.
    """
    rows = classes.select(
        "rep",
        "n_shingles",
        "sketch_a",
        "sketch_b",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("tree"),
                        F.xxhash64(F.lit(t), F.element_at("tokens", t * PER_TREE + 1)).alias("node"),
                    )
                    for t in range(TREES)
                ]
            )
        ).alias("at"),
    ).select("rep", "n_shingles", "sketch_a", "sketch_b", "at.*")
    groups = []
    for level in range(2, LEVELS + 2):
        counted = _counted(rows)
        groups.append(counted.where(F.col("size") <= SMALL).drop("size"))
        crowd = counted.where(F.col("size") > SMALL)
        if level <= LEVELS:
            rows = _branches(crowd, classes.select("rep", "tokens", "n_shingles", "sketch_a", "sketch_b"), level)
    groups.append(_chunks(crowd).select(*groups[0].columns))
    members = F.sort_array(F.collect_list(F.struct("rep", "n_shingles", "sketch_a", "sketch_b"))).alias("members")
    merged = reduce(DataFrame.unionByName, groups).groupBy("tree", "node").agg(members)
    # The same members often meet in several trees; the first of them stands for all.
    groups = cut_lineage(
        merged.groupBy("members").agg(F.min_by(F.struct("tree", "node"), F.struct("tree", "node")).alias("at"))
        .select("at.*", "members")
    )
    return groups, crowd.select("node", "rep")


def _close_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of every group whose sizes and sketches allow a link."""
    pairs = groups.select("tree", "node", F.posexplode("members").alias("place", "x"), "members").select(
        "tree", "node", "x", F.explode(F.slice("members", F.col("place") + 2, F.size("members"))).alias("y")
    )
    far = F.bit_count(F.col("x.sketch_a").bitwiseXOR(F.col("y.sketch_a"))) + F.bit_count(
        F.col("x.sketch_b").bitwiseXOR(F.col("y.sketch_b"))
    )
    least, most = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    return pairs.where((far <= FAR_BITS) & (least * 100 >= most * percent)).select(
        "tree", "node", F.col("x.rep").alias("a"), F.col("y.rep").alias("b")
    )


def of_ids(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi- or anti-join with distinct ids. At most ``FEW_IDS`` go to every task, so that no text is shuffled; more are joined."""
    ids = cut_lineage(ids.select("doc_id").distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", how)


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), dtype=np.uint64)
        buckets, n = np.unique(tokens >> np.uint64(64 - BUCKET_BITS), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(n)], names=["bucket", "n"])


def common_buckets(sets: DataFrame) -> np.ndarray:
    """One bit for every bucket: whether its shingles stand in more than ``COMMON`` of the sets."""
    counts = sets.mapInArrow(released(_bucket_counts), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    common = counts.where(F.col("n") > COMMON).select("bucket").toPandas()["bucket"].to_numpy()
    bits = np.zeros(1 << BUCKET_BITS, dtype=bool)
    bits[common] = True
    return np.packbits(bits, bitorder="little")


PROFILE = "rep long, n long, rare array<long>, digest binary, n_core long, core binary, parity binary"
# Bits of a set's parity: bit i says whether an odd number of its shingles fall on i.
PARITY = 1024


def _profile(percent: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rare shingles of each prefix; the core of common shingles where that alone may give a link."""
        bits = common.value
        for batch in batches:
            rows = []
            for rep, shingles in zip(batch.column("rep").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                tokens = np.frombuffer(shingles, dtype=np.uint64)
                bucket = tokens >> np.uint64(64 - BUCKET_BITS)
                hot = (bits[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                n, core = len(tokens), tokens[hot]
                least = -(-percent * n // 100)
                rare = tokens[~hot][: n - least + 1].view(np.int64)
                alone = core.tobytes() if len(core) >= least else None
                odd = np.bincount((tokens % PARITY).astype(np.int64), minlength=PARITY) & 1
                parity = np.packbits(odd.astype(bool)).tobytes()
                rows.append((rep, n, rare, alone and hashlib.md5(alone).digest(), len(core), alone, parity))
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.binary(), pa.binary())
            columns = zip(*rows) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(columns, types)],
                names=["rep", "n", "rare", "digest", "n_core", "core", "parity"],
            )

    return run


def possible_pairs(components: np.ndarray, sizes: np.ndarray, parities: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members of two components that may be linked, as their places.

    Two parities differ in no more bits than the sets have shingles apart, of which a link allows a share of all. So no link
    is lost here.
    """
    first, second = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for i in range(1, len(sizes)):
        both = sizes[:i] + sizes[i]
        apart = np.bitwise_count(parities[:i] ^ parities[i]).sum(axis=1, dtype=np.int64)
        common = -(-percent * both // (100 + percent))
        fits = np.flatnonzero((apart <= both - 2 * common) & (components[:i] != components[i]))
        first.append(fits)
        second.append(np.full(len(fits), i))
    return np.concatenate(first), np.concatenate(second)


def possible_members(components: np.ndarray, sizes: np.ndarray, parities: np.ndarray, percent: int) -> np.ndarray:
    """Members that may be linked with one of another component."""
    found = np.zeros(len(sizes), dtype=bool)
    found[np.concatenate(possible_pairs(components, sizes, parities, percent))] = True
    return found


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their node, which has few rows and may go over batches."""
        node, rows = None, []

        def pairs() -> np.ndarray:
            if len(rows) < 2:
                return np.zeros((2, 0), dtype=np.int64)
            reps, components, sizes, parities = zip(*rows, strict=True)
            bits = np.frombuffer(b"".join(parities), dtype=np.uint64).reshape(len(rows), -1)
            return np.sort(np.array(reps)[np.array(possible_pairs(np.array(components), np.array(sizes), bits, percent))], axis=0)

        def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1)], names=["a", "b"])

        for batch in batches:
            found = [np.zeros((2, 0), dtype=np.int64)]
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("node", "rep", "component", "n", "parity")), strict=True):
                if key != node:
                    found.append(pairs())
                    node, rows = key, []
                rows.append(row)
            yield batch_of(found)
        yield batch_of([pairs()])

    return run


def _compare_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their pair of blocks, sets (without ``b``) before the pairs to compare."""
        block, sets, parents = None, {}, {}
        for batch in batches:
            found = []
            names = ("row_block", "head_block", "a", "b")
            for i, j, a, b, shingles in zip(*(batch.column(c).to_pylist() for c in names), batch.column("shingles"), strict=True):
                if (i, j) != block:
                    block, sets, parents = (i, j), {}, {}
                if b is None:
                    # Different texts of one id have a set each.
                    sets.setdefault(a, []).append(np.frombuffer(shingles.as_buffer(), dtype=np.uint64))
                    parents[a] = a
                    continue
                x, y = _root(parents, a), _root(parents, b)
                if x != y and any(linked(s, t, percent) for s in sets[a] for t in sets[b]):
                    parents[x] = y
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], type=pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def _pair_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs`` (``a``, ``b``, stored) that connect the same as all links among them.

    Members fall into blocks. A set is sent once to every pair of blocks in which a pair needs it, however many pairs that
    are.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = F.explode(F.array("a", "b")).alias("rep")
    blocks = max(1, -(-pairs.select(members).distinct().count() // BLOCK))
    number = [F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias(n) for c, n in (("a", "row_block"), ("b", "head_block"))]
    placed = pairs.select(*number, "a", "b", F.lit(None).cast("binary").alias("shingles"))
    needed = placed.select("row_block", "head_block", members).distinct().join(sets, "rep")
    given = needed.select("row_block", "head_block", F.col("rep").alias("a"), F.lit(None).cast("long").alias("b"), "shingles")
    return (
        placed.unionByName(given)
        .repartition(parts, "row_block", "head_block")
        .sortWithinPartitions("row_block", "head_block", F.col("b").isNotNull())
        .mapInArrow(released(_compare_pairs(percent)), "a long, b long")
    )


def _distinct_groups(rows: DataFrame, *conditions) -> DataFrame:
    """Groups of ``rep`` by ``node``, each set of members once; only groups that meet the conditions on their rows."""
    members = F.sort_array(F.collect_set("rep")).alias("members")
    tests = [c.alias(f"test_{i}") for i, c in enumerate(conditions)]
    groups = rows.groupBy("node").agg(members, *tests)
    for i in range(len(conditions)):
        groups = groups.where(f"test_{i}")
    return groups.groupBy("members").agg(F.min("node").alias("node")).select("node", F.explode("members").alias("rep"))


def core_links(rows: list, heads: list, percent: int) -> Iterator[tuple[int, int]]:
    """Links that the cores alone give between ``rows`` and ``heads`` (id, component, size, core) of two components."""
    sizes = np.array([len(r[3]) for r in rows])
    vocabulary, codes = np.unique(np.concatenate([r[3] for r in rows]), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    components, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    for rep, component, size, core in heads:
        at = np.searchsorted(vocabulary, core)
        at[at == len(vocabulary)] = 0
        mark = np.zeros(len(vocabulary), dtype=np.int32)
        mark[at[vocabulary[at] == core]] = 1
        both = np.add.reduceat(mark[codes], starts).astype(np.int64)
        for i in np.flatnonzero((100 * both >= percent * (n + size - both)) & (components != component)):
            yield rows[i][0], rep


def _core_blocks(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in the order of their pair of blocks."""
        pair, sides = None, ([], [])

        def links() -> pa.RecordBatch:
            # Of the links of a pair of blocks, those that connect its components are enough.
            found, parents = [], {}
            if all(sides):
                of = {r[0]: r[1] for side in sides for r in side}
                for a, b in core_links(*sides, percent):
                    x, y = of[a], of[b]
                    while parents.get(x, x) != x:
                        x = parents[x]
                    while parents.get(y, y) != y:
                        y = parents[y]
                    if x != y:
                        parents[x] = y
                        found.append((a, b))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], type=pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            names = ("row_block", "head_block", "head", "rep", "component", "n", "core")
            for i, j, head, *row, core in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if (i, j) != pair:
                    yield links()
                    pair, sides = (i, j), ([], [])
                sides[head].append((*row, np.frombuffer(core, dtype=np.uint64)))
        yield links()

    return run


def _core_pairs(alone: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Links between members of different cores, each of the members compared with the heads of the other cores.

    A link of a with b means one of a with the head of b's core, which is no larger than b, and one of b with the head of
    a's core; so links to heads connect the same. Of the members of one core in one component the smallest is enough, and the largest
    component is not compared with itself. Blocks meet blocks of their own and the neighbouring size classes only.
    """
    parts = int(alone.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = F.min(F.struct("n", "rep", "core")).alias("least")
    rows = cut_lineage(alone.groupBy("digest", "component").agg(least).select("digest", "component", "least.*"))
    largest = rows.groupBy("component").count().orderBy(F.desc("count"), "component").first()
    heads = heads.select(F.col("head").alias("rep")).join(alone, "rep").dropDuplicates(["rep"])

    # Sizes of linked sets differ by a factor of 100 / percent at most, so by one class of a slightly larger factor.
    width = math.log(100 / percent) + 1e-3
    size_class = F.floor(F.log("n") / F.lit(width)).cast("int")

    def blocks(of: DataFrame) -> tuple[DataFrame, dict[int, int]]:
        """Blocks of one size class each, and their number by class. Blocks of the largest component have odd numbers."""
        of = of.select("rep", "component", "n", "core", size_class.alias("sizes"))
        few = {r.sizes: -(-r["count"] // BLOCK) for r in of.groupBy("sizes").count().collect()}
        share = F.create_map(*[F.lit(x) for item in few.items() for x in item])[F.col("sizes")]
        number = F.col("sizes") * BLOCKS + F.pmod(F.xxhash64("rep"), share)
        return of.withColumn("block", (number * 2 + (F.col("component") == largest.component).cast("int")).cast("int")), few

    def near(few: dict[int, int], sizes: int) -> list[int]:
        return [(c * BLOCKS + k) * 2 + odd for c in range(sizes - 1, sizes + 2) for k in range(few.get(c, 0)) for odd in (0, 1)]

    left, left_blocks = blocks(rows)
    right, right_blocks = blocks(cut_lineage(heads))

    def against(of: DataFrame, head: int, mine: str, others: str, own: dict[int, int], few: dict[int, int]) -> DataFrame:
        numbers = {c: F.array(*[F.lit(k) for k in near(few, c)]).cast("array<int>") for c in own}
        choice = F.create_map(*[x for c, found in numbers.items() for x in (F.lit(c), found)])[F.col("sizes")]
        each = of.withColumn(others, F.explode(choice))
        each = each.where((F.col("block") % 2 == 0) | (F.col(others) % 2 == 0))
        return each.select(
            F.col("block").alias(mine), F.col(others).alias(others), F.lit(head).alias("head"),
            "rep", "component", "n", "core",
        )

    return (
        against(left, 0, "row_block", "head_block", left_blocks, right_blocks)
        .unionByName(against(right, 1, "head_block", "row_block", right_blocks, left_blocks))
        .repartition(parts, "row_block", "head_block")
        .sortWithinPartitions("row_block", "head_block")
        .mapInArrow(released(_core_blocks(percent)), "a long, b long")
    )


def crowd_links(sets: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links that connect all that ``links`` leave apart among ``sets`` (``rep``, ``shingles``), without loss.

    Shingles are ordered rare ones first, so two linked sets share one in their prefixes. Is it rare, they meet under it,
    with at most ``COMMON`` others; pairs whose parities allow a link are compared once, however many shingles they meet under. Otherwise they share common shingles only: equal cores of common shingles link each
    member with the smallest one, which keeps the components, and different cores are compared in blocks.
    """
    bits = sets.sparkSession.sparkContext.broadcast(common_buckets(sets))
    profiles = cut_lineage(sets.mapInArrow(released(_profile(percent, bits)), PROFILE))

    def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
        known = rows.join(connected(links).withColumnRenamed("v", "rep"), "rep", "left")
        return known.withColumn("component", F.coalesce("component", "rep"))

    apart = F.min("component") != F.max("component")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = cut_lineage(labelled(profiles.select("rep", "n", "parity"), links))
    under = profiles.select("rep", F.explode("rare").alias("node")).join(known.select("rep", "component"), "rep")
    possible = (
        _distinct_groups(under, apart)
        .join(known, "rep")
        .repartition(parts, "node")
        .sortWithinPartitions("node")
        .mapInArrow(released(_possible(percent)), "a long, b long")
    )
    links = links.unionByName(cut_lineage(_pair_links(cut_lineage(possible.distinct()), sets, percent)))
    alone = profiles.where(F.col("core").isNotNull()).drop("rare", "parity")
    heads = cut_lineage(
        alone.groupBy("digest").agg(F.min(F.struct("n", "rep")).alias("least")).select(
            "digest", F.col("least.rep").alias("head"), F.col("least.n").alias("head_n")
        )
    )
    near = F.col("n_core") * 100 >= (F.col("n") + F.col("head_n") - F.col("n_core")) * percent
    equal = alone.join(heads, "digest").where(near & (F.col("rep") != F.col("head")))
    links = cut_lineage(links.unionByName(equal.select(F.col("head").alias("a"), F.col("rep").alias("b"))).distinct())
    if heads.count() < 2:
        return links
    alone = cut_lineage(labelled(alone, links))
    if not alone.agg(apart.alias("apart")).first().apart:
        return links
    return links.unionByName(cut_lineage(_core_pairs(alone, heads, percent)))


def linked_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Component of every class that has a link: columns ``v``, ``component``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, crowd = compared_groups(classes)
    pairs = cut_lineage(_close_pairs(groups, percent))

    def sets_of(ids: DataFrame) -> DataFrame:
        return cut_lineage(of_ids(docs, ids, "left_semi").mapInArrow(released(_sets(width)), "rep long, shingles binary"))

    def compare(members: DataFrame, sets: DataFrame) -> DataFrame:
        return (
            members.join(sets, "rep")
            .repartition(parts, "node")
            .sortWithinPartitions("node", "rep")
            .mapInArrow(released(_compare(percent)), "a long, b long")
            .distinct()
        )

    def members(rows: DataFrame) -> DataFrame:
        return rows.select("node", F.explode(F.array("a", "b")).alias("rep")).distinct()

    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    first = cut_lineage(compare(members(pairs.where("tree = 0")), sets))
    labels = connected(first)

    def named(vertex: str, name: str) -> DataFrame:
        return labels.select(F.col("v").alias(vertex), F.col("component").alias(name))

    apart = (
        pairs.where("tree > 0")
        .join(named("a", "at_a"), "a", "left")
        .join(named("b", "at_b"), "b", "left")
        .where(F.coalesce("at_a", "a") != F.coalesce("at_b", "b"))
    )
    links = cut_lineage(first.unionByName(compare(members(apart), sets)))
    labels = connected(links)
    # Crowds whose members are in one component need no further links.
    inside = crowd.join(named("rep", "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = inside.groupBy("node").agg((F.min("component") != F.max("component")).alias("split")).where("split")
    left = cut_lineage(crowd.join(split, "node", "left_semi").select(F.col("rep").alias("doc_id")).distinct())
    if not left.limit(1).count():
        return labels
    crowded = sets_of(left)
    return connected(crowd_links(crowded, links, percent))


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85) -> DataFrame:
    """Component of every document under links of Jaccard similarity of at least ``percent`` / 100.

    ``doc_id``, ``n_shingles`` (size of the set of ``width``-word shingles), ``component_id`` (smallest doc_id that
    links lead to) and ``kept`` (it is the smallest itself). Texts with fewer words are one shingle; null, empty and
    blank texts have none and stand alone. Rows without doc_id are left out. Repeated rows fall into one class; other
    rows that share a doc_id get a row each. Further columns of ``docs`` are not looked at.
    """
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut_lineage(texts.mapInArrow(released(_sign(width)), SIGNED))
    classes = cut_lineage(
        signed.where("n_shingles > 0")
        .groupBy("digest", "n_shingles")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("tokens").alias("tokens"),
            F.first("sketch_a").alias("sketch_a"),
            F.first("sketch_b").alias("sketch_b"),
        )
    )
    linked = linked_classes(texts, classes, width, percent)
    named = (
        classes.select("digest", "n_shingles", "rep")
        .join(linked.withColumnRenamed("v", "rep"), "rep", "left")
        .select("digest", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    )
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(named, ["digest", "n_shingles"], "left")
        .select("doc_id", "n_shingles", component)
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
