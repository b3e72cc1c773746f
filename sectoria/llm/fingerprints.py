"""Near-duplicate documents by SimHash fingerprints and an inverted index of their bytes.

A fingerprint has ``BYTES`` positional bytes. Two that differ in at most ``BITS`` bits differ in at most ``BITS`` bytes, so
they share at least ``SHARED`` = 6 of the 8; that is the count filter. The bytes of each fingerprint are put in one order,
rare ones first by the length of their postings (a table of 8 x 256 counts). Of two that share 6 of 8, the first
``INDEXED + BITS`` bytes share at least ``INDEXED``; so the index holds each fingerprint under all choices of ``INDEXED`` of
these. In a posting of at most ``SHORT`` fingerprints the shared bytes of every pair are tallied, pairs with ``SHARED`` or more
are kept and their bits compared. Longer postings go on by two further bytes: what meets there shares ``SHARED`` bytes by
its key, and the two bytes left are at most 65,536 values, so that the neighbours of each are looked up in a table.

The index holds distinct fingerprints only, so copies weigh nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bytetext import byte_column, text_chunks
from .chosen_path import connected

SEED = 42
WIDTH = 3
BYTES = 8
BITS = 2
SHARED = BYTES - BITS
INDEXED = 4
SHORT = 256
# Shingles whose bits are counted at once, and words of a long text taken at once.
COUNTED = 1 << 16
PIECE = 1 << 20
# A fingerprint of more than one in so many documents is sent to every task: there are fewer than so many of them.
FREQUENT = 1000


def word_pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """Words of a text, some at a time; bytes.split() parts at space and 0x09 to 0x0D as wanted."""
    if len(text) <= size:
        yield text.split()
        return
    held, start = b"", 0
    while start < len(text):
        piece = held + text[start : start + size]
        start += size
        words = piece.split()
        held = b""
        if start < len(text) and words and not piece[-1:].isspace():
            held = words.pop()
        yield words
    if held:
        yield [held]


def shingle_hashes(text: bytes, width: int = WIDTH, size: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, repeats included, some at a time; a text with fewer words is one shingle."""
    last: list[bytes] = []
    whole = True  # no shingle so far
    hashed = xxhash.xxh64_intdigest
    for words in word_pieces(text, size):
        words = last + words
        if len(words) >= width:
            whole = False
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
            stops = ends[width - 1 :].tolist()
            starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
            for i in range(0, len(stops), COUNTED):
                spans = zip(starts[i : i + COUNTED], stops[i : i + COUNTED], strict=True)
                yield np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
            words = words[len(words) - width + 1 :]
        last = words
    if whole and last:
        yield np.array([hashed(b" ".join(last), SEED)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, the highest bit first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes) -> int:
    """Bits that more than half of the shingles' hashes have; zero without words."""
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(text.lower()):
        total += len(hashes)
        counts += bit_counts(hashes)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = byte_column(batch.column("text"))
        ids = batch.column("doc_id")
        for first, last in text_chunks(offsets):
            spans = zip(offsets[first:last].tolist(), offsets[first + 1 : last + 1].tolist(), strict=True)
            prints = np.array([fingerprint(data[a:b].tobytes()) for a, b in spans], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first).cast(pa.int64()), pa.array(prints.view(np.int64))], names=["doc_id", "print"]
            )


def positional_bytes(prints: np.ndarray) -> np.ndarray:
    """Token of every byte: its place in the high bits, its value in the low eight."""
    values = prints.astype(">i8").view(np.uint8).reshape(-1, BYTES).astype(np.int64)
    return values | np.arange(BYTES, dtype=np.int64) << 8


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length of the postings of every positional byte, as far as this task sees them."""
    counts = np.zeros(BYTES << 8, dtype=np.int64)
    for batch in batches:
        counts += np.bincount(positional_bytes(batch.column("print").to_numpy()).ravel(), minlength=len(counts))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["token", "n"])


def packed(tokens: np.ndarray) -> np.ndarray:
    """One number from a few tokens of 11 bits each."""
    key = np.zeros(tokens.shape[:-1], dtype=np.int64)
    for k in range(tokens.shape[-1]):
        key = key << 11 | tokens[..., k]
    return key


def _postings(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choices = np.array(list(combinations(range(INDEXED + BITS), INDEXED)))
        for batch in batches:
            prints = batch.column("print").to_numpy()
            tokens = positional_bytes(prints)
            # Rare bytes first; the token itself settles ties, so that the order is one for all.
            order = np.lexsort((tokens, lengths[tokens]), axis=1)
            first = np.take_along_axis(tokens, order, axis=1)[:, : INDEXED + BITS]
            keys = packed(np.sort(first[:, choices], axis=2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(prints, len(choices)))], names=["posting", "print"]
            )

    return run


# Pairs of places whose bytes a long posting's key leaves free, with the bits of the other places.
FREE = list(combinations(range(BYTES), BITS))
OTHERS = np.array([sum(255 << 8 * (BYTES - 1 - p) for p in range(BYTES) if p not in free) for free in FREE], dtype=np.uint64)
BIT_PLACES = {free: [8 * (BYTES - 1 - p) for p in free] for free in FREE}


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of long postings under two further bytes each: with those of the posting these are SHARED ones."""
    outside = {
        known: np.array([i for i, free in enumerate(FREE) if not set(free) & set(known)])
        for known in combinations(range(BYTES), INDEXED)
    }
    table = np.zeros((1 << BYTES, len(next(iter(outside.values())))), dtype=np.int64)
    for known, choices in outside.items():
        table[sum(1 << p for p in known)] = choices
    for batch in batches:
        keys, prints = batch.column("posting").to_numpy(), batch.column("print").to_numpy()
        known = sum(np.int64(1) << (keys >> 11 * k + 8 & 7) for k in range(INDEXED))
        free = table[known]
        rest = prints.view(np.uint64)[:, None] & OTHERS[free]
        yield pa.RecordBatch.from_arrays(
            [pa.array(free.ravel().astype(np.int32)), pa.array(rest.ravel().view(np.int64)), pa.array(np.repeat(prints, free.shape[1]))],
            names=["free", "rest", "print"],
        )


def tallied_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a short posting, by their places in it: SHARED positional bytes or more, and then few enough bits."""
    each = prints.view(np.uint8).reshape(-1, BYTES)
    tally = np.zeros((len(prints), len(prints)), dtype=np.int8)
    for k in range(BYTES):
        tally += each[:, None, k] == each[None, :, k]
    a, b = np.nonzero(np.triu(tally >= SHARED, 1))
    near = np.bitwise_count(prints[a] ^ prints[b]) <= BITS
    return a[near], b[near]


def spanning(size: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the same as all links (a, b) among ``size`` members."""
    parents = list(range(size))

    def root(i: int) -> int:
        while parents[i] != i:
            parents[i] = parents[parents[i]]
            i = parents[i]
        return i

    kept = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(i), root(j)
        if x != y:
            parents[y] = x
            kept.append((i, j))
    return kept


LINKS = "a long, b long"


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], type=pa.int64()) for k in (0, 1)], names=["a", "b"])


def _short_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[tuple[int, int]] = []
        for posting in batch.column("members"):
            members = posting.values.to_numpy().view(np.uint64)
            ids = members.view(np.int64)
            found += [(int(ids[i]), int(ids[j])) for i, j in spanning(len(members), *tallied_links(members))]
        yield _links(found)


def free_links(prints: np.ndarray, free: tuple[int, ...]) -> list[tuple[int, int]]:
    """Links that connect what is near in a group whose members differ in the bytes at ``free`` only: each with its first one.

    The near values of each are looked up in a table of all values of these bytes.
    """
    codes = np.zeros(len(prints), dtype=np.int64)
    for shift in BIT_PLACES[free]:
        codes = codes << 8 | (prints >> np.uint64(shift) & np.uint64(255)).astype(np.int64)
    place = np.full(1 << 8 * BITS, -1, dtype=np.int64)
    place[codes] = np.arange(len(codes))
    masks = [sum(1 << k for k in bits) for n in range(1, BITS + 1) for bits in combinations(range(8 * BITS), n)]
    labels = np.arange(len(codes))
    while True:
        before = labels.copy()
        for mask in masks:
            near = place[codes ^ mask]
            at = np.flatnonzero(near >= 0)
            labels[at] = np.minimum(labels[at], labels[near[at]])
        labels = labels[labels]
        if (labels == before).all():
            return [(int(labels[i]), int(i)) for i in np.flatnonzero(labels != np.arange(len(codes)))]


def _free_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come group by group; a group has at most 65,536 members."""
    key, members = None, []

    def links() -> pa.RecordBatch:
        prints = np.unique(np.concatenate(members).view(np.uint64)) if members else np.zeros(0, dtype=np.uint64)
        found = free_links(prints, FREE[key[0]]) if len(prints) > 1 else []
        ids = prints.view(np.int64)
        return _links([(int(ids[i]), int(ids[j])) for i, j in found])

    for batch in batches:
        free, rest, prints = (batch.column(c).to_numpy() for c in ("free", "rest", "print"))
        change = np.flatnonzero((free[1:] != free[:-1]) | (rest[1:] != rest[:-1])) + 1
        for low, high in zip([0, *change.tolist()], [*change.tolist(), len(free)], strict=True):
            if low == high:
                continue
            if (free[low], rest[low]) != key:
                yield links()
                key, members = (free[low], rest[low]), []
            members.append(prints[low:high])
    yield links()


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct fingerprints ``print`` of at most BITS differing bits."""
    spark = prints.sparkSession
    counted = prints.mapInArrow(_tokens, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    lengths = np.zeros(BYTES << 8, dtype=np.int64)
    for row in counted.collect():  # BYTES x 256 rows
        lengths[row.token] = row.n
    rows = prints.mapInArrow(_postings(lengths), "posting long, print long")
    sizes = rows.groupBy("posting").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = cut_lineage(rows.join(sizes, "posting"))
    short = met.where(F.col("size") <= SHORT).groupBy("posting").agg(F.collect_list("print").alias("members"))
    links = short.select("members").mapInArrow(_short_links, LINKS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    longer = (
        met.where(F.col("size") > SHORT)
        .select("posting", "print")
        .mapInArrow(_longer, "free int, rest long, print long")
        .distinct()
        .repartition(parts, "free", "rest")
        .sortWithinPartitions("free", "rest")
        .mapInArrow(_free_links, LINKS)
    )
    return cut_lineage(links.unionByName(longer).distinct())


def near_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every document and the group of those linked by at most ``BITS`` differing bits.

    ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` (smallest doc_id that links lead to). A to Z are
    lower-cased; texts of fewer words than ``WIDTH`` are one shingle; null, empty and blank texts have the fingerprint zero and are
    linked like others. Rows without doc_id have a row and take part in linking; their component is null if it holds no
    doc_id. Repeated rows have a row each. Further columns of ``docs`` are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut_lineage(texts.mapInArrow(_signed, "doc_id long, print long"))
    classes = cut_lineage(
        signed.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    )
    # All copies of a document are one vertex, however many they are.
    labels = connected(fingerprint_links(classes.select("print"))).withColumnRenamed("v", "print")
    grouped = classes.join(labels, "print", "left").withColumn("component", F.coalesce("component", "print"))
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = cut_lineage(grouped.join(smallest, "component").select("print", "component_id", "n"))
    total = named.agg(F.sum("n")).first()[0] or 0
    frequent = named.where(F.col("n") * FREQUENT > total).select("print", F.col("component_id").alias("frequent_id"), F.lit(True).alias("is_frequent"))
    marked = signed.join(F.broadcast(frequent), "print", "left")
    rare = marked.where(F.col("is_frequent").isNull()).select("doc_id", "print").join(named, "print")
    shown = marked.where("is_frequent").select("doc_id", "print", F.col("frequent_id").alias("component_id"))
    rows = rare.select("doc_id", "print", "component_id").unionByName(shown)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
