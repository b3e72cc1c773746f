"""Exact removal of repeated byte strings by a prefix-free parse of the corpus.

Rolling-hash triggers cut every text into phrases: a place is a trigger if the hash of the ``GRAM`` bytes from there is
the smallest of all grams of some string of ``length`` bytes. Every such string has exactly one trigger of its own, which
depends on its bytes alone, so equal strings hang on equal triggers at equal distance, and each start belongs to one
phrase. The sequence of phrases is the parse, the distinct ones are the dictionary.

Corpus order then needs three steps, none of which holds all suffixes:

1. A phrase that stands in the dictionary already repeats all its strings: only its first place in the parse counts.
2. Dictionary entries whose trigger hangs on one entry only share no string with another one and are settled.
3. The suffixes of the other entries, cut to ``length`` bytes, are put in order: each task sorts those of one
   slice of texts at a time and keeps the first place of equal ones; the slices meet by a hash of 95 bits.

There is no suffix array of the parse or of the dictionary and no order over the corpus: strings of one fixed length need
only their equals, and a grouping by hash finds these without a global sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .bytetext import BASE, CHUNK_BYTES, Rolling, byte_column, mixed, released, text_chunks

GRAM = 48
HELD = 400_000
PLACE_BITS = 24
RUN_BITS = 12
# Phrases of strings up to this length stay below 1,024 bytes, from which on texts can be made whose polynomials are equal.
LONGEST = 512
PARSE = "trigger long, phrase long, doc_id long, version long, run long, later boolean"
SUFFIXES = "suffix long, half int, doc_id long, version long, run long, later boolean"
REMOVED = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` keys from each place on."""
    count = len(keys) - width + 1
    if count <= 0:
        return keys[:0]
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:count], before[width - 1 : width - 1 + count])


def parse_bytes(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Phrases of several texts: text, start and stop of the string starts they own, trigger hash, hash of their bytes."""
    sizes = np.diff(offsets)
    valid = np.zeros(len(data) + 1, dtype=np.int8)
    long_enough = sizes >= length
    valid[offsets[:-1][long_enough]] = 1
    np.add.at(valid, offsets[1:][long_enough] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(starts):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    rolling = Rolling(data)
    grams = rolling.grams(GRAM)
    places = np.arange(len(grams), dtype=np.uint64)
    keys = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
    minima = window_minima(keys, length - GRAM + 1)
    trigger = (minima[starts] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    begin = starts[first]
    stop = starts[np.append(first[1:], len(starts)) - 1] + 1
    text = np.searchsorted(offsets, begin, side="right") - 1
    return text, begin - offsets[text], stop - offsets[text], grams[trigger[first]], rolling.ranges(begin, stop + length - 1)


def slices(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Texts in parts of at most ``2 * CHUNK_BYTES`` bytes; parts of a long text overlap by ``length - 1`` bytes.

    Yields the number of the first text, the place of the part in it, the bytes and the offsets.
    """
    for first, last in text_chunks(offsets):
        low, high = int(offsets[first]), int(offsets[last])
        if high - low <= 2 * CHUNK_BYTES:
            yield first, 0, data[low:high], offsets[first : last + 1] - low
            continue
        for at in range(low, high - length + 1, CHUNK_BYTES):
            part = data[at : min(high, at + CHUNK_BYTES + length - 1)]
            yield first, at - low, part, np.array([0, len(part)])


def later_rows(keys: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True for rows whose place comes after the first place of the rows with equal keys."""
    order = np.lexsort((start, doc, *keys))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = False
        for key in keys:
            ordered = key[order]
            new[1:] |= ordered[1:] != ordered[:-1]
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = np.zeros(len(order), dtype=bool)
    later[order] = (doc[order] != doc[first]) | (start[order] != start[first])
    return later


def byte_classes(data: np.ndarray, at: np.ndarray, length: int, hashes: np.ndarray, block: int = 1 << 14) -> tuple[np.ndarray, ...]:
    """Keys that are equal for equal strings of ``length`` bytes of ``data``, and for these only.

    Those are the hashes, if strings of one hash have the same bytes, which is looked up in blocks; else the bytes.
    """
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = np.flatnonzero(ordered[1:] == ordered[:-1])
    strings = np.lib.stride_tricks.sliding_window_view(data, length)
    for low in range(0, len(same), block):
        pair = same[low : low + block]
        if (strings[at[order[pair]]] != strings[at[order[pair + 1]]]).any():
            return tuple(strings[at, i] for i in range(length))
    return (hashes,)


def _parsed(parts: list[tuple[np.ndarray, ...]], length: int) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    doc, version, begin, count, trigger, phrase = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    if not len(doc):
        return
    later = later_rows((phrase, trigger), doc, begin)
    # Settled phrases that follow each other become one run, as long as its count has room.
    stop = begin + count
    follows = np.zeros(len(doc), dtype=bool)
    follows[1:] = later[1:] & later[:-1] & (begin[1:] == stop[:-1]) & (doc[1:] == doc[:-1]) & (version[1:] == version[:-1])
    chain = np.flatnonzero(~follows)
    within = np.arange(len(doc)) - np.repeat(chain, np.diff(np.append(chain, len(doc))))
    head = np.flatnonzero(within % (((1 << RUN_BITS) - 1) // (length - GRAM + 1)) == 0)
    last = np.append(head[1:], len(doc)) - 1
    count = stop[last] - begin[head]
    doc, version, begin, later, trigger, phrase = (x[head] for x in (doc, version, begin, later, trigger, phrase))
    # They are dealt out by their place, and need no hash: copies of one text don't meet in one task.
    place = mixed(doc.astype(np.uint64) * np.uint64(BASE) + begin.astype(np.uint64))
    trigger = np.where(later, place, trigger)
    phrase = np.where(later, np.uint64(0), phrase)
    for low in range(0, len(doc), 50_000):
        cut = slice(low, low + 50_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(trigger[cut].view(np.int64)),
                pa.array(phrase[cut].view(np.int64)),
                pa.array(doc[cut].astype(np.int64)),
                pa.array(version[cut]),
                pa.array((begin[cut] << RUN_BITS) | count[cut]),
                pa.array(later[cut]),
            ],
            names=["trigger", "phrase", "doc_id", "version", "run", "later"],
        )


def _parse(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases of this task's texts; those met earlier in the task's last ``HELD`` phrases are marked as settled."""
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            versions = batch.column("version").to_numpy(zero_copy_only=False)
            for first, shift, part, places in slices(data, offsets, length):
                text, begin, stop, trigger, phrase = parse_bytes(part, places, length)
                parts.append((ids[first + text], versions[first + text], begin + shift, stop - begin, trigger, phrase))
                held += len(text)
                if held >= HELD:
                    yield from _parsed(parts, length)
                    held = 0
        yield from _parsed(parts, length)

    return run


def _run_starts(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of runs given as start and count, and the run of each."""
    count = runs & ((1 << RUN_BITS) - 1)
    owner = np.repeat(np.arange(len(runs)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return (runs >> RUN_BITS)[owner] + within, owner


def _suffixes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffix array of this task's share of the dictionary, one part of texts after the other."""
        for batch in batches:
            data, offsets = byte_column(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            versions = batch.column("version").to_numpy(zero_copy_only=False)
            lists = batch.column("open")
            bounds = lists.offsets.to_numpy()
            runs = lists.values.to_numpy(zero_copy_only=False)
            for first, shift, part, places in slices(data, offsets, length):
                owned = runs[bounds[first] : bounds[first + len(places) - 1]]
                text = np.repeat(np.arange(len(places) - 1), np.diff(bounds[first : first + len(places)]))
                start, owner = _run_starts(owned)
                text = text[owner]
                at = places[text] + start - shift
                inside = (at >= places[text]) & (at + length <= places[text + 1])
                at, start, text, owner = at[inside], start[inside], text[inside], owner[inside]
                if not len(at):
                    continue
                rolling = Rolling(part)
                suffix = rolling.ranges(at, at + length)
                half = (rolling.ranges(at, at + length // 2) >> np.uint64(33)).astype(np.int32)
                doc = ids[first + text].astype(np.int64)
                version = versions[first + text]
                later = later_rows(byte_classes(part, at, length, suffix), doc, start)
                # Settled suffixes in a row become one run; the others go on one by one.
                new = np.ones(len(at), dtype=bool)
                new[1:] = ~(later[1:] & later[:-1] & (at[1:] == at[:-1] + 1) & (owner[1:] == owner[:-1]))
                head = np.flatnonzero(new)
                count = np.diff(np.append(head, len(at)))
                suffix, half, doc, version, start, later = (x[head] for x in (suffix, half, doc, version, start, later))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(suffix.view(np.int64)),
                        pa.array(half),
                        pa.array(doc),
                        pa.array(version),
                        pa.array((start << RUN_BITS) | count),
                        pa.array(later),
                    ],
                    names=["suffix", "half", "doc_id", "version", "run", "later"],
                )

    return run


def _covered(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, int]:
    """Mask of the removed bytes and the number of maximal removed runs."""
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return gone, int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())


def _removal(length: int, with_text: bool, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, runs in zip(*(batch.column(x).to_pylist() for x in ("text", "runs")), strict=True):
                data = (text or "").encode()
                kept, removed, spans = data, 0, 0
                gone = None
                if runs:
                    packed = np.array(runs, dtype=np.int64)
                    start = packed >> RUN_BITS
                    stop = start + (packed & ((1 << RUN_BITS) - 1)) + length - 1
                    gone, spans = _covered(data, start, stop)
                    removed = int(gone.sum())
                    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                row = [len(data), removed, spans, hashlib.sha256(kept).hexdigest()]
                if with_text:
                    row.append(text if gone is None else whole_characters(data, gone))
                rows.append(row)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"][: 4 + with_text]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            made = [pa.array(c, type=k) for c, k in zip(columns, kinds[: len(names)], strict=True)]
            kept_columns = ["doc_id", *carried]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept_columns), *made], names=[*kept_columns, *names])

    return run


def whole_characters(data: bytes, gone: np.ndarray) -> str:
    """Text without the removed bytes; a character that is only partly removed stays."""
    values = np.frombuffer(data, dtype=np.uint8)
    lead = np.flatnonzero((values & 0xC0) != 0x80)
    if not len(lead):
        return ""
    lost = np.logical_and.reduceat(gone, lead)
    size = np.diff(np.append(lead, len(values)))
    return values[np.repeat(~lost, size)].tobytes().decode()


def _place() -> Column:
    return F.struct("doc_id", F.shiftright("run", RUN_BITS).alias("start"))


def versioned(docs: DataFrame) -> DataFrame:
    """Rows with a doc_id and its ``version``: a hash of the text where the id has different texts, else 0."""
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    digests = named.select("doc_id", digest.alias("digest")).groupBy("doc_id")
    several = digests.agg((F.min("digest") != F.max("digest")).alias("several")).where("several")
    # Usually no row: the optimizer knows the size of the stored table and leaves the texts where they are.
    several = cut_lineage(several)
    version = F.when(F.col("several"), digest).otherwise(F.lit(0)).alias("version")
    return named.join(several, "doc_id", "left").select(*named.columns, version)


def repeated_runs(texts: DataFrame, length: int = 100) -> DataFrame:
    """Starts of strings of ``length`` bytes that also start earlier: ``doc_id``, ``version``, ``runs`` (start and count, packed).

    ``texts`` are rows of ``versioned``; all their columns go through the join with the open phrases, so that its exchange of the
    texts also serves a join of the same rows with the result. A place is earlier if its doc_id is smaller, or in the same document if it stands
    before. Rows that share a doc_id count as versions of one document: the same place of another version is not earlier,
    a smaller one is. Null text counts as empty.
    """
    if not GRAM < length <= LONGEST:
        raise ValueError(f"length must lie between {GRAM + 1} and {LONGEST}")
    parsed = texts.select("doc_id", "version", "text").mapInArrow(released(_parse(length)), PARSE)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entry, hook = Window.partitionBy("trigger", "phrase"), Window.partitionBy("trigger")
    ranked = (
        parsed.repartition(parts, "trigger")
        .withColumn("first", F.min(F.struct("doc_id", "run")).over(entry))
        .withColumn("shared", F.min("phrase").over(hook) != F.max("phrase").over(hook))
        .withColumn(
            "repeats",
            F.col("later")
            | (F.col("first.doc_id") != F.col("doc_id"))
            | (F.shiftright("first.run", RUN_BITS) != F.shiftright("run", RUN_BITS)),
        )
        .where(F.col("repeats") | F.col("shared"))
        .select("doc_id", "version", "run", "repeats")
    )
    marks = cut_lineage(ranked)
    named = ["doc_id", "version"]
    open_runs = marks.where(~F.col("repeats")).groupBy(named).agg(F.collect_list("run").alias("open"))
    suffixes = texts.join(open_runs, named).mapInArrow(released(_suffixes(length)), SUFFIXES)
    # As for phrases, suffixes settled inside a task are dealt out by their place.
    suffixes = suffixes.withColumn(
        "suffix", F.when(F.col("later"), F.xxhash64("doc_id", "run")).otherwise(F.col("suffix"))
    )
    equal = Window.partitionBy("suffix", "half")
    late = (
        suffixes.withColumn("first", F.min(_place()).over(equal))
        .where(F.col("later") | (F.col("first") != _place()))
        .select("doc_id", "version", "run")
    )
    return (
        marks.where("repeats")
        .select("doc_id", "version", "run")
        .unionByName(late)
        .groupBy(named)
        .agg(F.collect_list("run").alias("runs"))
    )


def remove_repeats(
    docs: DataFrame, length: int = 100, with_text: bool = False, carried: Sequence[str] = ()
) -> DataFrame:
    """Every document with its repeated bytes taken out; see ``repeated_runs`` for what repeats.

    ``doc_id``, the ``carried`` columns of ``docs``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept_sha256`` of the bytes left; with ``with_text`` also ``kept_text``, in which a character stays unless all its
    bytes are removed. Other columns of ``docs`` are not looked at. A row for each row of ``docs`` that has a doc_id.
    """
    texts = versioned(docs.select("doc_id", "text", *carried))
    joined = texts.join(repeated_runs(texts, length), ["doc_id", "version"], "left")
    fields = [texts.schema[c] for c in ("doc_id", *carried)]
    schema = T.StructType([*fields, *T.StructType.fromDDL(REMOVED + (", kept_text string" if with_text else ""))])
    return joined.mapInArrow(released(_removal(length, with_text, list(carried))), schema)
