"""Packing of documents into token sequences by bounded-space online best fit.

Texts are encoded and cut in pieces of at most ``size`` tokens, which are dealt to packing tasks of about ``SHARE`` pieces
each. A task keeps at most ``OPEN_BINS`` open bins in a bitset keyed by free space: a piece goes to the bin that it leaves
fullest; if none has room and all bins are open, the fullest bin closes. Pieces are taken in blocks of as many as there
are bins, the longest of a block first, so that no block can close the bins that its own short pieces would fill. On the
given texts this needs 0.1 % more sequences than there are tokens for; single pieces in the order they come need 2 %.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bpe import byte_alphabet
from .bytetext import released

OPEN_BINS = 4096
SHARE = 100_000
END_ID = 2
# Longer runs of blanks are beyond the pattern's stack; they are cut out before it. Unicode's white space.
LONG_RUN = 100_000
BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


class BestFit:
    """Online best fit with a fixed number of open bins."""

    def __init__(self, size: int, open_bins: int = OPEN_BINS):
        self.size, self.limit = size, open_bins
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]
        self.free = 0
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.free &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of at most ``size``."""
        roomy = self.free >> length
        if roomy:
            free = length + (roomy & -roomy).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            free, number = self.size, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.size - free


def encoding_of(described: str) -> tiktoken.Encoding:
    """Byte-level vocabulary of a tokenizer's description; ids follow the order of its merges."""
    tokenizer = json.loads(described)
    alphabet = byte_alphabet()
    specials = {t["content"]: t["id"] for t in tokenizer["added_tokens"]}
    ranks = {bytes(alphabet[c] for c in t): i for t, i in tokenizer["model"]["vocab"].items() if t not in specials}
    return tiktoken.Encoding("described", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)


def text_ids(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text; special tokens in it stand for themselves.

    The pattern takes a run of blanks as one word, but leaves its last one to a word that follows. Long runs are coded as
    such words here.
    """
    if len(text) < LONG_RUN:
        return encoding.encode(text, allowed_special="all")
    specials = tuple(encoding.special_tokens_set)
    ids, done = [], 0
    for run in BLANKS.finditer(text):
        stop = run.end()
        if stop < len(text) and not text.startswith(specials, stop):
            stop -= 1
        ids += encoding.encode(text[done : run.start()], allowed_special="all")
        ids += encoding._encode_single_piece(text[run.start() : stop])
        done = stop
    return ids + encoding.encode(text[done:], allowed_special="all")


def cut_points(total: int, size: int) -> list[int]:
    """Starts of the pieces of ``total`` tokens, and the end; only the first piece may be shorter than ``size``."""
    first = total % size or size
    return [0, *range(min(first, total), total, size), total]


_ENCODINGS: dict[int, tiktoken.Encoding] = {}


def _pieces(described, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(described.value)
        if key not in _ENCODINGS:
            _ENCODINGS.clear()
            _ENCODINGS[key] = encoding_of(described.value)
        encoding = _ENCODINGS[key]
        rows: list[tuple] = []
        ids_held: list[np.ndarray] = []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            ends = np.concatenate([[0], np.cumsum(columns[3])]) if with_ids else np.zeros(len(rows) + 1)
            flat = np.concatenate(ids_held).astype(np.int32) if ids_held else np.zeros(0, dtype=np.int32)
            batch = pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)),
                    pa.ListArray.from_arrays(ends.astype(np.int32), flat),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )
            rows.clear()
            ids_held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*text_ids(encoding, text.as_py() or ""), END_ID], dtype="<u4")
                points = cut_points(len(ids), size)
                for piece, (start, stop) in enumerate(zip(points[:-1], points[1:], strict=True)):
                    part = ids[start:stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids_held.append(part)
                if len(rows) >= 2000:
                    yield ready()
        if rows:
            yield ready()

    return run


def _pack(size: int, open_bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(size, open_bins)
        # Numbers of a task's sequences start where no other task's do.
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for low in range(0, batch.num_rows, open_bins):
                block = batch.slice(low, open_bins)
                lengths = block.column("length").to_numpy()
                bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
                for i in np.argsort(-lengths, kind="stable").tolist():
                    bins[i], offsets[i] = packer.place(int(lengths[i]))
                columns = {n: block.column(n) for n in block.schema.names if n != "dealt"}
                columns |= {"sequence_id": pa.array(base + bins), "offset": pa.array(offsets)}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def token_pieces(docs: DataFrame, size: int = 1024, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every text as pieces of at most ``size`` tokens: ids of the byte-level vocabulary, then ``END_ID``.

    ``doc_id``, ``piece``, ``start`` (tokens of the document before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers) and, with ``with_ids``, ``ids``. Only the first piece of a longer document is shorter.
    Null and empty texts are one piece of the end token alone; a null doc_id stays null.
    """
    with open(tokenizer or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        described = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = texts.mapInArrow(released(_pieces(described, size, with_ids)), PIECES)
    return pieces if with_ids else pieces.drop("ids")


def packed(pieces: DataFrame, size: int = 1024, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces of ``token_pieces`` with ``sequence_id`` and ``offset``: the place of each in a sequence of at most ``size``.

    Sequences have no gaps. Pieces longer than ``size`` raise. Repeated pieces are packed each.
    """
    pieces = cut_lineage(pieces)
    tasks = -(-max(1, pieces.count()) // SHARE)
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    dealt = F.xxhash64("doc_id", "piece", "ids_crc32")
    return (
        pieces.withColumn("dealt", dealt)
        .repartition(tasks, "dealt")
        .sortWithinPartitions("dealt", "doc_id", "piece")
        .mapInArrow(released(_pack(size, open_bins)), schema)
    )
