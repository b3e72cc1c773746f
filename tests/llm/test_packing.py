"""Pieces against the tokenizers library, packing against its own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sectoria.llm import packing
from sectoria.llm.packing import BestFit, cut_points, packed, token_pieces


def pieces_of(texts, size=1024):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        points = cut_points(len(ids), size)
        for piece, (a, b) in enumerate(zip(points, points[1:])):
            yield (doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())), ids[a:b]


def check_sequences(rows, size):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    rows = packed(token_pieces(docs, with_ids=True)).collect()
    wanted = dict(pieces_of(texts))
    found = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32): r.ids for r in rows}
    assert found == wanted and len(rows) == len(wanted)
    least = -(-sum(r.length for r in rows) // 1024)
    assert check_sequences(rows, 1024) <= 1.01 * least + 1


def test_special_tokens_nulls_and_odd_texts(documents):
    texts = [(1, "a<|endoftext|>b"), (2, None), (3, ""), (4, "  \t\n x \x00 ½ 日本 🙂 don't I'LL"), (5, "e" * 5000), (5, "e" * 5000)]
    docs = documents(*texts, (None, "x")).withColumn("piece", F.lit("clash"))
    rows = packed(token_pieces(docs)).collect()
    found = sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert found == sorted((p[0] or 0, *p[1:]) for p, _ in pieces_of([*texts, (None, "x")]))
    check_sequences(rows, 1024)
    assert packed(token_pieces(docs.where("false"))).collect() == []


def test_only_the_first_piece_is_shorter():
    assert cut_points(1, 4) == [0, 1]
    assert cut_points(4, 4) == [0, 4]
    assert cut_points(9, 4) == [0, 1, 5, 9]
    assert cut_points(8, 4) == [0, 4, 8]


def test_best_fit_by_a_plain_version():
    rng = random.Random(1)
    for limit in (1, 3, 20):
        packer, bins, opened = BestFit(100, limit), {}, 0
        for _ in range(3000):
            length = rng.randrange(1, 101)
            fitting = [f for f in bins.values() if f >= length]
            number, offset = packer.place(length)
            if fitting:
                assert bins[number] == min(fitting) and offset == 100 - bins[number]
            else:
                assert (number, offset) == (opened, 0)
                if len(bins) == limit:
                    fullest = min(bins.values())
                    gone = next(b for b, f in bins.items() if f == fullest and b not in sum(packer.bins, []))
                    del bins[gone]
                opened += 1
                bins[number] = 100
            bins[number] -= length
            if not bins[number]:
                del bins[number]
            assert len(bins) <= limit and packer.open == len(bins)


def test_long_runs_of_blanks_equal_the_library():
    """A run alone, before a word, before a special token, of mixed blanks, and runs around the cut."""
    name = path("byte_bpe_50k.json")
    library = Tokenizer.from_file(name)
    with open(name, encoding="utf-8") as file:
        encoding = packing.encoding_of(file.read())
    n = packing.LONG_RUN
    texts = [
        " " * 1_000_000,
        "a" + " " * 1_000_000 + "b",
        "a" + " \t" * n + "\nword " + "\u3000\n" * n + "!",
        "x" + " " * (n - 1) + "y" + " " * n + "<|endoftext|>" + " " * (n + 1) + "z<|endoftext|>",
        "q" + "\n" * (n + 5) + "12 " * 40_000,
    ]
    for text in texts:
        assert packing.text_ids(encoding, text) == library.encode(text, add_special_tokens=False).ids
