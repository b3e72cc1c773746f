"""Byte repeats against a dictionary of all strings."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sectoria.llm import bytetext, repeats
from sectoria.llm.repeats import remove_repeats

from .brute import removed_bytes


def words(rng, n, pool=300):
    return " ".join(f"w{rng.randrange(pool):03d}é" if rng.random() < 0.2 else f"word{rng.randrange(pool)}" for _ in range(n))


def corpora():
    rng = random.Random(5)
    passage = words(rng, 40)
    texts = [words(rng, rng.randrange(5, 200)) for _ in range(30)]
    for i in range(0, 30, 2):
        at = rng.randrange(len(texts[i]) + 1)
        texts[i] = texts[i][:at] + passage[rng.randrange(60) :] + texts[i][at:]
    texts += texts[3:9] + ["", None, "a" * 1000, "ab" * 400, "x" * 99, "x" * 100, "x" * 100]
    texts += [texts[1] + texts[1], "\0" * 300 + passage]
    return {
        "mixed": texts,
        "copies": [words(random.Random(1), 60)] * 12,
        "short": ["a", "", None],
    }


@pytest.mark.parametrize("name", list(corpora()))
@pytest.mark.parametrize("parts", [1, 5])
def test_repeats_equal_brute_force(documents, name, parts):
    rows = list(enumerate(corpora()[name]))
    random.Random(2).shuffle(rows)
    found = {r.doc_id: r for r in remove_repeats(documents(*rows).repartition(parts), with_text=True).collect()}
    assert len(found) == len(rows)
    for doc, (data, gone, spans) in removed_bytes(rows).items():
        row = found[doc]
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(data), sum(gone), spans), doc
        kept = bytes(b for b, g in zip(data, gone) if not g)
        assert row.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_parts_of_long_texts_hold_every_start_once(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 100)
    monkeypatch.setattr(repeats, "text_chunks", lambda offsets: bytetext.text_chunks(offsets, 100))
    sizes = [0, 30, 500, 201, 199, 7, 300, 90, 0]
    offsets = np.cumsum([0, *sizes])
    data = np.arange(offsets[-1]) % 251
    found = []
    for first, shift, part, places in repeats.slices(data, offsets, 20):
        for i, (low, high) in enumerate(zip(places, places[1:])):
            start = offsets[first + i] + shift
            assert (data[start : start + high - low] == part[low:high]).all()
            found += [(first + i, shift + at) for at in range(max(0, high - low - 19))]
    assert sorted(found) == [(i, at) for i, n in enumerate(sizes) for at in range(max(0, n - 19))]


def test_a_text_longer_than_a_part(documents):
    rng = random.Random(9)
    long = "".join(chr(rng.randrange(97, 123)) for _ in range(1_200_000))
    rows = remove_repeats(documents((0, long), (1, "new " + long[450_000:600_000]), (2, long[700_000:] + long[:150]))).collect()
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in rows}
    assert found == {0: (0, 0), 1: (150_000, 1), 2: (500_150, 1)}


def test_clashing_columns_null_ids_and_no_rows(documents):
    docs = documents((1, "q" * 150), (None, "q" * 150), (2, "q" * 150)).withColumns(
        {"trigger": F.lit("x"), "runs": F.lit(1), "suffix": F.lit(None)}
    )
    assert {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()} == {1: 149, 2: 150}
    assert remove_repeats(docs.where("false")).collect() == []


def test_rows_of_one_id_are_versions_of_one_document(documents):
    rows = remove_repeats(documents((4, "z1" * 80), (4, "z1" * 80))).collect()
    assert len(rows) == 2 and len({r.n_removed for r in rows}) == 1 and rows[0].n_removed == 158


def test_different_texts_of_one_id_keep_their_own_runs(documents):
    rng = random.Random(4)
    shared, other = words(rng, 40), words(rng, 30)
    rows = [(4, "head " + shared), (4, shared[20:] + other), (4, "tiny"), (4, None), (5, other + shared), (3, other), (6, "x")]
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 99):
            key = data[i : i + 100]
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    expected = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = {k for i in range(len(data) - 99) if first[data[i : i + 100]] < (doc, i) for k in range(i, i + 100)}
        expected.append((doc, len(data), len(gone), hashlib.sha256(bytes(b for k, b in enumerate(data) if k not in gone)).hexdigest()))
    found = remove_repeats(documents(*rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found) == sorted(expected)
    assert sum(n > 0 for _, _, n, _ in expected) >= 2


def batch(texts, **more):
    rows = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_pydict({"doc_id": rows, "version": pa.array([0] * len(texts), pa.int64()), "text": texts, **more})


@pytest.mark.parametrize("length", [49, 100, 512])
def test_settled_phrases_in_a_row_are_one_run(length):
    text = words(random.Random(3), 4000)
    rows = pa.Table.from_batches(repeats._parse(length)(iter([batch([text, text, text])]))).to_pandas()
    starts = len(text.encode()) - length + 1
    for doc, late in ((0, False), (1, True), (2, True)):
        own = rows[rows.doc_id == doc]
        begin, count = own.run.to_numpy() >> repeats.RUN_BITS, own.run.to_numpy() & ((1 << repeats.RUN_BITS) - 1)
        assert sorted(np.concatenate([np.arange(b, b + c) for b, c in zip(begin, count)])) == list(range(starts))
        assert (own.later == late).all()
    assert 5 * (rows.doc_id == 2).sum() < (rows.doc_id == 0).sum()


def test_strings_of_one_hash_are_told_apart_by_their_bytes():
    data = np.frombuffer(b"abcabdabcabd", dtype=np.uint8)
    at = np.array([0, 3, 6, 9])
    for hashes in (np.zeros(4, np.uint64), np.array([5, 7, 5, 7], np.uint64)):
        later = repeats.later_rows(repeats.byte_classes(data, at, 3, hashes), np.zeros(4, np.int64), at)
        assert later.tolist() == [False, False, True, True]


def test_open_suffixes_are_not_copied():
    size = 900_000
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, size, dtype=np.uint8).tobytes().decode()
    runs = [(at << repeats.RUN_BITS) | min(50, size - 99 - at) for at in range(0, size - 99, 50)]
    rows = batch([text], open=pa.array([runs], pa.list_(pa.int64())))
    tracemalloc.start()
    found = sum(x.num_rows for x in repeats._suffixes(100)(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == size - 99
    assert peak < 200 * size, peak / size


def test_texts_are_exchanged_once_for_both_joins(spark, documents):
    rng = random.Random(8)
    shared = words(rng, 60)
    rows = [(i, words(rng, 30) + shared[i:] + words(rng, 20)) for i in range(40)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = remove_repeats(documents(*rows).withColumn("lang", F.lit("en")), with_text=True, carried=("lang",))
        assert len(found.collect()) == 40
        plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
        assert any("ReusedExchange" in line and "text#" in line and "version#" in line for line in plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
