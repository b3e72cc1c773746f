"""Stages of the corpus pipeline against plain versions, each on its own input."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P  # noqa: E402

from .brute import components, removed_bytes  # noqa: E402
from .test_packing import check_sequences, pieces_of  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Rows after every stage, the documents first."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = [docs.collect()]
    for _, stage in P.STAGES:
        docs = P.cut_lineage(stage(spark, docs, folder))
        made.append(docs.collect())
    return made


def test_columns_and_shrinking(steps):
    for before, after in zip(steps[:-2], steps[1:-1]):
        assert tuple(after[0].asDict()) == P.COLUMNS
        assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) > 0.5 * len(before)
    assert len(steps[4]) < len(steps[0])


def test_language_and_quality_keep_rows_unchanged(steps):
    given = {r.doc_id: r for r in steps[0]}
    assert all(r == given[r.doc_id] for r in steps[1] + steps[2] + steps[3])


def test_good_documents_stay(spark, folder, steps):
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in steps[2]}
    assert len(good & kept) >= 0.99 * len(good)
    bad = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 0").collect()}
    assert len(bad & kept) <= 0.5 * len(bad)


def test_one_of_each_group_stays(steps):
    groups = components([(r.doc_id, r.text) for r in steps[2]], 5, 80)
    assert {r.doc_id for r in steps[3]} == {d for d, (_, first) in groups.items() if d == first}


def test_repeats_go(steps):
    wanted = removed_bytes([(r.doc_id, r.text) for r in steps[3]])
    for r in steps[4]:
        data, gone, _ = wanted[r.doc_id]
        # A character stays unless all its bytes go.
        spans, at = [], 0
        for c in data.decode():
            size = len(c.encode())
            if not all(gone[at : at + size]):
                spans.append(c)
            at += size
        assert r.text == "".join(spans) and r.n_chars == len(r.text)


def test_sequences_hold_what_is_left(steps):
    found = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in steps[5]}
    assert found == {p for p, _ in pieces_of([(r.doc_id, r.text) for r in steps[4]])}
    check_sequences(steps[5], 1024)


def test_run_equals_its_stages(spark, folder, steps):
    rows = P.run(spark, folder).collect()
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in rows) == sorted(tuple(r[c] for c in columns) for r in steps[5])


@pytest.mark.parametrize("kind", ["none", "odd"])
def test_odd_documents(spark, folder, kind):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20)
    if kind == "none":
        docs = docs.where("false")
    else:
        odd = [(10**6, None, None, None, None), (10**6 + 1, "", "en", None, 0), (None, "text", "en", "s", 4), (10**6 + 2, "###", "?", "s", 3)]
        docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(2))
    docs = docs.withColumns({"score": F.lit("x"), "kept": F.lit(1)})
    for _, stage in P.STAGES:
        docs = P.cut_lineage(stage(spark, docs, folder))
    assert (docs.count() == 0) == (kind == "none")
