"""Manifest against trees that are built anew for every row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sectoria.llm import manifest
from sectoria.llm.queries import SQL, op12_manifest

from .sqlcheck import check_sql

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc, _, lang, source, n = row
    values = (doc, source, lang, n, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, place):
    """Root of the nodes and siblings of one of them."""
    siblings = ""
    while len(nodes) > 1:
        first = place // 8 * 8
        siblings += "".join(d for i, d in enumerate(nodes[first : first + 8], first) if i != place)
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        place //= 8
    return nodes[0], siblings


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {
        lang: sorted([((r[0] is not None, r[0] or 0, leaf(r, r[1])), r) for r in rows if r[2] == lang], key=lambda x: x[0])
        for lang in langs
    }
    subroots = [climb([k[2] for k, _ in trees[lang]], 0)[0] for lang in langs]
    result = []
    for at, lang in enumerate(langs):
        leaves = [k[2] for k, _ in trees[lang]]
        for place, (_, row) in enumerate(trees[lang]):
            doc, text = row[0], row[1]
            subroot, low = climb(leaves, place)
            root, high = climb(subroots, at)
            text = text.translate({c: c + 32 for c in range(65, 91)}) if text is not None else None
            new = leaf(row, text) if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 else leaves[place]
            below = climb([*leaves[:place], new, *leaves[place + 1 :]], place)[0]
            folded = climb([*subroots[:at], below, *subroots[at + 1 :]], at)[0]
            result.append((doc, leaves[place], subroot, root, h(low + high), folded, folded == root))
    return result


def check(spark, rows):
    found = [tuple(r) for r in manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=str) == sorted(plain(rows), key=str)


def test_query_equals_its_sql(spark, folder):
    check_sql(spark, folder, op12_manifest, SQL["op12_manifest"])


@pytest.mark.parametrize("count", [1, 2, 8, 9, 64, 65, 200])
def test_rebuilt_trees(spark, monkeypatch, count):
    """Blocks of 8 leaves, so that a version goes on through several levels of blocks."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    langs = ["en", "fr", None, "", "é", "zz"]
    rows = [(i * 7 % 1009, f"Text {i} ABC", langs[i % (1 + count % 7) % 6], f"s{i}", i) for i in range(count)]
    rows += [(5000 + i, f"More {i}", "en", "s", 1) for i in range(count)]
    check(spark, rows)


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    check(spark, [(i, f"Text {i}", f"l{i % 70}", "s", i) for i in range(150)])


def test_nulls_repeats_and_odd_texts(spark):
    rows = [
        (None, "Without id", "en", "s", 1),
        (None, None, None, None, None),
        (1, "", "en", None, 0),
        (3, None, "en", "s", 2),
        (4, "CAPITALS É ü \U0001f600", "fr", "s", 3),
        (4, "other text of the id", "fr", "s", 3),
        (9, "Same", "fr", "s", 3),
        (9, "Same", "fr", "s", 3),
        (-7, "Negative", "", "s", -1),
        (12, "LONG " * 300_000, "en", "s", 1),
    ]
    check(spark, rows)


def test_clashing_columns_and_no_rows(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.withColumns({n: F.lit("x") for n in ("leaf", "place", "tree", "block", "root", "only", "sides")})
    assert sorted(tuple(r) for r in manifest.manifest(clashing).collect()) == sorted(plain(rows))
    empty = manifest.manifest(docs.where("false"))
    assert empty.collect() == [] and empty.columns == manifest.manifest(docs).columns


def test_a_version_copies_ancestors_only():
    tree = manifest.VersionedTree([h(str(i)) for i in range(100)])
    before = len(tree.digests)
    version = tree.changed(42, h("new"))
    assert len(tree.digests) - before == tree.height + 1 == 4
    rebuilt = manifest.VersionedTree([h("new" if i == 42 else str(i)) for i in range(100)])
    assert tree.digests[version] == rebuilt.digests[rebuilt.root]
    shared = set(tree.children[version]) & set(tree.children[tree.root])
    assert len(shared) == len(tree.children[tree.root]) - 1
    assert manifest.folded(h("new"), tree.siblings(42)) == tree.digests[version]
