"""Fingerprints against a plain count of bits, links against all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sectoria.llm import fingerprints as P
from sectoria.llm.queries import op13_fingerprints

from .brute import LOWER, WORD


def plain_print(text):
    words = [w.translate(LOWER) for w in WORD.findall(text or "")]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in hashes) > len(hashes))


def plain_components(prints):
    """Smallest member of each fingerprint's component, over all pairs."""
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {p: root(p) for p in prints}


def plain(rows):
    prints = {}
    for i, text in rows:
        prints.setdefault(plain_print(text), []).append(i)
    groups = plain_components(list(prints))
    least = {}
    for p, ids in prints.items():
        known = [i for i in [*ids, least.get(groups[p])] if i is not None]
        least[groups[p]] = min(known) if known else None
    return [(i, f"{plain_print(t):016x}", least[groups[plain_print(t)]]) for i, t in rows]


def check(spark, documents, rows):
    found = [tuple(r) for r in P.near_fingerprints(documents(*rows)).collect()]
    assert sorted(found, key=str) == sorted(plain(rows), key=str)


def test_query_on_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in op13_fingerprints(spark, folder).collect()]
    assert sorted(found) == sorted(plain([tuple(d) for d in docs]))


def test_hash_is_that_of_spark(spark):
    row = spark.sql("SELECT xxhash64('a quick fox') AS h").first()
    (hashed,) = P.shingle_hashes(b"a quick fox")
    assert hashed.view(np.int64).tolist() == [row.h]


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_long_texts_in_pieces(size):
    rng = random.Random(size)
    text = "".join(rng.choice(["a", "bb", " ", "\n\t", "éü", "word "]) for _ in range(3000)).encode()
    assert [w for words in P.word_pieces(text, size) for w in words] == text.split()
    whole = np.concatenate(list(P.shingle_hashes(text)))
    assert (np.concatenate(list(P.shingle_hashes(text, size=size))) == whole).all()


def near(rng, p, bits):
    return p ^ sum(1 << k for k in rng.sample(range(64), bits))


def linked(spark, prints):
    signed = np.array(sorted(prints), dtype=np.uint64).view(np.int64).tolist()
    links = P.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "print long")).collect()
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        x, y = sorted((root(a % 2**64), root(b % 2**64)))
        parent[y] = x
    return {p: root(p) for p in prints}


def test_links_equal_all_pairs(spark):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0}
    for p in list(prints):
        prints |= {near(rng, p, rng.randint(1, 4)) for _ in range(4)}
    assert linked(spark, prints) == plain_components(prints)


@pytest.mark.parametrize("short", [2, 20, 256])
def test_crowds_that_share_most_bytes(spark, monkeypatch, short):
    """Fingerprints that differ in a few bytes, so that postings are long and go on by further bytes."""
    monkeypatch.setattr(P, "SHORT", short)
    rng = random.Random(short)
    base = rng.getrandbits(64)
    prints = {base ^ sum(rng.getrandbits(8) << 8 * k for k in rng.sample(range(8), 3)) for _ in range(500)}
    prints |= {base ^ rng.getrandbits(16) << 24 for _ in range(300)}
    assert linked(spark, prints) == plain_components(prints)


def test_every_way_to_differ_in_two_bits(spark):
    """Each pair on its own base, through short and long postings."""
    rng = random.Random(8)
    prints, pairs = set(), []
    for k in combinations(range(0, 64, 3), 2):
        p = rng.getrandbits(64)
        pairs.append((p, p ^ 1 << k[0] ^ 1 << k[1]))
        prints |= set(pairs[-1])
    found = linked(spark, prints)
    assert all(found[a] == found[b] for a, b in pairs)


def test_free_bytes_of_a_full_group():
    prints = np.arange(65536, dtype=np.uint64) << np.uint64(48)
    assert len(P.free_links(prints, (0, 1))) == 65535


def test_odd_texts(spark, documents):
    rows = [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, "one"),
        (4, "ONE"),
        (5, "two words"),
        (6, "two\nwords "),
        (7, "a b c a b c a b c"),
        (7, "a b c a b c a b c"),
        (8, "Été À la plage     x"),
        (None, "one"),
        (None, "nobody else has this text"),
        (9, "x" * 300_000),
        (10, "word " * 300_000),
    ]
    check(spark, documents, rows)


def test_frequent_copies_and_clashing_columns(spark, documents, monkeypatch):
    monkeypatch.setattr(P, "FREQUENT", 5)
    rows = [(i, "the same text in a third of all rows" if i % 3 else f"a text of its own number {i} {i * i}") for i in range(90)]
    check(spark, documents, rows)
    clashing = documents(*rows).withColumns({n: F.lit("x") for n in ("print", "n", "first", "component", "size", "posting")})
    assert sorted(tuple(r) for r in P.near_fingerprints(clashing).collect()) == sorted(plain(rows))
    assert P.near_fingerprints(documents(*rows).where("false")).collect() == []
