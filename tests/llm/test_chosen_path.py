"""Near-duplicate components against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectoria.llm import bytetext, chosen_path
from sectoria.llm.chosen_path import connected, near_duplicates

from .brute import components


def varied(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, originals, copies, edits):
    rng = random.Random(seed)
    texts = []
    for _ in range(originals):
        base = [rng.choice(("of", "the", "and", f"w{rng.randrange(4000)}")) for _ in range(rng.randrange(30, 160))]
        texts.append(" ".join(base))
        texts += [varied(rng, base, rng.randrange(edits + 1)) for _ in range(rng.randrange(copies + 1))]
    rng.shuffle(texts)
    return texts


def check(documents, texts, parts=3):
    rows = list(enumerate(texts))
    found = {r.doc_id: r for r in near_duplicates(documents(*rows).repartition(parts)).collect()}
    expected = components(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == expected
    assert all(r.kept == (d == expected[d][1]) for d, r in found.items())


def test_groups_of_copies(documents):
    check(documents, corpus(3, 40, 6, 5))


def test_a_crowd_larger_than_a_node(documents):
    check(documents, corpus(4, 3, 250, 3) + corpus(5, 10, 2, 2))


def test_a_crowd_linked_only_to_its_original(documents):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    copies = []
    for i in range(60):
        words = list(base)
        for k in range(6):
            words[(i * 7 + k * 31) % 200] = f"own{i}x{k}"
        copies.append(" ".join(words))
    texts = [" ".join(base), *copies]
    rng.shuffle(texts)
    check(documents, texts)


def test_edges_of_the_definition(documents):
    texts = ["", None, " \t\n", "one", "One", "one two", "ONE two", "one two three", "one two three one two three", "É é", "é é"]
    check(documents, texts + [" x y", "x y"] + ["tie tie tie"] * 3)


def test_no_rows_null_ids_and_clashing_columns(documents):
    docs = documents((1, "a b c d"), (2, "A b c d"), (None, "a b c d")).withColumns(
        {"digest": F.lit(0), "component_id": F.lit("x"), "tokens": F.lit(None)}
    )
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()) == [(1, 1), (2, 1)]
    assert near_duplicates(docs.where("false")).collect() == []


@pytest.mark.parametrize("size", [2, 9, 40])
def test_connected_follows_chains_to_the_end(spark, size):
    order = list(range(size))
    random.Random(size).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {(r.v, r.component) for r in connected(edges).collect()} == {(v, 0) for v in range(size)}


def test_target_recall():
    miss = 1 - 0.85 * (1 - 0.15**chosen_path.BRANCHES) ** (chosen_path.LEVELS - 1)
    assert miss**chosen_path.TREES < 2e-6


def crowd_of_pairs(rng, pairs, shared, own, apart):
    """Pairs that share ``own`` shingles besides the ``shared`` words of all; each text ends with ``apart`` words of its own."""
    template = [f"t{k}" for k in range(shared)]
    made = []
    for i in range(pairs):
        pair = [f"p{i}x{k}" for k in range(own)]
        made += [" ".join(template + pair + [f"o{i}y{j}z{k}" for k in range(apart)]) for j in range(2)]
    rng.shuffle(made)
    return made


def test_pairs_inside_a_crowd_just_below_the_threshold(documents):
    texts = crowd_of_pairs(random.Random(11), 100, 184, 4, 14)
    check(documents, texts)
    assert len({c for _, c in components(list(enumerate(texts))).values()}) == 100


def test_links_of_a_crowd_by_common_shingles_only(documents, monkeypatch):
    """Variants of a template, each in many texts with words of their own: links go over the cores, also over different ones."""
    rng = random.Random(12)
    texts = []
    for v in range(4):
        template = [f"t{k}" for k in range(200)]
        template[20 * v : 20 * v + 3 * v] = [f"v{v}x{k}" for k in range(3 * v)]
        for i in range(30):
            texts.append(" ".join(template + [f"o{v}y{i}z{k}" for k in range(rng.choice((0, 12, 17, 25, 33)))]))
    rng.shuffle(texts)
    monkeypatch.setattr(chosen_path, "BLOCK", 20)
    monkeypatch.setattr(chosen_path, "COMMON", 20)
    check(documents, texts)


def test_words_that_collide_under_every_polynomial_are_not_linked(documents):
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2^64 for every odd base."""
    morse = "".join("ab"[i.bit_count() % 2] for i in range(2048))
    other = morse.translate(str.maketrans("ab", "ba"))
    rows = near_duplicates(documents((1, f"x {morse} z"), (2, f"x {other} z"), (3, f"X {morse} z"))).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 2, 3: 1}


def test_hashes_of_words_do_not_depend_on_blocks_or_places():
    data = np.frombuffer(b"one two  three one\x00 \x00 one " + "é".encode() * 3, dtype=np.uint8)
    starts, stops, _ = bytetext.word_spans(data, np.array([0, len(data)]))
    whole = bytetext.word_hashes(data, starts, stops)
    assert (whole == bytetext.word_hashes(data, starts, stops, block=2)).all()
    words = [data[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]
    assert len(set(words)) == len(set(whole.tolist())) == len(set(zip(words, whole.tolist(), strict=True)))


@pytest.mark.parametrize("percent", [80, 85])
def test_parities_lose_no_link(percent):
    rng = np.random.default_rng(3)
    linked = 0
    for size in (1, 2, 5, 40, 300, 3000):
        for share in (0.0, 0.05, 0.1, 0.2, 0.5):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            b = np.concatenate([a[round(size * share) :], rng.integers(0, 1 << 63, round(size * share / 4), dtype=np.uint64)])
            common = len(np.intersect1d(a, b))
            odd = [np.packbits((np.bincount((x % 1024).astype(int), minlength=1024) & 1).astype(bool)).view(np.uint64) for x in (a, b)]
            found = chosen_path.possible_members(np.array([1, 2]), np.array([len(a), len(b)]), np.array(odd), percent)
            if 100 * common >= percent * (len(a) + len(b) - common):
                linked += 1
                assert found.all()
            elif share == 0.5 and 40 <= size <= 300:
                assert not found.any()
            assert not chosen_path.possible_members(np.array([1, 1]), np.array([len(a), len(b)]), np.array(odd), percent).any()
    assert linked > 10
