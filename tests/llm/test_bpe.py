"""Prefix encoding against the tokenizers library."""

import hashlib
import random
from sys import getsizeof
from types import SimpleNamespace

import pyarrow as pa
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sectoria.llm import bpe
from sectoria.llm.bpe import PrefixCoder, encoded, encoding_digests

NAME = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(NAME)


@pytest.fixture(scope="module")
def coder():
    with open(NAME, encoding="utf-8") as file:
        return PrefixCoder(file.read())


def texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñçœ'ÀÉ ΣΑΣ 日本語カ한글 🙂👍🏽 0123456789 \t\n.,!?-_<|>#"
    yield from (
        "",
        " ",
        "a",
        "It's they'll we've I'd",
        "aaaaaaaaaaaaaaaaaaaaaaaa",
        "ababababababab",
        "<|startoftext|>hello<|endoftext|> <|endoftext|>",
        "<|endoftex",
        "ΟΔΥΣΣΕΥΣ İstanbul ǅ é ẛ̣ ﬁ",
        "x y z​q \x00 \x1c",
        "1234567890 ½ ² Ⅷ",
        "loooooool " * 50,
        "z" * 3000,
    )
    for _ in range(600):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(1, 60)))
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    for _ in range(400):
        yield " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) for _ in range(12))


def test_ids_and_decoded_text_equal_the_library(coder, library):
    for text in texts():
        wanted = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == (wanted, library.decode(wanted, skip_special_tokens=False)), text


def test_every_token_of_the_vocabulary(coder, library):
    words = [t.removesuffix("</w>") for t in list(library.get_vocab())[::29]]
    for text in words:
        assert coder.encode(text)[0] == library.encode(text, add_special_tokens=False).ids


def test_operator_on_given_texts(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = encoding_digests(encoded(docs)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_nulls_repeats_clashing_columns_and_no_rows(documents):
    docs = documents((1, None), (None, "hello"), (2, ""), (3, "hello"), (3, "hello")).withColumn("ids", F.lit("x"))
    rows = sorted(((r.doc_id or 0), r.n_tokens, len(r.ids), r.decoded) for r in encoded(docs).collect())
    assert rows == [(0, 1, 1, "hello</w>"), (1, 0, 0, ""), (2, 0, 0, "")] + [(3, 1, 1, "hello</w>")] * 2
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.ids_sha256 for r in encoding_digests(encoded(docs)).where("n_tokens = 0").collect()} == {empty}
    assert encoded(docs.where("false")).collect() == []


def test_kept_words_and_open_batches_are_bounded(coder, monkeypatch):
    with open(NAME, encoding="utf-8") as file:
        described = file.read()
    monkeypatch.setattr(bpe, "KEPT_BYTES", 100_000)
    small = PrefixCoder(described)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(3000)]
    assert small.encode(" ".join(words + words)) == coder.encode(" ".join(words + words))
    kept = [x for known in (small.words, small.older) for item in known.items() for x in item]
    assert 0 < sum(map(getsizeof, kept)) <= bpe.KEPT_BYTES

    rows = pa.record_batch([pa.array(range(25_000), pa.int64()), pa.array([None] * 25_000, pa.string())], ["doc_id", "text"])
    sizes = [batch.num_rows for batch in bpe._code(SimpleNamespace(value=described))(iter([rows]))]
    assert sum(sizes) == 25_000 and max(sizes) <= bpe.BATCH_ROWS


def test_long_text_in_blocks(coder, monkeypatch):
    text = " ".join(texts())
    wanted = coder.encode(text)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 7)
    assert coder.encode(text) == wanted
