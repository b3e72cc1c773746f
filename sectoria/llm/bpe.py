"""Byte-pair encoding by one dynamic program over the prefixes of a word.

Every prefix of a word has one encoding, so it has one last token. A token that ends at a prefix is that last token exactly
if it may follow the last token of the rest: if no merge across their border comes before the merges that made the two
sides. An automaton over the vocabulary lists the tokens that end at each place; the first compatible one is stored, and
the ids follow from the back-pointers. Words are coded once and looked up afterwards.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice
from sys import getsizeof

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import release_memory, released

WORD_END = "</w>"
# What a worker keeps at most: bytes of coded words, about half of them of those used last, and pairs of tokens.
KEPT_BYTES = 40_000_000
KEPT_ENTRY = 64
KEPT_PAIRS = 150_000
PAIR_BITS = 32
# A batch of results ends after so many characters or rows; the words of a longer text are listed in blocks of so many.
BATCH_BYTES = 1_000_000
BATCH_ROWS = 10_000
LONG_TEXT = 1_000_000
WORDS_AT_ONCE = 100_000
# Symbols of a word: the bytes as they are, and from here on the bytes that end a word.
ENDING = 256
CODED = "doc_id long, n_tokens long, ids array<int>, decoded string"


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCoder:
    """Encoder and decoder for a byte-level BPE vocabulary whose last symbol of a word carries ``WORD_END``."""

    def __init__(self, described: str):
        tokenizer = json.loads(described)
        model, alphabet = tokenizer["model"], byte_alphabet()
        if model["end_of_word_suffix"] != WORD_END or model["type"] != "BPE":
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.text_of: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        places = max(self.text_of) + 1

        def symbols(token: str) -> str:
            body = token.removesuffix(WORD_END)
            codes = [alphabet[c] for c in body]
            if body != token:
                codes[-1] += ENDING
            return "".join(map(chr, codes))

        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        id_of: dict[str, int] = {}
        self.rank: dict[int, int] = {}
        self.merge_rank: dict[int, int] = {}
        # The tokens that a merged token was made of, by its id.
        self.left, self.right = [-1] * places, [-1] * places
        for token, i in model["vocab"].items():
            if len(token.removesuffix(WORD_END)) == 1 and token.removesuffix(WORD_END) in alphabet:
                id_of[symbols(token)] = i
                self.rank[i] = -1
        for place, (left, right) in enumerate(merges):
            whole, a, b = (model["vocab"][t] for t in (left + right, left, right))
            self.merge_rank.setdefault(a << PAIR_BITS | b, place)
            if whole not in self.rank:
                self.rank[whole] = place
                self.left[whole], self.right[whole] = a, b
                id_of[symbols(left + right)] = whole
        self.pairs: dict[int, bool] = {}
        # Coded words: ids as the bytes of 32-bit numbers, which the garbage collector need not follow.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = 0
        self.specials = {t["content"]: t["id"] for t in tokenizer["added_tokens"]}
        self.text_of |= {i: t for t, i in self.specials.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.word = regex.compile(tokenizer["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.matches = ahocorasick.Automaton()
        self._add_tokens(id_of)

    def _add_tokens(self, id_of: dict[str, int]) -> None:
        """Only tokens that are the encoding of their own symbols can end a prefix; shorter ones are settled first."""
        single: set[int] = set()
        for text, i in sorted(id_of.items(), key=lambda x: len(x[0])):
            left, right = self.left[i], self.right[i]
            if left < 0 or (left in single and right in single and self._last_merge(left, right, self.rank[i])):
                single.add(i)
                self.matches.add_word(text, (len(text), i))
        self.matches.make_automaton()

    def _last_merge(self, left: int, right: int, rank: int) -> bool:
        return self.merge_rank[left << PAIR_BITS | right] == rank and self._compatible(left, right, before=rank)

    def _compatible(self, left: int, right: int, before: int | None = None) -> bool:
        """No merge over the border of two tokens comes before the merges that closed the border's sides.

        Merges of one rank run from left to right, so at equal rank the left side was closed first.
        """
        limit = len(self.merge_rank) if before is None else before
        while True:
            over = self.merge_rank.get(left << PAIR_BITS | right)
            if over is not None and over < limit:
                return False
            if self.rank[left] < 0 and self.rank[right] < 0:
                return True
            if self.rank[left] > self.rank[right]:
                limit = min(limit, self.rank[left])
                left = self.right[left]
            else:
                limit = min(limit, self.rank[right] + 1)
                right = self.left[right]

    def encode_symbols(self, text: str) -> list[int]:
        """Ids of one word given as symbols: last token of every prefix, then the way back."""
        last = [-1] * (len(text) + 1)
        size = [0] * (len(text) + 1)
        pairs = self.pairs
        for end, (length, token) in self.matches.iter(text):
            end += 1
            if size[end]:
                continue
            if end != length:
                before = last[end - length]
                if before < 0:
                    continue
                pair = before << PAIR_BITS | token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self._compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids, end = [], len(text)
        while end:
            ids.append(last[end])
            end -= size[end]
        ids.reverse()
        return ids

    def encode_word(self, word: str) -> bytes:
        """Ids of a word; those of words that are not too long are kept as long as they are used and ``KEPT_BYTES`` allow."""
        ids = self.older.get(word)
        if ids is None:
            data = word.encode()
            ids = array("i", self.encode_symbols(data[:-1].decode("latin-1") + chr(data[-1] + ENDING))).tobytes()
        if len(word) <= 64:
            size = getsizeof(word) + getsizeof(ids) + KEPT_ENTRY
            if self.kept + size > KEPT_BYTES // 2:
                self.older, self.words, self.kept = self.words, {}, 0
            self.words[word] = ids
            self.kept += size
        return ids

    def decode(self, ids: list[int]) -> str:
        """Tokens without a decoder are joined by a space."""
        return " ".join(map(self.text_of.__getitem__, ids))

    def _word_lists(self, text: str) -> Iterator[list[str]]:
        """The words of a text, at once or for a long text in blocks."""
        if len(text) <= LONG_TEXT:
            yield self.word.findall(text)
            return
        words = (found.group() for found in self.word.finditer(text))
        while block := list(islice(words, WORDS_AT_ONCE)):
            yield block

    def token_ids(self, text: str) -> np.ndarray:
        """Ids of a text; special tokens in the text stand for themselves."""
        ids: list[bytes] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                ids.append(array("i", [self.specials[part]]).tobytes())
                continue
            # Lower case is taken character by character, so a sigma never takes its final form.
            for words in self._word_lists(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()):
                known = self.words
                coded = []
                for word in words:
                    found = known.get(word)
                    if found is None:
                        found = self.encode_word(word)
                        known = self.words
                    coded.append(found)
                ids.append(b"".join(coded))
        return np.frombuffer(b"".join(ids), dtype=np.int32)

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a text and their decoded text."""
        ids = self.token_ids(text).tolist()
        return ids, self.decode(ids)


_CODERS: dict[int, PrefixCoder] = {}


def shared_coder(described) -> PrefixCoder:
    """One coder for each worker process and vocabulary."""
    key = hash(described.value)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = PrefixCoder(described.value)
        release_memory()
    return _CODERS[key]


def _code(described):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared_coder(described)
        docs: list[int | None] = []
        counts: list[int] = []
        ids: list[np.ndarray] = []
        decoded: list[str] = []

        def ready() -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, type=pa.int64()),
                    pa.array(counts, type=pa.int64()),
                    pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)),
                    pa.array(decoded, type=pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )
            for part in (docs, counts, ids, decoded):
                part.clear()
            return batch

        size = 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = coder.token_ids(text.as_py() or "")
                back = coder.decode(found.tolist())
                docs.append(doc)
                counts.append(len(found))
                ids.append(found)
                decoded.append(back)
                size += len(back)
                if size >= BATCH_BYTES or len(docs) >= BATCH_ROWS:
                    yield ready()
                    size = 0
        if docs:
            yield ready()

    return run


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Token ids of every text and the text decoded from them: ``doc_id``, ``n_tokens``, ``ids``, ``decoded``.

    ``tokenizer`` is the path of a description with word ends (lower-cased, white space dropped). Null and empty texts have
    no tokens; a null doc_id stays null; repeated rows get a row each; further columns are not looked at.
    """
    with open(tokenizer or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        described = docs.sparkSession.sparkContext.broadcast(file.read())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(_code(described)), CODED)


def encoding_digests(coded: DataFrame) -> DataFrame:
    """Hashes of the decimal ids joined by a space and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
