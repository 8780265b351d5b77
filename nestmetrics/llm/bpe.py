"""BPE encoding and decoding by dynamic programming over prefixes.

The BPE encoding of a prefix of a word ends in exactly one token. For each prefix that token is found
without replaying merges: an automaton over the vocabulary lists the tokens that are suffixes of the
prefix, and the token t is the last one if and only if it is compatible with the last token of the
prefix without t, that is, if the pair of the two encodes to itself. Stored last tokens and
back-pointers then give the ids from the end. A word of n bytes takes n steps, also when it is a
megabyte long, where replaying merges takes n log n or n squared.

A vocabulary file of the tokenizers library is read as it is: its normaliser and splitter cut a text
into words (by the library itself; texts of plain Latin letters, where both are simple, are cut by an
equal pattern), the encoding of words is done here. Words and their ids are remembered up to a fixed
number, so memory is bounded.

Defined cases: null is an empty text and gives no ids. Special tokens' strings in a text become their
ids. A word with a byte that the vocabulary lacks raises. Decoding puts the tokens' texts in a row as
the library does without a decoder: with one space between. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from nestmetrics.llm.common import col, ship_code, table, text_of

#: Remembered chunks, words and pairs of one Python worker, about 200 bytes each. Workers live on between
#: stages, so this is memory that later stages lack.
MEMORY = 100_000
#: Longer chunks are not remembered.
MEMORABLE = 48
#: Below this code point NFC changes nothing, and case and categories are the same in every library.
LATIN_END = 0x0180
#: What the plain way does not treat as the library does: other scripts, a capital I with a dot, four
#: control characters that only Python takes for white space.
NOT_PLAIN = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]|[\\u0130\\x1c-\\x1f]")
WORD_BPE = "word_bpe_49k.json"


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others are counted up from code point 256.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def category_class(kind: str) -> str:
    """Characters below LATIN_END whose category starts with a letter, as ranges of a pattern."""
    codes = {c for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind}
    starts = sorted(c for c in codes if c - 1 not in codes)
    ends = sorted(c for c in codes if c + 1 not in codes)
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


class PrefixEncoder:
    """Ids of single words by the last token of each of their prefixes."""

    END = "\x01"  # stands for the end of a word; no byte character

    def __init__(self, vocabulary: dict[str, int], merges: list[list[str]], word_end: str):
        def inner(token: str) -> str:
            return token[: -len(word_end)] + self.END if word_end and token.endswith(word_end) else token

        self.end = self.END if word_end else ""
        ids = {inner(t): i for t, i in vocabulary.items()}
        #: When a pair merges; when a token is made, and of which pair.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in ids.items():
            if len(text) == 1 or (len(text) == 2 and text[-1] == self.END):
                self.made[i] = -1
                self.automaton.add_word(text, (len(text), i))
        for rank, (left, right) in enumerate(merges):
            a, b = ids[inner(left)], ids[inner(right)]
            text = inner(left) + inner(right)
            whole = ids[text]
            self.rank[a, b] = rank
            if whole not in self.made:
                self.made[whole], self.parts[whole] = rank, (a, b)
                self.automaton.add_word(text, (len(text), whole))
        self.automaton.make_automaton()
        self.fits = lru_cache(MEMORY)(self.compatible)

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are the encoding of their joined text.

        Merges are undone backwards in time. A pair across the border that would have merged before
        the merge just undone spoils it; of equal merges the left one comes first.
        """
        limit = len(self.rank) + 1
        made, parts, rank = self.made, self.parts, self.rank
        while True:
            if rank.get((left, right), limit) < limit:
                return False
            last_left, last_right = made[left], made[right]
            if last_left > last_right:
                limit, left = last_left, parts[left][1]
            elif last_right >= 0:
                limit, right = last_right + 1, parts[right][0]
            else:
                return True

    def encode(self, word: str) -> list[int]:
        """Ids of a word given in byte characters."""
        text = word + self.end
        n = len(text)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        fits = self.fits
        for end, (length, token) in self.automaton.iter(text):
            start = end + 1 - length
            # Longest first, and exactly one token fits.
            if last[end + 1] < 0 and (not start or (last[start] >= 0 and fits(last[start], token))):
                last[end + 1], back[end + 1] = token, start
        if n > len(self.end) and last[n] < 0:
            raise ValueError(f"the vocabulary lacks a byte of {word[:80]!r}")
        ids, at = [], n if word else 0
        while at:
            ids.append(last[at])
            at = back[at]
        return ids[::-1]


class Memory(dict):
    """Results of a function in two generations of a fixed size; what is used stays."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMORABLE:
            if len(self) >= MEMORY:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Texts to ids (as little-endian unsigned 32-bit bytes) and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        self.library = Tokenizer.from_file(path)
        model = content["model"]
        self.rules = (model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.tokens = [self.library.id_to_token(i) for i in range(self.library.get_vocab_size())]
        letters, digits = category_class("L"), category_class("N")
        blank = "\\t-\\r \\x85\\xa0"
        self.plain_word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{blank}{letters}{digits}]+")
        self.byte = byte_characters()
        self.printable = re.compile("[!-~]*").fullmatch
        self.words = Memory(self._word)
        self.chunks = Memory(self._chunk)

    @cached_property
    def encoder(self) -> PrefixEncoder:
        """Built with the first word that asks for it."""
        rules, self.rules = self.rules, None
        return PrefixEncoder(*rules)

    def _word(self, word: str) -> bytes:
        return np.array(self.encoder.encode(word), dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.words[w if self.printable(w) else "".join([self.byte[b] for b in w.encode()])] for w in self.plain_word.findall(chunk)])

    def encode(self, text: str) -> bytes:
        if self.cut and self.cut.search(text):
            return b"".join(
                self.special[part].to_bytes(4, "little") if part in self.special else self._encode(part)
                for part in self.cut.split(text)
            )
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        if not NOT_PLAIN.search(text):
            return b"".join(map(self.chunks.__getitem__, text.lower().split()))
        normal = self.library.normalizer.normalize_str(text)
        return b"".join([self.words[word] for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


class LibraryCodec(Codec):
    """The same ids, words encoded by the tokenizers library's own model."""

    def __init__(self, path: str):
        super().__init__(path)
        self.rules = None

    def _word(self, word: str) -> bytes:
        return b"".join([token.id.to_bytes(4, "little") for token in self.library.model.tokenize(word)])


@lru_cache(2)
def library_codec(path: str) -> LibraryCodec:
    """One codec for each vocabulary and worker."""
    return LibraryCodec(path)


@lru_cache(2)
def codec(path: str) -> Codec:
    """One codec for each vocabulary and worker."""
    return Codec(path)


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        this = codec(path)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = this.encode(text.as_py())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(this.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship_code(docs.sparkSession)
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-level vocabulary."""
    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
