"""Byte pair encoding and decoding with the vocabulary of a public tokenizer.

Encoding: a text is prepared (Unicode form, case, split into words) as the vocabulary
file declares. A word starts as a doubly linked list of byte symbols. A priority queue
holds the rank of every mergeable neighbouring pair; the lowest rank, leftmost first, is
merged, its new neighbours are queued, and entries whose symbols have changed since are
skipped as stale. A word of n symbols takes O(n log n) steps.

Decoding: the vocabulary strings of the ids are concatenated, with the separator that a
vocabulary without a decoder asks for.

Null text encodes as the empty list of ids, which decodes to the empty string; texts of
any length are encoded whole. Equal rows give equal rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField
from tokenizers import Tokenizer

from linksieve.llm.texts import remembered, text_columns

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: Distinct words, and pieces between white space, whose ids a generation holds.
REMEMBERED = 200_000

#: White space to Python, but not to Unicode and the tokenizer.
NOT_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in printable:
            symbols[byte] = chr(byte)
        else:
            symbols[byte] = chr(spare)
            spare += 1
    return symbols


def merge_symbols(ids: list[int], ranks: dict[int, tuple[int, int]]) -> list[int]:
    """``ids`` after all merges; ``ranks``: first << 32 | second -> (rank, id of the merged symbol)."""
    end = len(ids)
    ids = list(ids)
    before, after = list(range(-1, end - 1)), list(range(1, end + 1))
    pairs = [(left << 32) | right for left, right in zip(ids, ids[1:])]
    queue = [(found[0], i) for i, p in enumerate(pairs) if (found := ranks.get(p))]
    heapq.heapify(queue)
    while queue:
        rank, left = heapq.heappop(queue)
        right = after[left]
        if right >= end:
            continue  # stale: nothing follows any more
        found = ranks.get((ids[left] << 32) | ids[right])
        if found is None or found[0] != rank:
            continue  # stale: one of the two was merged since, or removed
        merged = ids[left] = found[1]
        ids[right] = -1
        follows = after[left] = after[right]
        after[right] = end
        if follows < end:
            before[follows] = left
            if found := ranks.get((merged << 32) | ids[follows]):
                heapq.heappush(queue, (found[0], left))
        leads = before[left]
        if leads >= 0 and (found := ranks.get((ids[leads] << 32) | merged)):
            heapq.heappush(queue, (found[0], leads))
    return [i for i in ids if i >= 0]


class _Remembered(dict):
    """Strings to their ids as little-endian bytes, computed when first asked for.

    Holds two generations: when the young one is full the old one goes, so strings in
    use stay and memory is bounded.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, string: str) -> bytes:
        found = self.old.get(string)
        if found is None:
            found = self.encode(string)
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if len(string) <= 64:
            self[string] = found
        return found


class Bpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        model = declared["model"]
        vocabulary = model["vocab"]
        prepared = Tokenizer.from_file(path)
        self.normalizer, self.splitter = prepared.normalizer, prepared.pre_tokenizer
        self.pattern = regex.compile(declared["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary = vocabulary
        self.special = {t["content"]: t["id"] for t in declared["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.ranks = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks[(vocabulary[left] << 32) | vocabulary[right]] = rank, vocabulary[left + right]
        self.strings = [""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.strings[i] = token
        self.separator = " " if declared["decoder"] is None else ""
        self.byte_symbols = byte_symbols()
        self.pieces = _Remembered(self._encode_piece)
        self.words = _Remembered(self._encode_word)

    def _symbols(self, word: str) -> str:
        return word if word.isascii() else "".join(map(self.byte_symbols.__getitem__, word.encode()))

    def _encode_word(self, symbols: str) -> bytes:
        names = [*symbols[:-1], symbols[-1] + self.suffix]
        ids = [self.vocabulary[s] for s in names if s in self.vocabulary]
        return b"".join([i.to_bytes(4, "little") for i in merge_symbols(ids, self.ranks)])

    def _encode_piece(self, piece: str) -> bytes:
        if "<" not in piece and max(piece) < "\u0100" and piece.isprintable():
            # composed already, and of the same case and class under every Unicode version
            return b"".join([self.words[self._symbols(word)] for word in self.pattern.findall(piece.lower())])
        ids = b""
        for part in self.special_split.split(piece) if "<" in piece else [piece]:
            if part in self.special:
                ids += self.special[part].to_bytes(4, "little")
            elif part:
                words = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))
                ids += b"".join([self.words[word] for word, _ in words])
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        text = text or ""
        if NOT_SPACE.search(text):
            return self._encode_piece(text)
        return b"".join(map(self.pieces.__getitem__, text.split()))

    def decode(self, ids: bytes) -> str:
        return self.separator.join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_texts(df: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` and ``n_tokens`` long, ``ids`` binary (little-endian unsigned 32-bit)."""

    def make():
        bpe = loaded(vocabulary)

        def compute(texts):
            ids = [bpe.encode(t) for t in texts]
            return [len(i) // 4 for i in ids], ids

        return compute

    return text_columns(df, make, [StructField("n_tokens", LongType()), StructField("ids", BinaryType())], text, keep)


def decode_ids(df: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` and ``decoded``, the text of its ids; null ids give null."""

    @F.pandas_udf(StringType())
    def decoded(series):
        bpe = loaded(vocabulary)
        return series.map(bpe.decode, na_action="ignore")

    return df.withColumn("decoded", decoded(ids))


def loaded(path: str) -> Bpe:
    """The encoder of this worker process, kept from task to task."""
    return remembered(("bpe", path), lambda: Bpe(path))


def round_trip(df: DataFrame, text: str = "text", keep: list[str] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts and digests of ids and decoded text, without carrying either along."""

    def make():
        bpe = loaded(vocabulary)

        def compute(texts):
            ids = [bpe.encode(t) for t in texts]
            return (
                [len(i) // 4 for i in ids],
                [hashlib.sha256(i).hexdigest() for i in ids],
                [hashlib.sha256(bpe.decode(i).encode("utf-8", "surrogatepass")).hexdigest() for i in ids],
            )

        return compute

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return text_columns(df, make, fields, text, keep)
