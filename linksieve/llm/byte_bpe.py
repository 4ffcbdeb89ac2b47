"""Byte-level byte pair encoding with the tokenizers library, from a file of merge ranks.

Every byte is written as one printable character, so the library's models, which merge
characters, merge bytes. A file of ranks holds token strings only; the pair a token is merged
from is found by merging its bytes under the ranks below its own. If that leaves two parts for
every token, which is checked, then merging the listed pairs in order of rank and merging
whatever pair makes the token of lowest rank come to the same ids.

A text is cut into runs of visible characters, each with the blank before it, and runs of
white space. Matches of the pattern never cross these cuts, so a run has the same ids wherever
it stands; runs met before are remembered, new ones of an Arrow batch are encoded together.

Decoding reverses the byte table: ids to characters to bytes. A character whose bytes stand in
several tokens belongs to the token that completes it; bytes that make no character, as where ids
were cut within one, are read as U+FFFD.

Null text encodes as the empty list of ids, which decodes to the empty string; texts of any
length are encoded whole. Equal rows give equal rows, an empty table an empty one.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField

from linksieve.llm.texts import remembered, text_columns

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Runs of up to ``LONGEST`` characters that one generation of the memory holds.
REMEMBERED, LONGEST = 200_000, 64

# Unicode's White_Space, which is what the pattern's \s stands for (Python's has four signs more).
_SPACE = "".join(
    map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_RUNS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if visible in Latin-1, else the next from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merged_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts of every token of several bytes, by rank.

    Raises ``ValueError`` where a token's bytes do not come down to two parts under the ranks below it.
    """
    pairs = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            lowest = min(found)
            if lowest >= rank:
                raise ValueError(f"token {token!r} is not merged from two others")
            at = found.index(lowest)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        pairs.append((parts[0], parts[1]))
    return pairs


class ByteBpe:
    """Encoder and decoder for one file of ranks and one pattern."""

    def __init__(self, path: str = RANKS, pattern: str = public_tokenizers.PATTERN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        characters = byte_characters()

        def written(token: bytes) -> str:
            return "".join(map(characters.__getitem__, token))

        vocabulary = {written(token): rank for token, rank in ranks.items()}
        merges = [(written(a), written(b)) for a, b in merged_pairs(ranks)]
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), "isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        byte_of = {c: b for b, c in enumerate(characters)}
        size = 1 + max(vocabulary.values())
        self.bytes_of = [b""] * size
        for string, i in vocabulary.items():
            self.bytes_of[i] = bytes(map(byte_of.__getitem__, string))
        self.decimals = [str(i) for i in range(size)]
        self.newline = vocabulary[characters[0x0A]]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, runs: set[str]) -> None:
        """Have the ids of all ``runs`` in the young generation; those in use move on from the old one."""
        if len(self.young) >= REMEMBERED:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        visible, blank = [], []
        for run in runs.difference(young):
            if run in old:
                young[run] = old[run]
            elif run.isspace():
                blank.append(run)
            else:
                visible.append(run)
        if visible:
            # a line feed between two runs is a match of its own, and stands in no visible run
            (whole,) = self.tokenizer.encode_batch_fast(["\n".join(visible)], add_special_tokens=False)
            ids = np.array(whole.ids, "<u4")
            ends = (4 * np.flatnonzero(ids == self.newline)).tolist()
            whole = ids.tobytes()
            young.update(
                (run, whole[s:e]) for run, s, e in zip(visible, [0, *(e + 4 for e in ends)], [*ends, len(whole)])
            )
        for run in blank:
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
            young[run] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        split = [_RUNS.findall(t or "") for t in texts]
        runs = set().union(*split)
        self._learn(runs)
        ids = [b"".join(map(self.young.__getitem__, found)) for found in split]
        for run in runs:
            if len(run) > LONGEST:
                del self.young[run]
        return ids

    def encode_with_offsets(self, text: str | None) -> tuple[list[int], list[int], list[int]]:
        """Ids, and the code points from which and up to which each token reads the text.

        Tokens that share a character's bytes all read that character.
        """
        whole = self.tokenizer.encode(text or "", add_special_tokens=False)
        return whole.ids, [start for start, _ in whole.offsets], [end for _, end in whole.offsets]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def token_texts(self, ids) -> list[str]:
        """What each token adds to the decoded text; joined, they are the whole of it."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        texts = [reader.decode(self.bytes_of[i]) for i in ids]
        if texts:
            texts[-1] += reader.decode(b"", final=True)
        return texts


def loaded(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
    """The encoder of this worker process, kept from task to task."""
    return remembered(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode_texts(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    ranks: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``df`` and ``n_tokens`` long, ``ids`` binary (little-endian unsigned 32-bit), ``starts``, ``ends``.

    The last two are arrays of code points, one entry per token.
    """

    def make():
        bpe = loaded(ranks, pattern)

        def compute(texts):
            made = [bpe.encode_with_offsets(t) for t in texts]
            ids = [np.array(m[0], "<u4").tobytes() for m in made]
            return [len(m[0]) for m in made], ids, [m[1] for m in made], [m[2] for m in made]

        return compute

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids", BinaryType()),
        StructField("starts", ArrayType(IntegerType())),
        StructField("ends", ArrayType(IntegerType())),
    ]
    return text_columns(df, make, fields, text, keep)


def decode_ids(
    df: DataFrame, ids: str = "ids", ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """``df`` and ``decoded``, the text of its ids; null ids give null."""

    @F.pandas_udf(StringType())
    def decoded(series):
        bpe = loaded(ranks, pattern)
        return series.map(
            lambda i: bpe.decode(np.frombuffer(i, "<u4")).decode("utf-8", "replace"), na_action="ignore"
        )

    return df.withColumn("decoded", decoded(ids))


def round_trip(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    ranks: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Counts and digests of ids and decoded bytes, without carrying either along.

    ``ids_sha256`` is of the ids in decimal, joined by one space.
    """

    def make():
        bpe = loaded(ranks, pattern)

        def compute(texts):
            encoded = [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode(texts)]
            joined = [" ".join(map(bpe.decimals.__getitem__, ids)) for ids in encoded]
            return (
                [len(ids) for ids in encoded],
                [hashlib.sha256(j.encode()).hexdigest() for j in joined],
                [hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in encoded],
            )

        return compute

    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return text_columns(df, make, fields, text, keep)
