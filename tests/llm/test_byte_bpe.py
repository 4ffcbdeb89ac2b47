"""Byte-level encoding against the other library that reads the same ranks, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from linksieve.llm import byte_bpe

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n", "  a", "a  b   c \n\n d\t\te  ", "'s 'll don't we'Ve 12ab 3,5", "日本語。　テスト \x1c\x1d x",
    "\x85\x85a b", "🎉👩‍👩‍👧 🎉", "a" * 3000, "́é", "--------------- ====", " " * 999 + "x",
    "\x00\x01 ﻿�", "<|endoftext|> stays text",
]


@pytest.fixture(scope="module", params=[byte_bpe.RANKS, MULTI])
def both(request):
    other = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(request.param), special_tokens={}
    )
    return byte_bpe.ByteBpe(request.param), other


def ids_of(packed):
    return [np.frombuffer(ids, "<u4").tolist() for ids in packed]


def test_same_ids_as_the_other_library(both):
    bpe, other = both
    assert ids_of(bpe.encode(TEXTS)) == [other.encode_ordinary(t or "") for t in TEXTS]


def test_same_ids_on_random_texts(both):
    bpe, other = both
    draw = random.Random(5)
    signs = "ab' s\n\t  é日1.- \xa0　🎉\x1cEe''ll"
    for _ in range(40):
        texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(50)]
        assert ids_of(bpe.encode(texts)) == [other.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_decoding_gives_the_text_back(texts):
    bpe = byte_bpe.loaded()
    for text, ids in zip(texts, ids_of(bpe.encode(texts))):
        assert bpe.decode(ids) == text.encode()
        assert "".join(bpe.token_texts(ids)) == text
        assert bpe.encode_with_offsets(text)[0] == ids


def test_a_small_memory_changes_nothing(both, monkeypatch):
    bpe, other = both
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 2)
    monkeypatch.setattr(byte_bpe, "LONGEST", 3)
    for text in ["one two three", "two three four", "one five", "six two one"]:
        assert ids_of(bpe.encode([text, text])) == [other.encode_ordinary(text)] * 2


def test_offsets_and_split_characters():
    bpe = byte_bpe.loaded()
    ids, starts, ends = bpe.encode_with_offsets("日 é🎉!")
    assert len(ids) > 5  # several tokens share one character
    for i, text in enumerate(bpe.token_texts(ids)):
        assert text in ("", "日 é🎉!"[starts[i] : ends[i]])
    assert bpe.decode(ids[:-2]).decode("utf-8", "replace").startswith("日 é")
    # cut within a character: what is there decodes, the broken rest is one sign for it
    whole = bpe.encode_with_offsets("🎉")[0]
    assert bpe.token_texts(whole[:-1])[-1] == "�"


def test_ranks_without_merges_are_refused():
    ranks = {bytes([b]): b for b in range(256)}
    assert byte_bpe.merged_pairs({**ranks, b"ab": 256, b"abc": 257}) == [(b"a", b"b"), (b"ab", b"c")]
    with pytest.raises(ValueError, match="not merged"):
        byte_bpe.merged_pairs({**ranks, b"abc": 256})


def test_table(spark):
    rows = [(i % 3, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string")
    found = byte_bpe.round_trip(docs, keep=["doc_id", "N_Tokens"]).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(i) for i in ids_of(byte_bpe.loaded().encode(TEXTS)))
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.ids_sha256, r.decoded_sha256) for r in found if r.n_tokens == 0] == [(empty, empty)] * 2
    assert {r.decoded_sha256 for r in found} == {hashlib.sha256((t or "").encode()).hexdigest() for t in TEXTS}
    back = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, keep=["doc_id"])).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for t in TEXTS)
    assert all(len(r.starts) == len(r.ends) == r.n_tokens for r in back)
    assert byte_bpe.round_trip(docs.limit(0), keep=["doc_id"]).count() == 0
