"""Byte-level BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest

from starblend.llm import byte_bpe
from starblend.llm.queries import QUERIES
from starblend.llm.settings import BYTE_TOKENIZER, tokenizer_path
from tests.llm import brute

PATH = tokenizer_path(BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def same(library, texts):
    codec = byte_bpe.Codec(PATH)
    got = list(codec.encode([t.encode() for t in texts]))
    for text, ids, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text[:80]
        assert codec.vocabulary.decode(ids.astype("int64")) == library.decode(want.ids, skip_special_tokens=False)


def test_texts_equal_the_library(library):
    rng = random.Random(1)
    texts = ["", " ", "\n\n ", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "don't they'll I'M  \n\n x", "中文" * 300, "x\u0085y  z"]
    texts += ["".join(chr(rng.randrange(1, 0x2FFF)) for _ in range(300)) for _ in range(50)]
    texts += ["".join(rng.choice("ab cd'e1\n") for _ in range(200)) for _ in range(200)]
    same(library, texts)


def test_characters_of_newer_unicode_versions(library):
    """The library decides what is a letter, also where the pattern's Unicode version says otherwise."""
    codes = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    same(library, ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}!" for c in codes[i : i + 5000]) for i in range(0, len(codes), 50_000)])
    same(library, ["a՘b 1౜\U00010940 ₏ꟍ x"])


def test_long_pieces_and_long_texts(library):
    rng = random.Random(2)
    same(library, ["a" * 5000, "".join(rng.choice("abcdefgh") for _ in range(20_000)), "=" * 3000 + "z"])
    same(library, ["".join(rng.choice(["the ", "quick\n\n", "  brown", "'s ", "été "]) for _ in range(300_000))])


def test_cache_may_be_forgotten(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    monkeypatch.setattr(byte_bpe, "STEP_BYTES", 2000)
    rng = random.Random(3)
    same(library, [" ".join("".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 9))) for _ in range(3000)) for _ in range(4)])


def test_unknown_ids_and_broken_bytes():
    vocabulary = byte_bpe.codec(PATH).vocabulary
    import numpy as np

    assert vocabulary.decode(np.array([10**6, -1, *vocabulary.first[[0xE4, 0x61]]])) == "�a"


def test_defined_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, [7], "x"), (2, "", None, None), (None, "a b", None, "y"), (3, "a b", None, "y"), (3, "a b", None, "y")],
        "doc_id long, text string, ids array<int>, decoded string",
    )
    rows = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id or 0), len(r.ids), r.text) for r in rows) == [(0, 2, "a b"), (1, 0, ""), (2, 0, ""), (3, 2, "a b"), (3, 2, "a b")]
    assert byte_bpe.encode(docs.limit(0), PATH).collect() == []
    assert byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first().text == ""


def test_query_equals_the_library(spark, library):
    texts = {r[0]: r[1] or "" for r in brute.rows(brute.SMALL, "documents")}
    got = QUERIES["op12_rank_array_bpe"](spark, brute.SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
