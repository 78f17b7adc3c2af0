"""Packing, Huffman files and the word cache."""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starblend.llm import huffman, packing, token_ids
from starblend.llm.settings import END_ID, tokenizer_path
from tests.llm import brute

SCHEMA = "doc_id long, text string, start string, length string, sequence_id int"
HARD = [
    "", None, " \n ", "It's DON'T we'll 12345 a1b2", "<|endoftext|> and <|startoftext|>x", "é Å ẞ İ ΣΣ σ",
    "a\x0bb\x0cc\x1cd\x85e f g", "中文， emoji \U0001f600!", "x" * 300, "word " * 9000, "don 't", "a  b\r\n\tc",
]


def test_cached_words_give_the_tokenizers_ids():
    texts = HARD + [t for _, t, *_ in brute.rows(brute.SMALL, "documents")]
    encoder = token_ids.Encoder(tokenizer_path(), END_ID)
    found = list(encoder.encode([(t or "").encode() for t in texts]))
    assert [f.tolist() for f in found] == [brute.ids(t) for t in texts]


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 3)
    encoder = token_ids.Encoder(tokenizer_path(), END_ID)
    for text in ("one two three four", "four five one", "six"):
        assert next(encoder.encode([text.encode()])).tolist() == brute.ids(text)


def check_packing(rows, docs, capacity=4096):
    ids = {d: brute.ids(t) for d, t in docs}
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == brute.crc(ids[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(ids[r.doc_id])
        of_doc[r.doc_id].append((r.start, r.length))
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for d, values in ids.items():
        at = 0
        for start, length in sorted(of_doc[d]):
            assert start == at
            at += length
        assert at == len(values)
    for members in of_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(map(len, ids.values()))
    return total, len(of_sequence)


def test_packing_of_documents(spark, work):
    docs = [(r[0], r[1]) for r in brute.rows(brute.SMALL, "documents")]
    table = spark.createDataFrame([(d, t, "x", None, 1) for d, t in docs], SCHEMA).repartition(5)
    rows = packing.pack(packing.pieces(table, tokenizer_path(), END_ID), work).collect()
    total, sequences = check_packing(rows, docs)
    assert total / (4096 * sequences) > 0.93


def test_packing_defined_cases(spark, work):
    docs = list(enumerate(HARD))
    table = spark.createDataFrame([(d, t, "x", None, 1) for d, t in docs], SCHEMA)
    check_packing(packing.pack(packing.pieces(table, tokenizer_path(), END_ID), work).collect(), docs)
    again = spark.createDataFrame([(None, "a", "", "", 0), (1, "b", "", "", 0), (1, "b", "", "", 0)], SCHEMA)
    rows = packing.pack(packing.pieces(again, tokenizer_path(), END_ID), work).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(packing.pieces(table.limit(0), tokenizer_path(), END_ID), work).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    packs = packing.patterns(histogram, 64)
    held = Counter()
    for count, lengths in packs:
        assert sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True)
        held.update({n: count * k for n, k in Counter(lengths).items()})
    assert held == histogram
    assert len(packs) <= 2 * 64


def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    return cost


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60))
def test_code_lengths(counts):
    counts = np.array(counts)
    free = huffman.code_lengths(counts, 62)
    used = counts > 0
    assert np.array_equal(free > 0, used)
    if used.sum() > 1:
        assert (counts * free).sum() == huffman_cost(counts)
        assert sum(2.0 ** -int(n) for n in free[used]) == 1
        tight = huffman.code_lengths(counts, 6)
        assert tight.max() <= 6 and sum(2.0 ** -int(n) for n in tight[used]) <= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=1200))
def test_bits_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids))
    bits, marks = huffman.encode(ids, lengths, huffman.canonical(lengths))
    assert len(marks) == -(-len(ids) // huffman.STRIDE)
    assert np.array_equal(huffman.Decoder(lengths).decode(bits, marks, len(ids)), ids)


@pytest.mark.parametrize("block", [100, 1 << 16])
def test_files_of_documents(spark, work, monkeypatch, block):
    monkeypatch.setattr(huffman, "BLOCK_IDS", block)
    docs = [(5 * d - 300, t) for d, t in enumerate(HARD + [r[1] for r in brute.rows(brute.SMALL, "documents")])]
    table = spark.createDataFrame([(d, t, "x", None, 1) for d, t in docs], SCHEMA).repartition(6)
    folder = work.path("files")
    huffman.write(table, folder, work, tokenizer_path(), END_ID)
    want, at = [], 0
    for d, t in sorted(docs):
        ids = brute.ids(t)
        want.append((d, at, len(ids), brute.crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in huffman.checksums(spark, folder).collect()) == want


def test_files_defined_cases(spark, work):
    table = spark.createDataFrame([(None, "a", "", "", 0), (1, "b", "", "", 0), (1, "b", "", "", 0), (0, None, "", "", 0)], SCHEMA)
    folder = work.path("files")
    huffman.write(table, folder, work, tokenizer_path(), END_ID)
    rows = sorted((tuple(r) for r in huffman.checksums(spark, folder).collect()), key=lambda r: r[1])
    assert [(r[0], r[1], r[2]) for r in rows] == [(None, 0, 2), (0, 2, 1), (1, 3, 2), (1, 5, 2)]
    empty = work.path("empty")
    huffman.write(table.limit(0), empty, work, tokenizer_path(), END_ID)
    assert huffman.checksums(spark, empty).collect() == []
