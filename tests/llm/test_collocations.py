"""Quotient filters and phrases against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starblend.llm import collocations
from starblend.llm.quotient_filter import Shape

SCHEMA = "doc_id long, text string, lang string, word string, gram int, stream binary, n long"


def brute(docs, least, most=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {g: c for g, c in counts.items() if len(g) > 1 and c >= least}
        found = []
        for g, a in often.items():
            if any(len(h) > len(g) and 100 * c >= 100 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, c in often.items()):
                continue
            cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize(("words", "bits"), [(2, 1), (2, 9), (3, 17), (4, 16), (5, 12), (5, 13), (5, 25), (5, 31)])
def test_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    shape = Shape(words, bits)
    top = min(1 << bits, 40)
    ids = [rng.integers(0, top, 3000) * ((1 << bits) // top) for _ in range(words)]
    packed = shape.pack(ids)
    lanes = shape.permute(packed)
    assert all((a == b).all() for a, b in zip(shape.unpack(packed), ids, strict=True))
    assert all((a == b).all() for a, b in zip(shape.restore(lanes), packed, strict=True))
    want = Counter(zip(*(c.tolist() for c in ids), strict=True))
    want[tuple(c[0] for c in map(np.ndarray.tolist, ids))] += 700  # a counter past one byte
    lanes = [np.concatenate([lane, np.repeat(lane[:1], 700)]) for lane in lanes]
    for bucket_bits in (0, min(3, shape.head_bits - 1)):
        merged = defaultdict(list)
        for a, b in ((0, 1000), (1000, 1001), (1001, 3700)):  # three shards with filters of different sizes
            for bucket, data in shape.write(*shape.tally([lane[a:b] for lane in lanes]), bucket_bits):
                merged[bucket].append(shape.read(bucket, data, bucket_bits))
        got = Counter()
        for parts in merged.values():
            all_lanes, counts = shape.tally([np.concatenate(x) for x in zip(*(p for p, _ in parts))], np.concatenate([c for _, c in parts]))
            grams = zip(*(c.tolist() for c in shape.unpack(shape.restore(all_lanes))), strict=True)
            for gram, c in zip(grams, counts.tolist(), strict=True):
                assert gram not in got
                got[gram] = c
        assert got == want


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "in", "a", "b", "c", "été", "hot", "dog", "中文"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", " ! ", "\r\n"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.randrange(2, 14)]) + rng.choice(ends) for _ in range(rng.randrange(0, 40)))
        if rng.random() < 0.4:
            text += " new York city of the hot dog"
        out.append((text, rng.choice(["en", "en", "de", None])))
    return out


@pytest.mark.parametrize(("seed", "least"), [(1, 3), (2, 10), (3, 40)])
def test_phrases_equal_plain_counting(spark, work, seed, least):
    docs = [*corpus(seed), (None, "en"), ("", None), (None, None), ("one two three", "fr"), *[("same old words here", "es")] * 50]
    frame = spark.createDataFrame([(i, t, lang, "x", 1, None, 5) for i, (t, lang) in enumerate(docs)], SCHEMA).repartition(5)
    assert rows(collocations.collocations(frame, work, least)) == brute(docs, least)
    assert rows(collocations.collocations(frame, work, least, most=3)) == brute(docs, least, 3)


def test_full_maps_and_small_streams_change_nothing(spark, work, monkeypatch):
    monkeypatch.setattr(collocations, "MARK_BITS", 10)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 50)
    monkeypatch.setattr(collocations, "OPEN_WORDS", 40)
    monkeypatch.setattr(collocations, "HELD", 500)
    docs = corpus(4)
    frame = spark.createDataFrame([(i, t, lang, "x", 1, None, 5) for i, (t, lang) in enumerate(docs)], SCHEMA)
    assert rows(collocations.collocations(frame, work, 5)) == brute(docs, 5)


def test_long_text_is_cut_between_words_only(spark, work):
    rng = random.Random(5)
    text = "".join(rng.choice(["alpha", "beta", "gamma"]) + rng.choice([" ", " ", ".\n"]) for _ in range(400_000))
    assert len(text) > 2 << 20
    frame = spark.createDataFrame([(1, text, "en", "x", 1, None, 5)], SCHEMA)
    assert rows(collocations.collocations(frame, work, 100)) == brute([(text, "en")], 100)


def test_nothing_to_find(spark, work):
    frame = spark.createDataFrame([(1, "a b c", "en", "x", 1, None, 5)], SCHEMA)
    assert rows(collocations.collocations(frame, work, 2)) == []
    assert rows(collocations.collocations(frame.limit(0), work, 2)) == []
