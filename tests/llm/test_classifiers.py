"""Held-out accuracy of the quality and toxicity scores, and their defined cases."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from starblend.llm import nbsvm, toxicity
from starblend.llm.learn import logistic, sigmoid
from tests.llm import brute

FOLDER = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, score string, held_out int"


@pytest.mark.parametrize(
    ("score", "label", "threshold", "least"), [(nbsvm.quality, "quality", 0.3, 0.99), (toxicity.toxicity, "toxic", 0.5, 0.95)]
)
def test_held_out_accuracy(spark, score, label, threshold, least):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).join(labels, "doc_id").select("doc_id", "held_out", "score", label).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    right = np.mean([(r.score >= threshold) == (r[label] == 1) for r in held])
    assert right >= least
    clean = [r for r in held if r[label] == (1 if label == "quality" else 0)]
    assert np.mean([(r.score >= threshold) == (label == "quality") for r in clean]) >= 0.98


@pytest.mark.parametrize("score", [nbsvm.quality, toxicity.toxicity])
def test_defined_cases(spark, score):
    label = "quality" if score is nbsvm.quality else "toxic"
    docs = spark.createDataFrame([(1, "a b c", "x", 1), (1, "a b c", "x", 1), (2, None, None, None), (3, "", "", 0), (None, "w " * 30000, "", 0)], SCHEMA)
    for rows in ([], [(1, 1)], [(1, 1), (2, 0), (None, 1), (3, None), (2, 1)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
        found = score(docs, labels).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id == 1}) == 1
        assert not next(r for r in found if r.doc_id is None).held_out
    assert score(docs.limit(0), labels).collect() == []


def test_learning_never_sees_the_held_out_fold(spark):
    """Labels of the fold turned around change no score."""
    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SMALL}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    one, two = ({r.doc_id: r.score for r in nbsvm.quality(docs, x).collect()} for x in (labels, turned))
    assert one == two


def _keep(texts):
    return np.array([float(t != b"drop") for t in texts])


def test_selected_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "keep", "s", 5), (2, "drop", "t", None), (None, None, None, None)], SCHEMA)
    kept = nbsvm.selected(docs, _keep, lambda s: s > 0.5)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, "keep", "s", 5), (None, None, None, None)], key=repr)


def test_dual_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(np.r_[rng.integers(0, 20, 5) + 20 * (i % 2), rng.integers(40, 60, 5)]) for i in range(200)]
    y = np.arange(200) % 2
    w = nbsvm.dual_descent(rows, np.ones(60), y, np.ones(200))
    margins = np.array([w[r].sum() / np.sqrt(len(r)) + w[-1] for r in rows])
    assert ((margins > 0) == (y == 1)).all()


def test_indicators_do_not_depend_on_neighbours():
    texts = [b"One two!! two two", b"", b"12 | | x", b"a " * 300]
    together = list(nbsvm.indicators(texts))
    assert all(np.array_equal(a, next(nbsvm.indicators([t]))) for a, t in zip(together, texts))


def test_windows_cover_the_text():
    text = ("word " * 100 + "x" * 200 + "\n tail").encode()
    assert b"".join(w[1:] for w in toxicity.windows(text)) == text


def test_logistic_recovers_a_curve():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < sigmoid(x @ [2.0, -1.0] + 0.5)).astype(float)
    assert np.allclose(logistic(x, y, np.ones(4000), 1e-6), [2.0, -1.0, 0.5], atol=0.2)


def _made_texts(n, words, seed):
    rng = np.random.default_rng(seed)
    letters = rng.integers(97, 123, (n, words, 9), dtype=np.uint8)
    return [b" ".join(bytes(w[: 1 + i % 9]) for i, w in enumerate(text)) for text in letters]


def test_word_starts_count_texts():
    texts = [b"", b"ab abc abcd", b"Abcd\x00x abcdefghijklmnopqrst abcd", b"abc\x00 xyz\nabc", *_made_texts(20, 60, 1)]
    counts = Counter()
    for text in texts:
        counts.update({w[:k] for w in (b" " + w + b" " for w in text.lower().split()) for k in range(5, min(len(w), 14) + 1)})
    starts = toxicity.WordStarts(texts)
    found = starts.strings(np.arange(len(starts.count)))
    assert found == sorted(counts) and starts.count.tolist() == [counts[s] for s in found]
    asked = [*found, b" ab", b" nowhere", b"zzzzz", b" abcdx"]
    assert [starts.texts_with(s) for s in asked] == [counts[s] for s in asked]
    assert toxicity.WordStarts([]).texts_with(b" abcd") == 0


def test_fits_take_little_memory_of_the_driver():
    """The word starts of a text and the arrays of a fit are small multiples of the sampled bytes."""
    texts = {c: _made_texts(500, 600, c) for c in (0, 1)}
    tracemalloc.start()
    nbsvm.fit(texts, {0: 500, 1: 500})
    _, quality = tracemalloc.get_traced_memory()
    tracemalloc.reset_peak()
    toxicity.dictionaries(texts[1], texts[0])
    _, toxic = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    size = sum(map(len, texts[0] + texts[1]))
    assert quality < 15 * size and toxic < 45 * size  # 20 and 52 times with whole steps and starts held as strings
