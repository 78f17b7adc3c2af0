"""Quality scores by naive Bayes support vectors.

A text is the set of its n-gram indicators: words, the ends of words, and runs of one to three word shapes (case,
punctuation, digits, length, whether the word repeats the one before), each shape run also with the power of two that
its count reaches.  Indicators are hashed to ``2 ** BITS`` places.  Each is scaled by the log-count ratio of the
classes, the vector by its length, and a linear hinge-loss model is fitted by dual coordinate descent.  Its weights
are pulled towards their mean magnitude, and the margin becomes a probability by a logistic fit on other rows.

Defined cases: a null or empty text has no indicator and gets the score of the constant alone.  Null ids are scored
and are not held out.  Where one class has no labelled rows, every score is the share of label 1.  Repeated rows get
equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starblend.llm.common import STEP_BYTES, _mix, held_out, runs, steps, strings, word_hashes, word_spans
from starblend.llm.learn import class_weights, labelled_sample, logistic, sigmoid

BITS = 18
#: Rows learned from: fitting and calibration, by label.
SAMPLE = {0: 3000, 1: 5000}
FIT_SHARE = 0.75
#: Bytes of text that the fit, which runs on the driver, works on at once: its arrays are some 60 times that.
FIT_STEP_BYTES = 1 << 17

_KIND = np.zeros(256, np.uint8)  # 0 letter, 1 upper case, 2 digit, 3 punctuation
_KIND[65:91], _KIND[48:58] = 1, 2
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3


def _shapes(joined: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each word: what it looks like, whatever its letters."""
    kind = _KIND[joined]
    tally = [np.r_[0, np.cumsum(kind == k)] for k in (1, 2, 3)]
    upper, digit, mark = (t[end] - t[start] for t in tally)
    size = end - start
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[first[first < len(words)]] = False
    last = np.where(kind[end - 1] == 3, joined[end - 1], 0).astype(np.uint64)
    before = np.where((size > 1) & (kind[np.maximum(end - 2, 0)] == 3), joined[np.maximum(end - 2, 0)], 0).astype(np.uint64)

    def level(part):
        return np.where(part == 0, 0, np.where(2 * part < size, 1, np.where(part < size, 2, 3))).astype(np.uint64)

    code = level(upper) | level(digit) << np.uint64(2) | level(mark) << np.uint64(4)
    code |= np.minimum(size // 6, 3).astype(np.uint64) << np.uint64(6) | same.astype(np.uint64) << np.uint64(8)
    return _mix(code | last << np.uint64(16) | before << np.uint64(24) | np.uint64(1 << 40))


def _place(hashes: np.ndarray, kind: int) -> np.ndarray:
    return _mix(hashes + np.uint64(kind * 0x632BE59BD9B4E019 % 2**64)) >> np.uint64(64 - BITS)


def indicators(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[np.ndarray]:
    """The sorted indicator places of each text; ``limit`` bytes of text are worked on at once."""
    for lo, hi in steps(texts, limit):
        part = texts[lo:hi]
        joined = np.frombuffer(b"\n".join(part), np.uint8)
        words, first = word_hashes(part)
        if not len(words):
            yield from (np.empty(0, np.int64) for _ in part)
            continue
        start, end = word_spans(joined)
        owner = np.repeat(np.arange(hi - lo), np.diff(first)).astype(np.uint64)
        tail = sum(joined[np.maximum(end - 1 - i, start)].astype(np.uint64) << np.uint64(8 * i) for i in range(3))
        shapes = _shapes(joined, start, end, words, first)
        plain = [owner << np.uint64(BITS) | _place(words, 1), owner << np.uint64(BITS) | _place(tail, 2)]
        counted = []
        for n in (1, 2, 3):
            if len(shapes) >= n:
                inside = owner[: len(shapes) - n + 1] == owner[n - 1 :]
                counted.append((owner[: len(inside)] << np.uint64(BITS) | _place(runs(shapes, n), 2 + n))[inside])
        seen, times = np.unique(np.concatenate(counted), return_counts=True)
        plain.append(seen)
        power = 1
        while (often := times >= 2 << (power - 1)).any():
            plain.append((seen[often] >> np.uint64(BITS)) << np.uint64(BITS) | _place(seen[often] & np.uint64((1 << BITS) - 1), 10 + power))
            power += 1
        keys = np.unique(np.concatenate(plain))
        bounds = np.searchsorted(keys, np.arange(hi - lo + 1, dtype=np.uint64) << np.uint64(BITS))
        places = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
        for i in range(hi - lo):
            yield places[bounds[i] : bounds[i + 1]]


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Linear hinge-loss weights for rows of scaled indicators; the last weight is the constant."""
    w = np.zeros(len(scale) + 1)
    alpha, sign = np.zeros(len(rows)), np.where(y == 1, 1.0, -1.0)
    norm = [np.linalg.norm(scale[r]) or 1.0 for r in rows]
    square = np.array([(v := scale[r] / n) @ v + 1.0 for r, n in zip(rows, norm, strict=True)])
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            value = scale[rows[i]] / norm[i]
            gradient = sign[i] * (w[rows[i]] @ value + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * sign[i] * value
                w[-1] += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


class Model:
    """Scaled weights, log-count ratios, and the logistic curve over the margin."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, curve: np.ndarray):
        self.ratio, self.weights, self.curve = ratio, weights, curve

    def margins(self, texts: list[bytes], limit: int = STEP_BYTES) -> np.ndarray:
        out = [
            self.weights[r] @ self.ratio[r] / (np.linalg.norm(self.ratio[r]) or 1.0) + self.weights[-1] for r in indicators(texts, limit)
        ]
        return np.array(out, dtype=float)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.curve[0] * self.margins(texts) + self.curve[1])


def fit(texts: dict[int, list[bytes]], counts: dict[int, int], pull: float = 0.25, smooth: float = 1.0) -> Model:
    total = sum(counts.values())
    prior = (counts[1] + 1) / (total + 2)
    flat = Model(np.zeros(1 << BITS), np.zeros((1 << BITS) + 1), np.array([0.0, np.log(prior / (1 - prior))]))
    if not texts[0] or not texts[1]:
        return flat
    used = {c: int(np.ceil(FIT_SHARE * len(texts[c]))) for c in (0, 1)}
    rows = {c: [r.astype(np.int32) for r in indicators(texts[c][: used[c]], FIT_STEP_BYTES)] for c in (0, 1)}
    logs = []
    for c in (0, 1):
        tally = np.full(1 << BITS, smooth)
        for r in rows[c]:
            tally[r] += 1  # a row names a place once
        logs.append(np.log(tally / tally.sum()))
    ratio = logs[1] - logs[0]
    y = np.r_[np.zeros(used[0]), np.ones(used[1])]
    cost = np.where(y == 1, len(y) / (2 * used[1]), len(y) / (2 * used[0]))
    w = dual_descent(rows[0] + rows[1], ratio, y, cost)
    w[:-1] = (1 - pull) * np.abs(w[:-1]).mean() + pull * w[:-1] if pull < 1 else w[:-1]
    model = Model(ratio, w, np.array([1.0, 0.0]))
    rest = {c: texts[c][used[c] :] or texts[c] for c in (0, 1)}
    margins = np.r_[model.margins(rest[0], FIT_STEP_BYTES), model.margins(rest[1], FIT_STEP_BYTES)]
    y = np.r_[np.zeros(len(rest[0])), np.ones(len(rest[1]))]
    spread = margins.std() or 1.0
    curve = logistic(margins[:, None] / spread, y, class_weights(y, counts))
    model.curve = np.array([curve[0] / spread, curve[1]])
    return model


def quality_model(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    return fit(*labelled_sample(docs, labels, label, SAMPLE))


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score`` of every row of ``docs`` (``doc_id, text``)."""
    return scored(docs, quality_model(docs, labels, label).scores)


def scored(docs: DataFrame, scores) -> DataFrame:
    """``doc_id, held_out, score`` by ``scores(texts)``; the model travels as one broadcast of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def score(batches):
        for batch in batches:
            texts = strings(batch.column("text"))
            out = [shared.value(texts[lo:hi]) for lo, hi in steps(texts, 4 * STEP_BYTES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(out) if out else np.empty(0))], names=["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score")


def selected(docs: DataFrame, scores, keep) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``scores(texts)`` satisfy ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def choose(batches):
        for batch in batches:
            texts = strings(batch.column(batch.schema.get_field_index("text")))
            for lo, hi in steps(texts, 4 * STEP_BYTES):
                yield batch.slice(lo, hi - lo).filter(pa.array(keep(shared.value(texts[lo:hi]))))

    return docs.mapInArrow(choose, docs.schema)
