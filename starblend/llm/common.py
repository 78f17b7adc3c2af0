"""What the training-data operators share: tables, folds, words and their hashes."""

from __future__ import annotations

import atexit
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starblend.workspace import Workspace

#: Bytes of text that one vectorised step takes at once.
STEP_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_LETTERS = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    """Tables of a query whose result is read later; they go when the driver ends."""
    work = Workspace(spark)

    def close() -> None:
        if spark.sparkContext._jsc is not None:
            work.close()

    atexit.register(close)
    return work


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def strings(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together take about ``limit`` bytes; one long text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[int, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(STEP_BYTES + (1 << 16), n)
    if size > STEP_BYTES + (1 << 16):
        return _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    if not _POWERS:
        _POWERS[0], _POWERS[1] = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    return _POWERS[0], _POWERS[1]


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``[^\\x20\\x09-\\x0D]``."""
    solid = np.concatenate([[False], ~_SPACE[text], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    return edge[0::2], edge[1::2]


def span_hashes(joined: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from ``start`` to ``end`` of each span."""
    ups, downs = _power_table(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[joined] * ups[: len(joined)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * downs[start] + (end - start).astype(np.uint64))


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in order, and each text's first word (one more at the end)."""
    joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    if lower:
        joined = _LOWER[joined]
    start, end = word_spans(joined)
    hashes = span_hashes(joined, start, end)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.searchsorted(start, begins)


def text_word_hashes(texts: list[bytes], lower: bool = True) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order; a long text is cut at white space so that memory stays bounded."""
    for lo, hi in steps(texts):
        if hi - lo == 1 and len(texts[lo]) > 2 * STEP_BYTES:
            yield np.concatenate([word_hashes([p], lower)[0] for p in _cut(texts[lo])])
            continue
        hashes, first = word_hashes(texts[lo:hi], lower)
        for i in range(hi - lo):
            yield hashes[first[i] : first[i + 1]]


def _cut(text: bytes) -> Iterator[bytes]:
    start = 0
    while start < len(text):
        stop = min(len(text), start + STEP_BYTES)
        while stop < len(text) and not _SPACE[text[stop]]:
            stop += 1
        yield text[start:stop]
        start = stop


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n``-word windows; the whole as one where there are fewer words, none where there is none."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = _mix(out * np.uint64(_BASE) + hashes[i : i + len(out)])
    return out
