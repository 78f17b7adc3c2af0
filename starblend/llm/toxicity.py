"""Toxicity scores by compression distance.

Two zstandard dictionaries of equal size share what the trainer finds common in ordinary text.  Behind it stands, in
the toxic one, what is common in toxic text and all but absent elsewhere, and in the ordinary one the same number of bytes
of ordinary text.  A text is cut at white space into windows of about ``WINDOW`` bytes; each is compressed with
both, and the window's distance is what the toxic dictionary saves, summed over two settings of the compressor, as a
setting's chance savings seldom recur in the other.  The counts of windows beyond each of a few
thresholds, and the greatest distance, become a probability by a logistic fit on rows that trained no dictionary.

Defined cases: a null or empty text has no window and scores as a clean text without any.  Null ids are scored and are
not held out.  Where one class has no labelled rows, every score is the share of label 1.  Repeated rows
get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame

from starblend.llm.learn import class_weights, labelled_sample, logistic, sigmoid
from starblend.llm.nbsvm import scored
from starblend.llm.shingles import shingle_sets

#: Rows learned from, by label: half train the dictionaries, half calibrate.
SAMPLE = {0: 5000, 1: 2000}
WINDOW = 48
SHARED_BYTES = 16 << 10
COMMON_BYTES = 16 << 10
OWN_BYTES = 4 << 10
#: Windows of ordinary text, drawn over all sampled texts, that the shared part is trained on.
TRAIN_WINDOWS = 60_000
#: Toxic texts that a word start must stand in to be taken for more than chance.
LEAST_TEXTS = 5
LONGEST_START = 14
THRESHOLDS = (2, 4, 6, 8, 10, 12)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text, A-Z lower-cased, cut at the first white space after every ``size`` bytes."""
    text, out, at = text.lower(), [], 0
    while at < len(text):
        stop = _SPACE.search(text, min(len(text), at + size))
        end = stop.end() if stop else len(text)
        out.append(b" " + text[at:end])
        at = end
    return out


def one_of_each(texts: list[bytes]) -> list[bytes]:
    """Of near copies one, judged by shared least shingles, so that a copied text counts once."""
    seen: dict[int, int] = {}
    out = []
    for i, shingles in enumerate(shingle_sets(texts)):
        least = [int(s) for s in shingles[:8]]
        shared = Counter(seen[s] for s in least if s in seen)
        for s in least:
            seen.setdefault(s, i)
        if not shared or shared.most_common(1)[0][1] < 3:
            out.append(texts[i])
    return out


class WordStarts:
    """In how many texts each word start of 5 to ``LONGEST_START`` bytes stands, the space before and after a word included.

    The distinct words are sorted, so the words of a start are a run.  A start is held as its size, the first word of its run and
    its count, in numpy arrays: as strings the starts would take many times the memory of the texts.  They are in string order.
    """

    def __init__(self, texts: list[bytes]):
        numbers: dict[bytes, int] = {}
        of_text = []
        for text in texts:
            words = {(b" " + w + b" ")[:LONGEST_START] for w in text.lower().split() if len(w) >= 3}
            of_text.append(np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32))
        self.words = sorted(numbers)
        place = np.empty(len(numbers), np.int32)
        place[[numbers[w] for w in self.words]] = np.arange(len(numbers), dtype=np.int32)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(w) for w in of_text])
        word = place[np.concatenate(of_text)] if of_text else np.empty(0, np.int32)
        del numbers, of_text
        letters = np.array([b"", *self.words], f"S{LONGEST_START}").view(np.uint8).reshape(-1, LONGEST_START)
        same = np.logical_and.accumulate(letters[1:] == letters[:-1], axis=1).sum(axis=1)  # bytes shared with the word before
        length = np.array([len(w) for w in self.words], np.int32)
        parts = []
        for size in range(5, LONGEST_START + 1):
            first = np.maximum.accumulate(np.where((length >= size) & (same < size), np.arange(len(length)), 0))
            whole = length[word] >= size
            seen = np.unique(first[word[whole]] * len(texts) + owner[whole])
            found, count = np.unique(seen // max(1, len(texts)), return_counts=True)
            parts.append((found, np.full(len(found), size), count))
        first, size, count = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((size, first))
        self.first, self.size, self.count = first[order], size[order], count[order]

    def strings(self, rows: np.ndarray) -> list[bytes]:
        return [self.words[i][:k] for i, k in zip(self.first[rows].tolist(), self.size[rows].tolist(), strict=True)]

    def texts_with(self, start: bytes) -> int:
        i = bisect_left(self.words, start)
        lo, hi = np.searchsorted(self.first, [i, i + 1])
        at = lo + np.searchsorted(self.size[lo:hi], len(start))
        return int(self.count[at]) if at < hi and self.words[i].startswith(start) and self.size[at] == len(start) else 0


def own_segments(toxic: list[bytes], ordinary: int, there: WordStarts, times: float = 40.0) -> list[bytes]:
    """Word starts that toxic texts share and ordinary texts hardly have, each as long as most of its texts agree.

    ``there`` has the word starts of as many ``ordinary`` texts.
    Those of the most toxic texts come first, and are taken until ``OWN_BYTES`` are full.
    """
    starts = WordStarts(toxic)
    common = np.flatnonzero(starts.count >= LEAST_TEXTS)
    here = dict(zip(starts.strings(common), starts.count[common].tolist(), strict=True))
    share = len(toxic) / max(1, ordinary)
    kept = {s for s, n in here.items() if times * share * there.texts_with(s) <= n}
    longer = defaultdict(list)
    for s in kept:
        longer[s[:-1]].append(s)
    out, room = [], OWN_BYTES
    for s in sorted((s for s in kept if s[:-1] not in kept), key=lambda s: (-here[s], s)):
        while following := [x for x in sorted(longer[s]) if here[x] >= 0.6 * here[s]]:
            s = max(following, key=lambda x: here[x])
        if len(s) <= room:
            out.append(s)
            room -= len(s)
    return out


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary."""
    toxic, ordinary = one_of_each(toxic), one_of_each(ordinary)
    samples = heapq.nsmallest(TRAIN_WINDOWS, (w for t in ordinary for w in windows(t, 256)), key=xxhash.xxh64_intdigest)
    try:
        shared = zs.train_dictionary(SHARED_BYTES, samples).as_bytes()
    except zs.ZstdError:  # too little text to train on
        shared = b"".join(samples)[:SHARED_BYTES]
    del samples
    starts = WordStarts(ordinary)
    common, room = [], COMMON_BYTES
    most = COMMON_BYTES // 6 + 1  # more of 6 bytes and longer do not fit
    rows = np.flatnonzero(starts.size >= 6)
    for s in starts.strings(rows[np.argsort(-starts.count[rows] * starts.size[rows], kind="stable")[:most]]):
        if room < len(s):
            break
        common.append(s)
        room -= len(s)
    own = b"".join(reversed(own_segments(toxic, len(ordinary), starts)))
    rare = np.flatnonzero((starts.count == 1) & (starts.size > 6))
    other = b"".join(starts.strings(rare[:: max(1, len(rare) // max(1, len(own) // 6))]))
    base = shared + b"".join(reversed(common))
    return base + own, base + other[: len(own)].ljust(len(own))


class Model:
    """Both dictionaries and the logistic curve over a text's window distances."""

    def __init__(self, toxic: bytes, ordinary: bytes, curve: np.ndarray | None = None, prior: float | None = None):
        self.toxic, self.ordinary, self.curve, self.prior = toxic, ordinary, curve, prior
        self._made = None

    def __getstate__(self):
        return {**self.__dict__, "_made": None}

    def _compressors(self):
        if self._made is None:
            self._made = []
            for least in (5, 6):
                parameters = zs.ZstdCompressionParameters(
                    window_log=17, hash_log=17, chain_log=17, search_log=4, min_match=least, strategy=zs.STRATEGY_LAZY2,
                    target_length=32, write_checksum=False, write_content_size=False, write_dict_id=False,
                )
                for content in (self.toxic, self.ordinary):
                    dictionary = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
                    self._made.append(zs.ZstdCompressor(compression_params=parameters, dict_data=dictionary).compress)
        return self._made

    def distances(self, text: bytes) -> np.ndarray:
        """For each window the bytes that the toxic dictionary saves; 0 where it saves none at the first setting."""
        toxic, ordinary, toxic2, ordinary2 = self._compressors()
        out = []
        for w in windows(text):
            saved = len(ordinary(w)) - len(toxic(w))
            out.append(saved + len(ordinary2(w)) - len(toxic2(w)) if saved > 0 else 0)
        return np.array(out, dtype=np.int64)

    def features(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), len(THRESHOLDS) + 2))
        for row, text in zip(out, texts, strict=True):
            d = self.distances(text)
            if len(d):
                row[0] = min(16, max(0, d.max()))
                row[1 : 1 + len(THRESHOLDS)] = [min(3.0, np.log1p((d >= t).sum())) for t in THRESHOLDS]
            row[-1] = np.log1p(len(d))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.prior)
        return sigmoid(self.features(texts) @ self.curve[:-1] + self.curve[-1])


def fit(texts: dict[int, list[bytes]], counts: dict[int, int]) -> Model:
    if not texts[0] or not texts[1]:
        return Model(b"", b"", None, (counts[1] + 1) / (sum(counts.values()) + 2))
    used = {c: (len(texts[c]) + 1) // 2 for c in (0, 1)}
    model = Model(*dictionaries(texts[1][: used[1]], texts[0][: used[0]]))
    rest = {c: texts[c][used[c] :] or texts[c] for c in (0, 1)}
    x = model.features(rest[0] + rest[1])
    y = np.r_[np.zeros(len(rest[0])), np.ones(len(rest[1]))]
    model.curve = logistic(x, y, class_weights(y, counts))
    return model


def toxicity_model(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    return fit(*labelled_sample(docs, labels, label, SAMPLE))


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score`` of every row of ``docs`` (``doc_id, text``)."""
    return scored(docs, toxicity_model(docs, labels, label).scores)
