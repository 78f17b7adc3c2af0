"""Token ids of whole texts, with a bounded cache of the parts of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from starblend.llm.common import _LOWER, _SPACE, STEP_BYTES, _cut, span_hashes, steps, word_spans

CACHE_WORDS = 600_000
#: Parts that a worker keeps when a task ends; beyond that it forgets all, as other operators need the memory.
IDLE_WORDS = 100_000
END = b"\n"  # not a part, so free to stand for the end of a text
OTHER = b" "  # stands before a word that is kept whole

# Classes of bytes: white space, a-z, ASCII punctuation, and all others.
_GAP, _LETTER, _MARK, _ELSE = range(4)
_CLASS = np.full(256, _ELSE, np.uint8)
_CLASS[_SPACE] = _GAP
_CLASS[0x61:0x7B] = _LETTER
for _a, _b in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
    _CLASS[_a : _b + 1] = _MARK
_LATIN = 0xC3  # the first byte of the letters from U+00C0 to U+00FF, but for two signs among them

_PROBES = ["the", "Word.", "\u00c9t\u00e9", "stra\u00dfe!!", "%%%", "x'y", "don't", "a-b", "'s", "no?!", "\u00f1and\u00fa,"]


def units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a text's units, which of them are whole words, and the bytes to look them up by.

    A word of Latin letters with punctuation behind it is two units in lower case, which the tokenizer splits at too and
    leaves as they are.  Any other word is one unit as it stands.
    """
    low = _LOWER[raw]
    kind = _CLASS[low]
    lead = np.flatnonzero(low[:-1] == _LATIN)
    if len(lead):
        after = low[lead + 1]
        upper = (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
        low[lead[upper] + 1] += 0x20
        letter = lead[(low[lead + 1] >= 0x9F) & (low[lead + 1] <= 0xBF) & (low[lead + 1] != 0xB7)]
        kind[letter] = kind[letter + 1] = _LETTER
    odd = kind == _ELSE
    odd[1:] |= (kind[1:] == _LETTER) & (kind[:-1] == _MARK)
    odd = np.flatnonzero(odd)
    if len(odd):
        solid = np.concatenate([[False], kind > _GAP, [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        start, end = edge[0::2], edge[1::2]
        word = np.searchsorted(start, odd, side="right") - 1
        word = word[np.r_[True, word[1:] != word[:-1]]]
        size = end[word] - start[word]
        at = np.repeat(start[word] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        kind[at], low[at] = _ELSE, raw[at]
    edge = np.concatenate([[_GAP], kind, [_GAP]])
    turn = np.flatnonzero(edge[1:] != edge[:-1])
    start, end = turn[:-1], turn[1:]
    full = kind[start] > _GAP
    start, end = start[full], end[full]
    return start, end, kind[start] == _ELSE, low


class _Words(dict):
    """Numbers units in the order they come up and remembers the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of texts for a tokenizer whose words never reach across ASCII white space.

    The units of a step are told apart by 64-bit hashes (two of one step are taken for one with a chance of about 1e-9), and each
    different one is looked up by its bytes.  The tokenizer sees it once, and its ids are kept, for at most ``CACHE_WORDS`` units
    and those of one step.  When there are more, those that came up once since the last time are forgotten.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end_id = end_id
        self.plain = True
        self._reset()
        told = [i.tolist() for i in self.encode([" ".join(_PROBES).encode()])][0][:-1]
        self.plain = told == self._whole(_PROBES)[0].tolist()
        self._reset()

    def _reset(self) -> None:
        self.words = _Words()
        self.words[END] = 0
        self.start, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.flat = np.array([self.end_id], np.uint32)
        self.seen = np.zeros(1, np.int64)

    def rest(self) -> None:
        """To be called when a task of a longer job has no more texts."""
        if len(self.words) > IDLE_WORDS:
            self._reset()

    def _forget(self) -> None:
        kept = np.flatnonzero(np.r_[True, self.seen[1:] > 1])
        if len(kept) > 0.7 * CACHE_WORDS:
            self._reset()
            return
        words, start, size, flat = list(self.words), self.start[kept], self.size[kept], self.flat
        self.words = _Words()
        self.words.update({words[k]: i for i, k in enumerate(kept.tolist())})
        self.size, self.start = size, np.cumsum(size) - size
        self.flat = flat[np.repeat(start - self.start, size) + np.arange(int(size.sum()))]
        self.seen = np.zeros(len(kept), np.int64)

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        out = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        size = np.bincount(np.array(out.word_ids, dtype=np.int64), minlength=len(words))
        return np.array(out.ids, dtype=np.uint32), size

    def _parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of plain words, past the normalizer; an id that ends a word ends its part."""
        told = self.bare.encode_batch_fast([b" ".join(parts).decode("utf-8")], add_special_tokens=False)
        ids = np.array(told[0].ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[ids])
        return ids, np.diff(np.r_[-1, last])

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        if not new:
            return
        whole = np.array([w[:1] == OTHER for w in new])
        size = np.zeros(len(new), np.int64)
        ids = [np.empty(0, np.uint32)] * 2
        if not whole.all():
            ids[0], size[~whole] = self._parts([w for w in new if w[:1] != OTHER])
        if whole.any():
            ids[1], size[whole] = self._whole([w[1:].decode("utf-8", "replace") for w in new if w[:1] == OTHER])
        start = np.zeros(len(new), np.int64)
        start[~whole] = np.cumsum(size[~whole]) - size[~whole]
        start[whole] = len(ids[0]) + np.cumsum(size[whole]) - size[whole]
        self.start = np.r_[self.start, len(self.flat) + start]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, *ids]

    def _numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the units of all texts, each text with its end behind, and where in them each text ends."""
        if len(self.words) > CACHE_WORDS:
            self._forget()
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        start, end, whole, low = units(raw)
        if not self.plain:
            start, end, low = *word_spans(raw), raw
            whole = np.ones(len(start), bool)
        _, first, back = np.unique(span_hashes(low, start, end), return_index=True, return_inverse=True)
        spelled = low.tobytes()
        keys = [
            OTHER + spelled[a:b] if w else spelled[a:b]
            for a, b, w in zip(start[first].tolist(), end[first].tolist(), whole[first].tolist(), strict=True)
        ]
        number = np.fromiter(map(self.words.__getitem__, keys), np.int64, len(keys))[back]
        self._learn()
        stops = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
        number = np.insert(number, stops, 0)
        seen = np.bincount(number, minlength=len(self.size))
        seen[: len(self.seen)] += self.seen
        self.seen = seen
        return number, stops + np.arange(1, len(texts) + 1)

    def _ids(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        number, stops = self._numbers(texts)
        size = self.size[number]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[number] - ends + size, size) + np.arange(ends[-1])]
        bounds = np.r_[0, ends[stops - 1]].tolist()
        return (ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """For each text its ids and the end id, as uint32."""
        for lo, hi in steps(texts):
            if hi - lo == 1 and len(texts[lo]) > 2 * STEP_BYTES:
                parts = [next(self._ids([part])) for part in _cut(texts[lo])]
                yield np.concatenate([*(p[:-1] for p in parts[:-1]), parts[-1]])
            else:
                yield from self._ids(texts[lo:hi])

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """How many ids each text has, the end id included."""
        out = [np.empty(0, np.int64)]
        for lo, hi in steps(texts):
            if hi - lo == 1 and len(texts[lo]) > 2 * STEP_BYTES:
                out.append([sum(int(self.size[self._numbers([part])[0]].sum()) - 1 for part in _cut(texts[lo])) + 1])
            else:
                number, stops = self._numbers(texts[lo:hi])
                out.append(np.diff(np.r_[0, np.cumsum(self.size[number])[stops - 1]]))
        return np.concatenate(out).astype(np.int64)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The process's encoder, so that tasks of one worker share its words."""
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]
