"""Byte-level BPE: exact encoding by contiguous rank arrays, and decoding.

A text is cut into pieces by the vocabulary's pattern.  A piece starts as its bytes: one array holds the ids of its parts,
whose ends are the boundaries, and beside it an array holds the rank of every two adjacent parts.  The leftmost least rank
is found by scanning, the boundary there is deleted, and the ranks of the two neighbours are looked up anew, until no two
adjacent parts merge.  Pieces of equal length lie in one matrix: each merge takes one boundary from every row, so the
arrays stay contiguous and one step serves them all.  A piece longer than ``SHORT`` bytes would be scanned too often; its
pairs wait in a heap and its parts are linked, which merges in the same order.

A worker keeps the ids of at most ``CACHE_PIECES`` pieces and those of one step, and forgets all when there are more.  A
long text is cut before white space that follows something else, where a piece always ends.

The strings of special tokens inside a text become their ids, as the tokenizers library does by default.

Defined cases: a null or empty text has no ids and decodes to the empty text.  Null ids of documents stay null, repeated rows
stay, an empty table gives no rows; other columns are not read.  Ids that the vocabulary lacks decode to nothing, bytes
that are not UTF-8 to the replacement character.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starblend.llm.common import STEP_BYTES, steps, strings

SHORT = 48
CACHE_PIECES = 600_000
#: Rank of two parts that do not merge.
NEVER = 1 << 30

# Fixed value: the pattern that byte-level vocabularies of this kind are split by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = regex.compile(PATTERN)
_BORDER = regex.compile(r"(?<=\S)\s")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, the others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Merges and bytes of a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        ids, merges = told["model"]["vocab"], told["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = 1 + max([*ids.values(), *self.special.values()])
        spelled = [b""] * size
        for token, i in ids.items():
            spelled[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.first = np.array([ids[letter] for letter in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = np.r_[keys[order], np.int64(2**62)], np.r_[order, NEVER].astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs] or [0], np.int64)
        self.pair_rank = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        found = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.specials = regex.compile(f"({found})") if found else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair, ``NEVER`` where it does not merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def merge_rows(self, parts: np.ndarray) -> list[np.ndarray]:
        """Ids of pieces of one length, a row of part ids each; every round deletes one boundary of every open row."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(parts)
        rows = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if parts.shape[1] == 1:
                done = np.ones(len(rows), bool)
            else:
                at = ranks.argmin(1)
                least = ranks[np.arange(len(rows)), at]
                done = least == NEVER
            for row, ids in zip(rows[done].tolist(), parts[done], strict=True):
                out[row] = ids
            if done.any():
                if done.all():
                    break
                rows, parts, ranks, at, least = rows[~done], parts[~done], ranks[~done], at[~done], least[~done]
            n, width = parts.shape
            each = np.arange(n)
            parts[each, at] = self.merged[least]
            stays = np.ones((n, width), bool)
            stays[each, at + 1] = False
            parts = parts[stays].reshape(n, width - 1)
            gone = np.ones((n, width - 1), bool)
            gone[each, at] = False
            ranks = ranks[gone].reshape(n, width - 2)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            ranks[left, at[left] - 1] = self.rank(parts[left, at[left] - 1], parts[left, at[left]])
            ranks[right, at[right]] = self.rank(parts[right, at[right]], parts[right, at[right] + 1])
        return out

    def merge_long(self, parts: list[int]) -> np.ndarray:
        """The same merges for a long piece, its pairs in a heap and its parts linked."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.pair_rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        merged = self.merged.tolist()
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= n or rank(parts[i] << 32 | parts[j]) != r:
                continue
            parts[i], parts[j] = merged[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank(parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([p for p in parts if p >= 0], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(pieces)
        size = np.array([len(p) for p in pieces], np.int64)
        for length in np.unique(size).tolist():
            rows = np.flatnonzero(size == length).tolist()
            if length > SHORT:
                for row in rows:
                    out[row] = self.merge_long(self.first[np.frombuffer(pieces[row], np.uint8)].tolist())
            elif length:
                letters = np.frombuffer(b"".join(pieces[row] for row in rows), np.uint8).reshape(-1, length)
                for row, ids in zip(rows, self.merge_rows(self.first[letters]), strict=True):
                    out[row] = ids
        return out

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.length))]
        size = self.length[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - ends + size, size) + np.arange(int(size.sum()))
        return self.bytes[at].tobytes().decode("utf-8", "replace")


class _Numbers(dict):
    """Numbers pieces in the order they come up and remembers the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


#: A character of each class of the pattern: letter, number, neither; what goes with none of them is white space.
_CLASSES = ("\u00e9", "\u0663", "\u2020")
_WHITE = "\u2003"


def _class(character: str, pieces) -> str:
    """The stand-in of the class that ``pieces``, a way to cut a text, sees in a character."""
    return next((c for c in _CLASSES if len(pieces(c + character)) == 1), _WHITE)


class Codec:
    """Encodes whole texts, keeping the ids of pieces.

    The classes of characters are those of the tokenizers library: where its Unicode version knows a character as another
    class than the pattern's does, a stand-in of the right class is matched in its place.
    """

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.vocabulary = Vocabulary(path)
        self.library = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.classed = set(map(chr, range(128)))
        self.odd: dict[int, str] = {}
        self._reset()

    def _matched(self, text: str) -> str:
        """The text with stand-ins for its odd characters."""
        if text.isascii():
            return text
        new = set(text) - self.classed
        self.classed |= new
        for c in new:
            told = _class(c, self.library)
            if told != _class(c, _PIECES.findall):
                self.odd[ord(c)] = told
        return text.translate(self.odd) if self.odd else text

    def _reset(self) -> None:
        self.numbers = _Numbers()
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def _cut(self, encoded: bytes) -> Iterator[list[str]]:
        """The pieces of a text, those of about ``STEP_BYTES`` characters at a time."""
        text = encoded.decode("utf-8", "replace")
        specials, known = self.vocabulary.specials, self.vocabulary.special
        for part in specials.split(text) if specials and any(s in text for s in known) else (text,):
            if part in known:
                yield [part]
                continue
            at, matched = 0, self._matched(part)
            while at < len(part):
                border = _BORDER.search(matched, at + STEP_BYTES) if len(part) - at > STEP_BYTES else None
                stop = border.start() if border else len(part)
                pieces = _PIECES.findall(matched, at, stop)
                if matched is not part and matched != part:
                    ends = list(accumulate(map(len, pieces), initial=at))
                    pieces = [part[a:b] for a, b in pairwise(ends)]
                yield pieces
                at = stop

    def _learn(self) -> None:
        new, self.numbers.new = self.numbers.new, []
        if not new:
            return
        found = self.vocabulary.encode_pieces([p.encode() for p in new])
        for i, piece in enumerate(new):
            if piece in self.vocabulary.special:
                found[i] = np.array([self.vocabulary.special[piece]])
        size = np.array([len(ids) for ids in found], np.int64)
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(size) - size]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, np.concatenate(found).astype(np.int32)]

    def _ids(self, rows: list[list[str]]) -> Iterator[np.ndarray]:
        """The ids of each row of pieces."""
        if len(self.numbers) > CACHE_PIECES:
            self._reset()
        counts = [len(row) for row in rows]
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(rows)), np.int64, sum(counts))
        self._learn()
        size = self.size[number]
        ends = np.r_[0, np.cumsum(size)]
        ids = self.flat[np.repeat(self.start[number] - ends[:-1], size) + np.arange(ends[-1])]
        bounds = ends[np.r_[0, np.cumsum(counts)]]
        return (ids[a:b] for a, b in pairwise(bounds.tolist()))

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, as int32."""
        for lo, hi in steps(texts):
            if hi - lo == 1 and len(texts[lo]) > STEP_BYTES:
                parts = [ids for pieces in self._cut(texts[lo]) for ids in self._ids([pieces])]
                yield np.concatenate(parts)
            else:
                yield from self._ids([[p for pieces in self._cut(text) for p in pieces] for text in texts[lo:hi]])


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The process's codec, so that tasks of one worker share its pieces."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs`` (``doc_id, text``)."""

    def run(batches):
        of = codec(path)
        for batch in batches:
            texts = strings(batch.column("text"))
            for lo, hi in steps(texts):
                ids = list(of.encode(texts[lo:hi]))
                bounds = np.cumsum([0, *map(len, ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))],
                    names=["doc_id", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of every row of ``encoded`` (``doc_id, ids``); null ids are the empty text."""

    def run(batches):
        vocabulary = codec(path).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(np.array(row.values, np.int64) if row.is_valid else np.empty(0, np.int64)) for row in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
