"""Counting quotient filters of word-id n-grams, as NumPy arrays.

The ids of an n-gram are packed into one number of ``words * bits`` bits, held in lanes of at most 64 bits.  A Feistel network
over the lanes permutes these numbers: it spreads them evenly and can be undone, so nothing is lost.  The permuted number
is cut into a quotient, its first bits, and the remainder, all its other bits.

A filter is sorted by quotient and remainder.  It stores for each quotient how many remainders follow, in unary (about
two bits an entry), the remainders in whole bytes, and a counter byte each; greater counts stand in a list behind.  Because the
remainder is kept in full, equal entries are equal n-grams and all counts are exact.  Filters of different shards are merged by
sorting and summing, whatever number of quotient bits each of them has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ROUNDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_HEADER = 24
Lanes = list[np.ndarray]


class Shape:
    """How n-grams of ``words`` ids of ``bits`` bits are packed."""

    def __init__(self, words: int, bits: int):
        self.words, self.bits = words, bits
        self.lanes = max(2, -(-words * bits // 64))
        self.half = -(-words * bits // self.lanes)
        self.total = self.lanes * self.half
        self.mask = np.uint64((1 << self.half) - 1)

    def pack(self, ids: list[np.ndarray]) -> Lanes:
        """Lanes, most significant first, of the n-grams whose j-th ids are ``ids[j]``."""
        out = [np.zeros(len(ids[0]), np.uint64) for _ in range(self.lanes)]
        for j, column in enumerate(ids):
            lane, shift = divmod((self.words - 1 - j) * self.bits, self.half)
            column = column.astype(np.uint64)
            out[-1 - lane] |= (column << np.uint64(shift)) & self.mask
            if shift + self.bits > self.half:
                out[-2 - lane] |= column >> np.uint64(self.half - shift)
        return out

    def unpack(self, lanes: Lanes) -> list[np.ndarray]:
        out, keep = [], np.uint64((1 << self.bits) - 1)
        for j in range(self.words):
            lane, shift = divmod((self.words - 1 - j) * self.bits, self.half)
            column = lanes[-1 - lane] >> np.uint64(shift)
            if shift + self.bits > self.half:
                column = column | lanes[-2 - lane] << np.uint64(self.half - shift)
            out.append((column & keep).astype(np.int64))
        return out

    def _turn(self, others: Lanes, number: int) -> np.ndarray:
        mixed = np.full(len(others[0]), _ROUNDS[number % 4] >> np.uint64(number), np.uint64)
        for lane in others:
            mixed = (mixed + lane) * _ROUNDS[(number + 1) % 4]
            mixed ^= mixed >> np.uint64(32)
        return mixed * _ROUNDS[(number + 2) % 4] >> np.uint64(64 - self.half)

    def permute(self, lanes: Lanes) -> Lanes:
        for number in range(3 * self.lanes):
            lanes = [*lanes[1:], lanes[0] ^ self._turn(lanes[1:], number)]
        return lanes

    def restore(self, lanes: Lanes) -> Lanes:
        for number in reversed(range(3 * self.lanes)):
            lanes = [lanes[-1] ^ self._turn(lanes[:-1], number), *lanes[:-1]]
        return lanes

    def _number(self, lanes: Lanes) -> np.ndarray | None:
        """The lanes as one number, where they fit 64 bits."""
        if self.total > 64:
            return None
        out = lanes[0]
        for lane in lanes[1:]:
            out = out << np.uint64(self.half) | lane
        return out

    def head(self, lanes: Lanes, bits: int) -> np.ndarray:
        """The first ``bits`` bits, at most ``head_bits``."""
        number = self._number(lanes)
        whole, width = (lanes[0], self.half) if number is None else (number, self.total)
        return (whole >> np.uint64(width - bits)).astype(np.int64) if bits else np.zeros(len(whole), np.int64)

    @property
    def head_bits(self) -> int:
        return self.total if self.total <= 62 else min(self.half, 62)

    def tally(self, lanes: Lanes, counts: np.ndarray | None = None) -> tuple[Lanes, np.ndarray]:
        """Each different n-gram once, in the order of the permuted numbers, with its summed counts."""
        number = self._number(lanes)
        if number is not None and counts is None:
            number, counts = np.unique(number, return_counts=True)
            return self._lanes(number), counts.astype(np.int64)
        order = np.argsort(number, kind="stable") if number is not None else np.lexsort(lanes[::-1])
        lanes = [lane[order] for lane in lanes]
        new = np.zeros(len(order), bool)
        new[:1] = True
        for lane in lanes:
            new[1:] |= lane[1:] != lane[:-1]
        first = np.flatnonzero(new)
        if counts is None:
            sums = np.diff(np.r_[first, len(order)])
        else:
            sums = np.add.reduceat(counts[order], first) if len(first) else np.empty(0, np.int64)
        return [lane[first] for lane in lanes], sums

    def _lanes(self, number: np.ndarray) -> Lanes:
        return [(number >> np.uint64(self.half * j)) & self.mask for j in reversed(range(self.lanes))]

    def _remainders(self, lanes: Lanes, quotient_bits: int) -> list[tuple[np.ndarray, int]]:
        """What follows the quotient, as numbers and how many bytes each takes."""
        number = self._number(lanes)
        rest, width = (lanes[0], self.half - quotient_bits) if number is None else (number, self.total - quotient_bits)
        rest = rest & np.uint64((1 << width) - 1)
        return [(rest, -(-width // 8)), *((lane, -(-self.half // 8)) for lane in (lanes[1:] if number is None else []))]

    def write(self, lanes: Lanes, counts: np.ndarray, bucket_bits: int) -> Iterator[tuple[int, bytes]]:
        """The filter of sorted n-grams, cut into buckets by its first bits."""
        if not len(counts):
            return
        quotient_bits = min(max(bucket_bits, len(counts).bit_length()), self.head_bits)
        quotient = self.head(lanes, quotient_bits)
        below = quotient_bits - bucket_bits
        bucket = quotient >> below
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        bytes_of = [
            (rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]) for rest, width in self._remainders(lanes, quotient_bits)
        ]
        for a, b in zip(first, [*first[1:], len(bucket)], strict=True):
            n = int(b - a)
            unary = np.zeros(n + (1 << below), bool)
            unary[(quotient[a:b] & ((1 << below) - 1)) + np.arange(n)] = True
            great = np.flatnonzero(counts[a:b] >= 255)
            yield int(bucket[a]), b"".join((
                np.array([n, quotient_bits, len(great)], "<i8").tobytes(), np.packbits(unary).tobytes(),
                *(np.ascontiguousarray(part[a:b]).tobytes() for part in bytes_of),
                np.minimum(counts[a:b], 255).astype(np.uint8).tobytes(), counts[a:b][great].astype("<i8").tobytes(),
            ))

    def read(self, bucket: int, data: bytes, bucket_bits: int) -> tuple[Lanes, np.ndarray]:
        """The n-grams and counts of a bucket of a filter."""
        n, quotient_bits, great = np.frombuffer(data, "<i8", 3).tolist()
        below, at = quotient_bits - bucket_bits, _HEADER

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        unary = np.unpackbits(take(-(-(n + (1 << below)) // 8)), count=n + (1 << below))
        quotient = (np.flatnonzero(unary) - np.arange(n)).astype(np.uint64) | np.uint64(bucket << below)

        def numbers(width: int) -> np.ndarray:
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = take(n * width).reshape(n, width)
            return wide.view("<u8").reshape(n).astype(np.uint64)

        if self.total <= 64:
            width = self.total - quotient_bits
            rest = numbers(-(-width // 8))
            lanes = self._lanes(rest | (quotient << np.uint64(width) if width < 64 else np.uint64(0)))
        else:
            width = self.half - quotient_bits
            lanes = [numbers(-(-width // 8)) | (quotient << np.uint64(width) if width < 64 else np.uint64(0))]
            lanes += [numbers(-(-self.half // 8)) for _ in range(self.lanes - 1)]
        counts = take(n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(data, "<i8", great, at)
        return lanes, counts
