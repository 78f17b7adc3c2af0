"""A prefix tree of ordered sets that finds links at a Jaccard similarity of ``share`` percent or more.

Sets are arrays in one global order, common tokens first, so that near copies share long paths.  A probe
walks the tree once: the overlap with a shared path is counted once for all sets below it, and a subtree is
left as soon as the tokens that remain cannot lift any of its sets over the bound.  ``links`` passes over sets
that are already connected with the probe, so a group of copies costs one link for each set.  ``LevelTree`` finds
every link: it holds the finished tree as arrays and walks all subtrees of a level at once.
"""

from __future__ import annotations

import numpy as np


class _Node:
    __slots__ = ("path", "below", "ends", "least", "most", "rest", "group")

    def __init__(self, path: np.ndarray):
        self.path, self.below, self.ends = path, {}, []
        self.least, self.most, self.rest = np.inf, 0, 0
        self.group: int | None = -1  # a member if all below are connected, None if not


class PrefixTree:
    def __init__(self, share: int = 80):
        self.share, self.root = share, _Node(np.empty(0, np.uint64))
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def _enough(self, overlap: int, size: int, other: float) -> bool:
        return (100 + self.share) * overlap >= self.share * (size + other)

    def add(self, key: int, tokens: np.ndarray, size: int) -> list[tuple[int, int]]:
        """Link ``key`` (its ``tokens``, descending, out of ``size``) to what is in the tree, then insert it."""
        self.parent[key] = key
        links = self._probe(key, tokens, size)
        self._insert(key, tokens, size)
        return links

    def insert(self, key: int, tokens: np.ndarray, size: int) -> None:
        self.parent[key] = key
        self._insert(key, tokens, size)

    def _probe(self, key: int, tokens: np.ndarray, size: int) -> list[tuple[int, int]]:
        rising = tokens[::-1]
        low, high = self.share * size / 100, 100 * size / self.share
        links, stack = [], [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if node.most < low or node.least > high:
                continue
            if node.group is not None and node.group >= 0 and self.find(node.group) == self.find(key):
                continue
            left = len(rising)
            if len(node.path):
                at = np.searchsorted(rising, node.path)
                overlap += int((rising[np.minimum(at, len(rising) - 1)] == node.path).sum()) if len(rising) else 0
                left = int(at[-1])
            if not self._enough(overlap + min(left, node.rest), size, max(node.least, low)):
                continue
            for other, n in node.ends:
                if self._enough(overlap, size, n) and self.find(other) != self.find(key):
                    links.append((other, key))
                    self.parent[self.find(other)] = self.find(key)
            stack.extend((child, overlap) for child in node.below.values())
        return links

    def _insert(self, key: int, tokens: np.ndarray, size: int) -> None:
        node, rest = self.root, tokens
        while True:
            self._note(node, key, size, len(rest))
            if not len(rest):
                node.ends.append((key, size))
                return
            child = node.below.get(int(rest[0]))
            if child is None:
                child = node.below[int(rest[0])] = _Node(rest)
                self._note(child, key, size, 0)
                child.ends.append((key, size))
                return
            m = min(len(child.path), len(rest))
            apart = np.flatnonzero(child.path[:m] != rest[:m])
            cut = int(apart[0]) if len(apart) else m
            if cut < len(child.path):
                upper = _Node(child.path[:cut])
                upper.least, upper.most, upper.group = child.least, child.most, child.group
                upper.rest = child.rest + len(child.path) - cut
                child.path = child.path[cut:]
                upper.below[int(child.path[0])] = child
                child = node.below[int(rest[0])] = upper
            node, rest = child, rest[cut:]

    def _note(self, node: _Node, key: int, size: int, rest: int) -> None:
        node.least, node.most, node.rest = min(node.least, size), max(node.most, size), max(node.rest, rest)
        if node.group == -1:
            node.group = key
        elif node.group is not None and self.find(node.group) != self.find(key):
            node.group = None


def links(sets: list[tuple[int, np.ndarray, int]], share: int = 80) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``(key, tokens descending, size)``."""
    tree, out = PrefixTree(share), []
    for key, tokens, size in sorted(sets, key=lambda s: (s[2], s[0])):
        out += tree.add(key, tokens, size)
    return out


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of each range, one range after the other."""
    return np.arange(length.sum()) + np.repeat(start - np.cumsum(length) + length, length)


class LevelTree:
    """A finished tree of sets of small token numbers (``key``, numbers descending, ``size``), level by level."""

    def __init__(self, sets: list[tuple[int, np.ndarray, int]], share: int = 80):
        tree = PrefixTree(share)
        for key, tokens, size in sets:
            tree.insert(key, tokens, size)
        nodes, kids_at = [tree.root], []
        for node in nodes:  # grows: the children of a node follow each other
            kids_at.append(len(nodes))
            nodes.extend(node.below.values())
        self.share, self.kids_at = share, np.array(kids_at)
        self.kids = np.array([len(x.below) for x in nodes])
        self.length = np.array([len(x.path) for x in nodes])
        self.start = np.cumsum(self.length) - self.length
        self.path = np.concatenate([x.path for x in nodes]).astype(np.int64)
        self.last = np.array([x.path[-1] if len(x.path) else 0 for x in nodes], np.int64)
        self.least, self.most, self.rest = (np.array([getattr(x, f) for x in nodes], float) for f in ("least", "most", "rest"))
        ends = [e for x in nodes for e in x.ends]
        self.ends = np.array([len(x.ends) for x in nodes])
        self.ends_at = np.cumsum(self.ends) - self.ends
        self.key, self.size = (np.array([e[i] for e in ends], np.int64) for i in (0, 1))

    def probe(self, tokens: np.ndarray, flags: np.ndarray, size: int) -> np.ndarray:
        """Keys of all sets that link with the set of ``tokens`` (ascending), which ``flags`` marks."""
        low, high = self.share * size / 100, 100 * size / self.share
        found, node, over = [], np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(node):
            length = self.length[node]
            hits = np.r_[0, np.cumsum(flags[self.path[ragged(self.start[node], length)]])]
            ends = np.cumsum(length)
            over = over + hits[ends] - hits[ends - length]
            left = np.where(length > 0, np.searchsorted(tokens, self.last[node]), len(tokens))
            most = over + np.minimum(left, self.rest[node])
            bound = self.share * (size + np.maximum(self.least[node], low))
            open_ = (self.most[node] >= low) & (self.least[node] <= high) & ((100 + self.share) * most >= bound)
            node, over = node[open_], over[open_]
            at = ragged(self.ends_at[node], self.ends[node])
            enough = (100 + self.share) * np.repeat(over, self.ends[node]) >= self.share * (size + self.size[at])
            found.append(self.key[at[enough]])
            node, over = ragged(self.kids_at[node], self.kids[node]), np.repeat(over, self.kids[node])
        return np.concatenate(found)
