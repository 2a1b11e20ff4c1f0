"""Counts of word sequences in a burst trie with hash containers at its leaves.

A sequence of words is one 64-bit key of word numbers, first word in front, zeros behind its end.
Nodes near the root divide the keys by one word; below them, hash containers count the keys of a range
of words. A container that grows too full is divided at a word, and one that holds a single word at its
level becomes a node of the next word. Whole subtrees can be taken out as runs of sorted keys.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np

# Keys of a container before it bursts.
BURST = 20_000


class _Node:
    def __init__(self, depth: int, lows: list[int], children: list):
        # `children[i]` holds the keys whose word at `depth` is `lows[i]` or more, and less than the next.
        self.depth, self.lows, self.children = depth, lows, children


def _sorted(child) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(child, _Node):
        parts = [_sorted(c) for c in child.children]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    keys = np.fromiter(child.keys(), np.uint64, len(child))
    order = np.argsort(keys)
    return keys[order], np.fromiter(child.values(), np.int64, len(child))[order]


def _size(child) -> int:
    return sum(map(_size, child.children)) if isinstance(child, _Node) else len(child)


class HatTrie:
    """Counts of sequences of up to `width` words, whose numbers are below `2 ** (64 // width)`, and not 0."""

    def __init__(self, width: int, burst: int = BURST):
        self.width, self.bits, self.burst = width, 64 // width, burst
        self.root = _Node(0, [0], [Counter()])
        self.entries = 0

    def pack(self, words: list[np.ndarray]) -> np.ndarray:
        key = np.zeros(len(words[0]), np.uint64)
        for word in words:
            key = (key << np.uint64(self.bits)) | word.astype(np.uint64)
        return key << np.uint64(64 - self.bits * len(words))

    def word(self, keys: np.ndarray, depth: int) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits * (depth + 1))) & np.uint64((1 << self.bits) - 1)

    def add(self, keys: np.ndarray) -> None:
        self._add(self.root, np.sort(keys))

    def _add(self, node: _Node, keys: np.ndarray) -> None:
        cuts = np.searchsorted(self.word(keys, node.depth), np.array(node.lows[1:], np.uint64))
        cuts = [0, *cuts.tolist(), len(keys)]
        # From behind, as a container that bursts moves those behind it.
        for i in range(len(node.children) - 1, -1, -1):
            if cuts[i] == cuts[i + 1]:
                continue
            child = node.children[i]
            if isinstance(child, _Node):
                self._add(child, keys[cuts[i] : cuts[i + 1]])
                continue
            before = len(child)
            child.update(keys[cuts[i] : cuts[i + 1]].tolist())
            self.entries += len(child) - before
            if len(child) > self.burst:
                self._burst(node, i)

    def _burst(self, node: _Node, i: int) -> None:
        keys, counts = _sorted(node.children[i])
        words = self.word(keys, node.depth)
        if words[0] == words[-1]:
            if node.depth + 1 < self.width:
                self._deepen(node, i, int(words[0]))
            return
        cut = int(np.searchsorted(words, words[len(words) // 2]))
        cut = cut or int(np.searchsorted(words, words[0], "right"))
        halves = [Counter(dict(zip(keys[a:b].tolist(), counts[a:b].tolist()))) for a, b in ((0, cut), (cut, len(keys)))]
        node.children[i : i + 1] = halves
        node.lows.insert(i + 1, int(words[cut]))

    def _deepen(self, node: _Node, i: int, word: int) -> None:
        """Make a container that holds one word a node of the next, and leave the rest of its range to others."""
        below = _Node(node.depth + 1, [0], [node.children[i]])
        last = node.lows[i + 1] if i + 1 < len(node.lows) else 1 << self.bits
        parts = [(node.lows[i], Counter())] * (node.lows[i] < word) + [(word, below)]
        parts += [(word + 1, Counter())] * (word + 1 < last)
        node.lows[i : i + 1] = [low for low, _ in parts]
        node.children[i : i + 1] = [child for _, child in parts]
        self._burst(below, 0)

    def spill(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out the largest subtrees, until `most` keys are left, each as sorted keys with counts."""
        sizes = sorted(((_size(c), i) for i, c in enumerate(self.root.children)), reverse=True)
        for size, i in sizes:
            if self.entries <= most or not size:
                break
            child, self.root.children[i] = self.root.children[i], Counter()
            self.entries -= size
            yield _sorted(child)

    def prefixes(self, keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The distinct beginnings of `depth` words in a run, as keys, and how often they occur."""
        long = self.word(keys, depth - 1) > 0
        shift = np.uint64(64 - self.bits * depth)
        heads, counts = keys[long] >> shift << shift, counts[long]
        starts = np.flatnonzero(np.append(True, heads[1:] != heads[:-1])[: len(heads)])
        return heads[starts], np.add.reduceat(counts, starts) if len(starts) else counts
