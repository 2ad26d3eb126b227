"""Counts of packed word-id grams in burstable hash containers under a shallow trie."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Children of an inner node, and how many bits of the path choose one.
FAN, BITS = 16, 4
#: Entries with which a container bursts into an inner node, and depth beyond which none does.
BURST, DEEPEST = 1 << 15, 15


class Container:
    """An open-addressing table from non-negative int64 keys to counts; whole arrays of keys are added at a time."""

    def __init__(self, size: int = 1 << 10):
        self.keys = np.full(size, -1, np.int64)
        self.counts = np.zeros(size, np.int64)
        self.used = 0

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        there = self.keys >= 0
        return self.keys[there], self.counts[there]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add ``counts`` to distinct ``keys``."""
        size = len(self.keys)
        if 2 * (self.used + len(keys)) > size:
            old = self.entries()
            while 2 * (self.used + len(keys)) > size:
                size *= 2
            self.keys, self.counts, self.used = np.full(size, -1, np.int64), np.zeros(size, np.int64), 0
            self.add(*old)
        shift = np.uint64(65 - size.bit_length())
        slot = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = keys[free]  # of several keys that want a slot, one stays
            mine = self.keys[slot] == keys
            self.used += int(mine[free].sum())
            self.counts[slot[mine]] += counts[mine]
            left = ~mine
            keys, counts, slot = keys[left], counts[left], (slot[left] + 1) & (size - 1)


class HatTrie:
    """Grams counted under the digits of their path, which ``path`` gives as 64 bits per key.

    The first digits lead through inner nodes to a container; one that holds
    more than BURST entries becomes an inner node with new containers.
    """

    def __init__(self, path: Callable[[np.ndarray], np.ndarray]):
        self.path = path
        self.root: list = [Container() for _ in range(FAN)]
        self.sizes = [0] * FAN

    def __len__(self) -> int:
        return sum(self.sizes)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        for child in self._dealt(keys, counts, 0):
            number, keys_, counts_ = child
            self.root[number], grown = self._add(self.root[number], keys_, counts_, 1)
            self.sizes[number] += grown

    def _dealt(self, keys: np.ndarray, counts: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        digit = (self.path(keys) >> np.uint64(64 - BITS * (depth + 1))).astype(np.uint8) & (FAN - 1)
        by = np.argsort(digit, kind="stable")
        cuts = np.searchsorted(digit[by], np.arange(FAN + 1))
        keys, counts = keys[by], counts[by]
        for n in range(FAN):
            if cuts[n] < cuts[n + 1]:
                part = slice(cuts[n], cuts[n + 1])
                yield n, keys[part], counts[part]

    def _add(self, node, keys: np.ndarray, counts: np.ndarray, depth: int):
        """The node after the keys are in it, and by how many entries it has grown."""
        if isinstance(node, Container):
            before = node.used
            node.add(keys, counts)
            grown = node.used - before
            if node.used > BURST and depth < DEEPEST:
                inner: list = [Container() for _ in range(FAN)]
                for n, keys_, counts_ in self._dealt(*node.entries(), depth):
                    inner[n], _ = self._add(inner[n], keys_, counts_, depth + 1)
                node = inner
            return node, grown
        total = 0
        for n, keys_, counts_ in self._dealt(keys, counts, depth):
            node[n], grown = self._add(node[n], keys_, counts_, depth + 1)
            total += grown
        return node, total

    def _entries(self, node) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if isinstance(node, Container):
            yield node.entries()
        else:
            for child in node:
                yield from self._entries(child)

    def cut(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Take the whole subtree of a first digit out: its keys and their counts."""
        keys, counts = zip(*self._entries(self.root[number]))
        self.root[number], self.sizes[number] = Container(), 0
        return np.concatenate(keys), np.concatenate(counts)

    def largest(self) -> int:
        return max(range(FAN), key=self.sizes.__getitem__)
