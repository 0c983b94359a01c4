"""A compressed full-text index over sequences of numbers, searched from the back for many patterns at once.

The Burrows-Wheeler transform of a text is kept in a wavelet tree in the shape of a Huffman code, one level of packed bits with
counts per 64 of them, which takes the text's zero-order entropy and a half: frequent symbols are a few bits deep. Backward search
lengthens a pattern by one symbol to the left with two rank queries.
"""

from __future__ import annotations

import heapq

import numpy as np

from tierlake.llm.periodic_runs import suffix_order


def huffman_lengths(counts: np.ndarray) -> np.ndarray:
    """The length of each symbol's code; at least 1."""
    if len(counts) == 1:
        return np.ones(1, np.int64)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * len(counts) - 1, np.int64)
    for node in range(len(counts), 2 * len(counts) - 1):
        (c, a), (d, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = node
        heapq.heappush(heap, (c + d, node))
    depth = np.zeros(len(parent), np.int64)
    for node in range(len(parent) - 2, -1, -1):  # a parent has the larger number
        depth[node] = depth[parent[node]] + 1
    return depth[: len(counts)]


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Prefix-free codes of these lengths, shorter ones first."""
    codes, code, last = np.zeros(len(lengths), np.int64), 0, 0
    for symbol in np.argsort(lengths, kind="stable").tolist():
        code <<= int(lengths[symbol]) - last
        last = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


class WaveletTree:
    """Ranks of symbols (0 .. n - 1, each of which occurs) in a sequence."""

    def __init__(self, sequence: np.ndarray):
        counts = np.bincount(sequence)
        self.lengths = huffman_lengths(counts)
        codes, deepest = canonical_codes(self.lengths), int(self.lengths.max())
        self.words, self.before, self.bit, self.start, self.at_start = [], [], [], [], []
        held = sequence
        for level in range(deepest):
            held = held[self.lengths[held] > level]
            # The nodes of a level lie side by side: sequence order within a node, nodes by the code read so far.
            node = codes >> np.maximum(self.lengths - level, 0)
            held = held[np.argsort(node[held], kind="stable")]
            bits = codes >> np.maximum(self.lengths - 1 - level, 0) & 1
            own = bits[held].astype(np.uint8)
            packed = np.packbits(np.pad(own, (0, -len(own) % 64 + 64)), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            start = np.searchsorted(node[held], node)
            self.bit.append(bits)
            self.start.append(start)
            self.at_start.append(self._ones(level, start))

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        """The number of ones before each place of a level."""
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        found = np.empty(len(symbols), np.int64)
        left, symbol, place = np.arange(len(symbols)), symbols, places
        for level in range(len(self.words)):
            start = self.start[level][symbol]
            ones = self._ones(level, start + place) - self.at_start[level][symbol]
            place = np.where(self.bit[level][symbol] == 1, ones, place - ones)
            more = self.lengths[symbol] > level + 1
            found[left[~more]] = place[~more]
            left, symbol, place = left[more], symbol[more], place[more]
            if not len(left):
                break
        return found


class FMIndex:
    """An index over some sequences of the symbols 0 .. n - 1; no pattern reaches from one into the next."""

    def __init__(self, ids: np.ndarray, border: np.ndarray):
        sequences = len(border) - 1
        symbols = np.empty(len(ids) + sequences, np.int64)
        stops = border[1:] + np.arange(sequences)
        at = np.arange(len(ids)) + np.repeat(np.arange(sequences), np.diff(border))
        symbols[at] = ids + sequences
        symbols[stops] = np.arange(sequences)  # an end of its own for each, so that all suffixes differ
        order, _ = suffix_order(symbols)
        last = symbols[order - 1]  # the symbol before each suffix; before the first of all lies the last end
        # To the index all ends are one symbol, which patterns never have.
        self.tree = WaveletTree(np.maximum(last - sequences + 1, 0))
        counts = np.bincount(np.maximum(symbols - sequences + 1, 0))
        self.first = np.cumsum(counts) - counts
        self.size = len(symbols)

    def back(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with each symbol and then go on as those between `low` and `high`."""
        symbol, n = ids + 1, len(ids)
        ranks = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + ranks[:n], self.first[symbol] + ranks[n:]

    def matching(self, ids: np.ndarray, ends: np.ndarray, most: int, least_found: int = 2) -> np.ndarray:
        """Matching statistics: the greatest length, up to `most`, of what ends before each of `ends` in `ids` and occurs at least
        `least_found` times in the index. `most` symbols must lie before each end."""
        length = np.zeros(len(ends), np.int64)
        left, low, high = np.arange(len(ends)), np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        for step in range(1, most + 1):
            low, high = self.back(low, high, ids[ends[left] - step])
            on = high - low >= least_found
            left, low, high = left[on], low[on], high[on]
            length[left] = step
            if not len(left):
                break
        return length
