"""A compressed full-text index over sequences of words, and matching statistics from it.

The index is the Burrows-Wheeler transform of the sequences, kept in a wavelet matrix of packed bit
rows, with the borders of the groups of suffixes that agree in ``depth`` and in ``depth - 1`` words.
Backward search takes one rank query on either side per word, whatever the number of occurrences.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """rank over a sequence of symbols: one packed bit row and one row of counts per bit."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        row = symbols.astype(np.uint32)
        for level in reversed(range(self.levels)):
            bit = ((row >> np.uint32(level)) & np.uint32(1)).astype(bool)
            packed = np.zeros((len(row) // 64 + 1) * 8, np.uint8)
            bytes_ = np.packbits(bit, bitorder="little")
            packed[: len(bytes_)] = bytes_
            blocks = packed.view(np.uint64)
            counts = np.zeros(len(blocks), np.int64)
            np.cumsum(np.bitwise_count(blocks)[:-1], out=counts[1:])
            self.bits.append(blocks)
            self.before.append(counts)
            self.zeros.append(len(row) - int(bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])
        every = np.arange(sigma)
        self.start = self.descend(np.zeros(sigma, np.int64), every)

    def descend(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where the prefix of length ``at`` ends in the last row, seen from each symbol."""
        for depth in range(self.levels):
            block = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[depth][block] + np.bitwise_count(self.bits[depth][block] & low)
            one = (symbols >> (self.levels - 1 - depth)) & 1
            at = np.where(one == 1, self.zeros[depth] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the first ``at`` places."""
        return self.descend(at, symbols) - self.start[symbols]


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(ranks)
    if by < len(ranks):
        out[: len(ranks) - by] = ranks[by:]
    return out


class FmIndex:
    """Index of ``sequences``: symbols of at least 1, each sequence ended by a 0.

    Suffixes are told apart by their first ``depth`` symbols (2 at least), which is what searches
    for up to ``depth`` symbols need.
    """

    def __init__(self, sequences: np.ndarray, depth: int):
        text = sequences.astype(np.int64)
        self.text, self.depth = text, depth
        sigma = int(text.max()) + 1
        ranks, span = text, 1
        while 2 * span <= depth - 1:
            pairs = ranks * (int(ranks.max()) + 1) + _shifted(ranks, span)
            ranks = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
            span *= 2
        tail = _shifted(ranks, depth - span)
        self.suffixes = np.argsort(ranks * (int(ranks.max()) + 1) + tail, kind="stable")
        head = ranks[self.suffixes]
        agree = head[1:] == head[:-1]

        def groups(length: int) -> tuple[np.ndarray, np.ndarray]:
            """Group of each place, and the first place of each group and the end."""
            last = _shifted(ranks, length - span)[self.suffixes]
            new = np.ones(len(text), bool)
            new[1:] = ~(agree & (last[1:] == last[:-1]))
            return np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(text))

        self.group, self.group_first = groups(depth)
        self.shorter, self.shorter_first = groups(depth - 1)
        counts = np.bincount(text, minlength=sigma)
        self.smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.transform = WaveletMatrix(text[self.suffixes - 1], sigma)

    def extend(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: from the places of a word sequence to those of symbol + sequence."""
        rank = self.transform.rank
        return self.smaller[symbols] + rank(symbols, low), self.smaller[symbols] + rank(symbols, high)

    def occurrences(self, sequence: np.ndarray) -> int:
        """How often a sequence of up to ``depth`` indexed symbols occurs."""
        low, high = np.zeros(1, np.int64), np.full(1, len(self.text))
        for symbol in sequence[::-1]:
            low, high = self.extend(low, high, np.array([symbol]))
        return max(0, int(high[0] - low[0]))

    def stream(self, firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each place of the indexed text, the group of its window of ``depth`` words, or -1.

        The given sequences are read from their ends, all at once. A match that has reached
        ``depth`` words gives up its last word (the interval widens to its ``depth - 1`` group)
        before it takes the next one in front, so that each word costs one backward step.
        """
        found = np.full(len(self.text), -1, np.int64)
        order = np.argsort(-lengths, kind="stable")
        firsts, lengths = firsts[order], lengths[order]
        low = np.zeros(len(firsts), np.int64)
        high = np.full(len(firsts), len(self.text), np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -step, "left"))
            at = firsts[:live] + lengths[:live] - 1 - step
            low, high = self.extend(low[:live], high[:live], self.text[at])
            if step + 1 >= self.depth:
                found[at] = self.group[low]
                wider = self.shorter[low]
                low, high = self.shorter_first[wider], self.shorter_first[wider + 1]
        return found
