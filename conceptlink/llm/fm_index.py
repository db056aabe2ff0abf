"""FM-index over a symbol sequence: Burrows-Wheeler transform in a bit-packed wavelet tree, searched backwards."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_ONE = U64(1)


class WaveletTree:
    """Ranks of symbols in a sequence; one packed bit per symbol and level, one count per 64 of them.

    The levels stand one after another: each splits the sequence by one bit of the symbols, highest first, zeros before ones.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.height = max(1, int(symbols.max(initial=0)).bit_length())
        self.words, self.before, self.zeros = [], [], []
        current = symbols
        for level in range(self.height):
            ones = ((current >> (self.height - 1 - level)) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(n // 64 + 1, U64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(n - int(counts.sum()))
            current = np.concatenate((current[~ones], current[ones]))
        self.first = self._place(np.arange(1 << self.height), np.zeros(1 << self.height, np.int64))

    def _place(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.height):
            word = at >> 6
            inside = self.words[level][word] & ((_ONE << (at & 63).astype(U64)) - _ONE)
            ones = self.before[level][word] + np.bitwise_count(inside)
            goes_right = (symbols >> (self.height - 1 - level)) & 1
            at = np.where(goes_right, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the place next to it."""
        return self._place(symbols, at) - self.first[symbols]


class FMIndex:
    """Index of ``text`` (whole numbers from 0; 0 separates and is never searched) for strings of at most ``depth`` symbols.

    Suffixes are ordered by at least their first ``depth`` symbols, found by doubling; that is all that searches of this depth ask of
    the order.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.depth, self.n = depth, len(text)
        padded = np.concatenate((text, np.zeros(2 * depth, text.dtype)))
        rank, width = padded.astype(np.int64), 1
        while width < depth:
            after = np.concatenate((rank[width:], np.zeros(width, np.int64)))
            rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)[1]
            width *= 2
        self.suffixes = np.argsort(rank[: self.n], kind="stable")
        top = int(text.max(initial=0))
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.tree = WaveletTree(text[self.suffixes - 1])
        # length of the common start of neighbours in suffix order, up to the depth
        common, same = np.zeros(self.n, np.int64), np.ones(max(self.n - 1, 0), bool)
        for d in range(depth):
            symbol = padded[self.suffixes + d]
            same &= symbol[1:] == symbol[:-1]
            common[1:] += same
        self.common = common
        self._runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix, the bounds of those that share its first ``length`` symbols."""
        if length not in self._runs:
            first = np.flatnonzero(self.common < length) if length else np.zeros(1, np.int64)
            if not len(first) or first[0]:
                first = np.concatenate(([0], first))
            size = np.diff(np.append(first, self.n))
            self._runs[length] = np.repeat(first, size), np.repeat(first + size, size)
        return self._runs[length]

    def _extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the bounds for the symbol followed by what the bounds stand for."""
        k = len(low)
        moved = self.smaller[np.tile(symbols, 2)] + self.tree.rank(np.tile(symbols, 2), np.concatenate((low, high)))
        return moved[:k], moved[k:]

    def _shorten(self, length: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Give up the last symbol of each match, in place."""
        length -= 1
        for d in np.unique(length):
            at = np.flatnonzero(length == d)
            first, stop = self.runs(int(d))
            high[at] = stop[low[at]]
            low[at] = first[low[at]]

    def matching_statistics(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest match (up to the depth) at each place of the streams symbols[start:start + size], and its bounds.

        All streams are read from their ends, side by side. A match that can't be extended, or is as long as the depth already, gives
        up its last symbol first. Symbols that the text lacks match nothing.
        """
        total = len(symbols)
        out = np.zeros((3, total), np.int64)
        order = np.argsort(-sizes, kind="stable")
        ends, sizes = (starts + sizes)[order], sizes[order]
        length, low, high = (np.full(len(order), x, np.int64) for x in (0, 0, self.n))
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -step, side="left"))
            place = ends[:live] - 1 - step
            symbol = symbols[place]
            m, a, b = length[:live], low[:live], high[:live]
            known = symbol < len(self.smaller) - 1
            m[~known], a[~known], b[~known] = 0, 0, self.n
            todo = np.flatnonzero(known)
            full = todo[m[todo] == self.depth]
            if len(full):
                cut = m[full], a[full], b[full]
                self._shorten(*cut)
                m[full], a[full], b[full] = cut
            while len(todo):
                x, y = self._extend(symbol[todo], a[todo], b[todo])
                found = x < y
                good = todo[found]
                a[good], b[good] = x[found], y[found]
                m[good] += 1
                todo = todo[~found]
                todo = todo[m[todo] > 0]
                if len(todo):
                    cut = m[todo], a[todo], b[todo]
                    self._shorten(*cut)
                    m[todo], a[todo], b[todo] = cut
            out[:, place] = m, a, b
        return out[0], out[1], out[2]

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest of ``values`` (one per place of the text) among the occurrences within each of some bounds.

        Bounds of matches of one length are equal or apart, so every value is looked at once.
        """
        if not len(low):
            return np.empty(0, values.dtype)
        first, back = np.unique(low, return_inverse=True)
        stop = np.zeros(len(first), np.int64)
        stop[back] = high
        ordered = np.append(values[self.suffixes], values[:1])
        return np.minimum.reduceat(ordered, np.column_stack((first, stop)).reshape(-1))[::2][back]
