"""An FM-index of word sequences: bounded suffix order, wavelet matrix, backward search."""

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels = max(1, int(largest).bit_length())
        self.words: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        n = len(symbols)
        padded = -(-(n + 1) // 64) * 64
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level & 1).astype(np.uint8)
            full = np.zeros(padded, dtype=np.uint8)
            full[:n] = bit
            words = np.packbits(full, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1])))
            self.zeros.append(int(n - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))
        self.starts = self.descend(np.arange(largest + 1), np.zeros(largest + 1, dtype=np.int64))

    def descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Where each place ends up when its symbol's bits are followed level by level."""
        one = np.uint64(1)
        for i in range(self.levels):
            word = places >> 6
            inside = self.words[i][word] & ((one << (places & 63).astype(np.uint64)) - one)
            ones = self.before[i][word] + np.bitwise_count(inside)
            places = np.where(symbols >> (self.levels - 1 - i) & 1, self.zeros[i] + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self.descend(symbols, places) - self.starts[symbols]


class FMIndex:
    """An index of sequences of symbols from 1 on, for patterns of at most ``depth`` symbols.

    Sequences are joined by separators (0). Suffixes are ordered by their first symbols only, at
    least ``depth + 1`` of them, which backward search of such patterns needs and no more.
    """

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.text = text
        n, largest = len(text), int(text.max(initial=0))
        rank, known = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while known <= depth:
            following = np.zeros(n, dtype=np.int64)
            following[: max(0, n - known)] = rank[known:] + 1
            key = rank * (int(following.max(initial=0)) + 1) + following
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) if n else ordered
            known *= 2
        self.order = order
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        self.last = WaveletMatrix(text[order - 1].astype(np.int64), largest)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of patterns, each with one more symbol in front."""
        n = len(low)
        both = self.smaller[symbols]
        ranks = self.last.rank(np.concatenate((symbols, symbols)), np.concatenate((low, high)))
        return both + ranks[:n], both + ranks[n:]

    def shared(self, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of windows of the indexed text, against all of it, up to ``length``.

        ``begins`` are windows of ``length`` symbols in the text. Each is searched backwards, from its
        last symbol on. A window always finds itself, so once its interval holds a single suffix it has no
        other match and is given up. Returns which windows occur elsewhere too, at full length, and
        their intervals in ``order``.
        """
        alive = np.arange(len(begins))
        symbols = self.text[begins + length - 1]
        low, high = self.smaller[symbols], self.smaller[symbols + 1]
        for back in range(2, length + 1):
            several = high - low > 1
            alive, low, high = alive[several], low[several], high[several]
            if not len(alive):
                break
            low, high = self.extend(self.text[begins[alive] + length - back], low, high)
        several = high - low > 1
        return alive[several], low[several], high[several]
