"""A signature tree over token sets: nodes with OR-combined bitmaps, searched by dual traversal."""

from collections.abc import Iterator, Sequence

import numpy as np

#: Children of a node; node pairs worked on at once, and words of their bitmaps.
FAN_OUT = 8
PAIRS = 1 << 14
WORDS = 1 << 20
#: Bits for each token of the largest set, up to a bitmap's largest width.
BITS_PER_TOKEN = 32
WIDEST = 1 << 15


class SignatureTree:
    """Sets as sorted arrays of distinct 64-bit tokens.

    Every token sets one bit of its set's bitmap. Sets are ordered by size and then by bitmap, so that
    neighbours are alike; ``FAN_OUT`` neighbours hang under a node, and so on up to one root. A node
    holds the OR of the bitmaps below it, the smallest and largest size, and the most tokens by
    which a set below has more tokens than bits. Two sets have at most as many tokens in common
    as their bitmaps have bits, and the smaller of those surpluses; so have the sets of two nodes.
    """

    def __init__(self, sets: Sequence[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        width = 64
        while width < BITS_PER_TOKEN * sizes.max(initial=1) and width < WIDEST:
            width *= 2
        bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
        for i, own in enumerate(sets):
            at = own.view(np.uint64) & np.uint64(width - 1)
            np.bitwise_or.at(bits[i], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.order = np.lexsort((*[bits[:, i] for i in range(min(4, bits.shape[1]))], sizes))
        bits, sizes = bits[self.order], sizes[self.order]
        surplus = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.sets = [sets[i] for i in self.order.tolist()]
        self.levels = [(bits, sizes, sizes, surplus)]
        while len(self.levels[-1][0]) > 1:
            bits, least, most, surplus = self.levels[-1]
            starts = np.arange(0, len(bits), FAN_OUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, starts, axis=0), np.minimum.reduceat(least, starts),
                np.maximum.reduceat(most, starts), np.maximum.reduceat(surplus, starts),
            ))
        self.compared = 0

    def _possible(self, level: int, left: np.ndarray, right: np.ndarray, share: tuple[int, int]) -> np.ndarray:
        """Node pairs that sets under them may link by their largest possible overlap."""
        bits, least, most, surplus = self.levels[level]
        above, below = share
        overlap = np.minimum(most[left], most[right])
        possible = (above + below) * overlap >= above * (least[left] + least[right])
        left, right, overlap = left[possible], right[possible], overlap[possible]
        step = max(1, WORDS // bits.shape[1])
        common = np.empty(len(left), dtype=np.int64)
        for i in range(0, len(left), step):
            part = slice(i, i + step)
            common[part] = np.bitwise_count(bits[left[part]] & bits[right[part]]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(overlap, common + np.minimum(surplus[left], surplus[right]))
        possible[possible] = (above + below) * overlap >= above * (least[left] + least[right])
        return possible

    def candidates(self, share: tuple[int, int], settled=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets (places in ``order``) that the bounds leave, each pair once.

        The tree is traversed against itself, depth first, in portions of at most ``PAIRS`` node
        pairs. ``settled(level, left, right)`` may tell node pairs that need no comparison.
        """
        if not self.sets:
            return
        top = len(self.levels) - 1
        stack = [(top, np.array([0]), np.array([0]))]
        while stack:
            level, left, right = stack.pop()
            if settled is not None:
                open_ = ~settled(level, left, right)
                left, right = left[open_], right[open_]
            possible = self._possible(level, left, right, share)
            left, right = left[possible], right[possible]
            if not len(left):
                continue
            if level == 0:
                yield left, right
                continue
            count = len(self.levels[level - 1][0])
            i, j = (x.ravel() for x in np.meshgrid(np.arange(FAN_OUT), np.arange(FAN_OUT), indexing="ij"))
            step = max(1, PAIRS // len(i))
            for begin in range(0, len(left), step):
                a = (left[begin : begin + step, None] * FAN_OUT + i).ravel()
                b = (right[begin : begin + step, None] * FAN_OUT + j).ravel()
                once = (a < b) if level == 1 else (a <= b)
                once &= b < count
                stack.append((level - 1, a[once], b[once]))

    def linked(self, left: np.ndarray, right: np.ndarray, share: tuple[int, int]) -> np.ndarray:
        """Which pairs link, by their exact overlap."""
        above, below = share
        sizes = self.levels[0][1]
        out = np.zeros(len(left), dtype=bool)
        for n, (i, j) in enumerate(zip(left.tolist(), right.tolist())):
            both = np.concatenate((self.sets[i], self.sets[j]))
            both.sort(kind="stable")
            overlap = int(np.count_nonzero(both[1:] == both[:-1]))
            out[n] = (above + below) * overlap >= above * int(sizes[i] + sizes[j])
        self.compared += len(left)
        return out

    def components(self, share: tuple[int, int], label: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
        """A label per set, in the order given: sets with equal labels are linked, directly or over others.

        ``share`` is (n, d) for sets that link when the intersection has at least n / d of the union. ``label``
        numbers sets that are known to be linked. Pairs of one label are not compared; a subtree that
        has one label throughout is not traversed against another of that label. With ``side``, sets of
        one side are not compared with each other.
        """
        label = np.arange(len(self.sets)) if label is None else np.unique(label, return_inverse=True)[1][self.order]
        label = label.astype(np.int64)
        side = None if side is None else side[self.order]

        def settled(level: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            span = FAN_OUT**level
            starts = np.arange(0, len(label), span)
            low, high = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
            return (low[left] == high[left]) & (low[right] == high[right]) & (low[left] == low[right])

        for left, right in self.candidates(share, settled):
            if side is not None:
                across = side[left] != side[right]
                left, right = left[across], right[across]
            most, sort = 1, np.argsort(left, kind="stable")
            left, right = left[sort], right[sort]
            while len(left):
                open_ = label[left] != label[right]
                left, right = left[open_], right[open_]
                # some pairs of each set at a time: its links may settle its other pairs
                first = np.concatenate(([True], left[1:] != left[:-1])) if len(left) else np.zeros(0, dtype=bool)
                nth = np.arange(len(left)) - np.maximum.accumulate(np.where(first, np.arange(len(left)), 0))
                now = nth < most
                a, b = left[now], right[now]
                near = self.linked(a, b, share)
                for i, j in zip(a[near].tolist(), b[near].tolist()):
                    if label[i] != label[j]:
                        label[label == max(label[i], label[j])] = min(label[i], label[j])
                left, right, most = left[~now], right[~now], 2 * most
        out = np.empty_like(label)
        out[self.order] = label
        return out
