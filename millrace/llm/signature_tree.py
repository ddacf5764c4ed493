"""Similar sets among a bounded number of sets, by a signature tree.

Every set has a bitmap of hashed elements. Sets are sorted so that alike ones stand together and
packed into nodes of ``FAN``; a node holds the OR of its bitmaps, the range of its sizes, the most
elements that share a bit with another one, and its component if all its sets are in one. Pairs
of nodes are followed from the root down; a pair is left out if its sizes cannot be close enough,
if the greatest overlap its bitmaps allow is too small, or if all its sets are already connected.
Pairs of sets that remain are compared element by element. Nothing here approximates.

``may_link`` uses smaller bitmaps alone, to tell which sets need not be brought together at all.
"""

from __future__ import annotations

import numpy as np

FAN = 8
# Pairs compared at a time; what is found there spares later ones.
CHUNK = 1 << 14


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a & b| >= percent * |a | b|, for sorted arrays of distinct elements."""
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _bits(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 64-bit words per set; wide enough for a set of usual size to stay sparse."""
    sizes = np.array([len(s) for s in sets])
    width = 1 << int(np.clip(np.ceil(np.log2(4 * np.percentile(sizes, 75) + 1)), 6, 14))
    words = np.zeros((len(sets), width // 64), np.uint64)
    for row, elements in zip(words, sets, strict=True):
        place = (elements & np.uint64(width - 1)).astype(np.int64)
        np.bitwise_or.at(row, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
    return words


class Forest:
    """Union-find over positions; ``labels`` are always roots."""

    def __init__(self, labels: np.ndarray):
        self.labels = labels.copy()

    def join(self, i: int, j: int) -> None:
        a, b = self.labels[i], self.labels[j]
        self.labels[self.labels == max(a, b)] = min(a, b)


class Level:
    """The nodes of one level, sets themselves at the lowest."""

    def __init__(self, bits, low, high, excess):
        self.bits, self.low, self.high, self.excess = bits, low, high, excess

    def above(self) -> Level:
        starts = np.arange(0, len(self.low), FAN)
        return Level(
            np.bitwise_or.reduceat(self.bits, starts),
            np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts),
            np.maximum.reduceat(self.excess, starts),
        )

    def possible(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Pairs of nodes that may hold alike sets."""
        low, high = np.maximum(self.low[i], self.low[j]), np.minimum(self.high[i], self.high[j])
        fits = 100 * high >= percent * low
        i, j = i[fits], j[fits]
        overlap = np.minimum(self.excess[i], self.excess[j])
        step = max(1, (1 << 18) // self.bits.shape[1])  # a few MB of bitmaps at a time
        for k in range(0, len(i), step):
            shared = self.bits[i[k : k + step]] & self.bits[j[k : k + step]]
            overlap[k : k + step] += np.bitwise_count(shared).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(overlap, np.minimum(self.high[i], self.high[j]))
        fits[fits] = (100 + percent) * overlap >= percent * (self.low[i] + self.low[j])
        return fits


def link(sets: list[np.ndarray], percent: int, labels: np.ndarray | None = None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all alike sets: a forest, not all pairs.

    ``labels`` gives components known before; only sets of different ones are compared. With
    ``side`` only sets of different sides are compared.
    """
    n = len(sets)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((sizes, [s[0] for s in sets]))
    names = np.arange(n) if labels is None else np.unique(labels, return_inverse=True)[1]
    forest = Forest(names[order])
    sides = None if side is None else np.asarray(side)[order]
    own = [sets[k] for k in order]
    sizes = sizes[order]
    found: list[tuple[int, int]] = []

    def compare(i, j):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if forest.labels[a] != forest.labels[b] and alike(own[a], own[b], percent):
                forest.join(a, b)
                found.append((int(order[a]), int(order[b])))

    if sides is None:
        # Neighbours first: alike sets mostly stand together, and what is connected is not compared again.
        compare(np.arange(n - 1), np.arange(1, n))
    bits = _bits(own)
    levels = [Level(bits, sizes, sizes, sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64))]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].above())

    def uniform(depth: int) -> np.ndarray:
        """The component of each node, or -1 - node where it holds several."""
        low = high = forest.labels
        for _ in range(depth):
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
        return np.where(low == high, low, -1 - np.arange(len(low)))

    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, i, j = stack.pop()
        if len(i) > CHUNK:
            stack += [(depth, i[k : k + CHUNK], j[k : k + CHUNK]) for k in range(0, len(i), CHUNK)][::-1]
            continue
        known = uniform(depth)
        open_ = known[i] != known[j]
        if depth:
            open_ |= known[i] < 0
        i, j = i[open_], j[open_]
        fits = levels[depth].possible(i, j, percent)
        i, j = i[fits], j[fits]
        if depth == 0:
            if sides is not None:
                cross = sides[i] != sides[j]
                i, j = i[cross], j[cross]
            compare(i, j)
            continue
        below = len(levels[depth - 1].low)
        step = np.arange(FAN)
        a = (i[:, None, None] * FAN + step[None, :, None]) + np.zeros((1, 1, FAN), np.int64)
        b = (j[:, None, None] * FAN + step[None, None, :]) + np.zeros((1, FAN, 1), np.int64)
        keep = (a < below) & (b < below) & ((i != j)[:, None, None] | (a <= b if depth > 1 else a < b))
        if keep.any():
            stack.append((depth - 1, a[keep], b[keep]))
    return found


# Most bits of a sketch; those of larger sets say less.
MOST_BITS = 1 << 16


def sketch(elements: np.ndarray) -> bytes:
    """A bitmap of hashed elements: a power of two of bits, at least two an element up to ``MOST_BITS``."""
    width = 1 << int(np.clip((2 * len(elements) - 1).bit_length(), 6, MOST_BITS.bit_length() - 1))
    flags = np.zeros(width, np.uint8)
    flags[(elements & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def may_link(sketches: list[bytes], sizes: np.ndarray, percent: int, labels: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
    """Whether each set may be alike to one of another label, and of the other ``side`` if given.

    Sketches are folded or repeated to one width. The elements two sets share are at most the bits
    they share and the elements of either that share a bit with another of their set.
    """
    n = len(sketches)
    widths = np.array([len(s) for s in sketches])
    width = int(np.sort(widths)[3 * (n - 1) // 4])
    order = np.argsort(sizes, kind="stable")
    bits = np.empty((n, width // 8), np.uint64)
    excess = np.empty(n, np.int64)
    for at, k in enumerate(order.tolist()):
        own = np.frombuffer(sketches[k], np.uint64)
        narrow = min(width, len(sketches[k])) // 8
        own = np.bitwise_or.reduce(own.reshape(-1, narrow), axis=0)
        excess[at] = sizes[k] - int(np.bitwise_count(own).sum())
        bits[at] = np.tile(own, width // 8 // narrow)
    sizes, labels = sizes[order], labels[order]
    sides = None if side is None else side[order]
    most = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    found = np.zeros(n, bool)
    for i in range(n):
        others = np.arange(i + 1, most[i])
        wanted = labels[others] != labels[i]
        if sides is not None:
            wanted &= sides[others] != sides[i]
        if found[i]:
            wanted &= ~found[others]
        others = others[wanted]
        for k in range(0, len(others), max(1, (1 << 21) // width)):
            some = others[k : k + max(1, (1 << 21) // width)]
            shared = np.bitwise_count(bits[some] & bits[i]).sum(axis=1, dtype=np.int64) + np.minimum(excess[some], excess[i])
            fits = (100 + percent) * np.minimum(shared, sizes[i]) >= percent * (sizes[some] + sizes[i])
            found[some[fits]] = True
            found[i] |= fits.any()
    out = np.empty(n, bool)
    out[order] = found
    return out
