"""Context-tree mixtures over sorted rows (context, byte), whole subtrees at a time.

A row's key holds the bytes before the coded one, the newest first, and the coded byte in
its lowest eight bits, so the rows of a context stand together at every depth. Each byte is
eight binary decisions; a decision of a context is a run of rows with equal leading bits of the byte.
Rows that were not trained on have a count of zero: they are asked for, and change nothing.
"""

from __future__ import annotations

import math

import numpy as np

LN2 = math.log(2)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of x > 0 by Stirling's series from x + 8."""
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse / 1260)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


_SMALL = np.arange(4_096, dtype=np.float64)
_TABLES = {x: log_gamma(_SMALL + x) for x in (0.5, 1.0)}


def _log_gamma_of(n: np.ndarray, more: float) -> np.ndarray:
    """log_gamma(n + more) of whole numbers; small ones are looked up."""
    out = _TABLES[more][np.minimum(n, len(_SMALL) - 1).astype(np.intp)]
    large = n >= len(_SMALL)
    out[large] = log_gamma(n[large] + more)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - _log_gamma_of(zeros + ones, 1.0) - math.log(math.pi)


def run_starts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def numbers_of(starts: np.ndarray, size: int) -> np.ndarray:
    """The number of its run, for each row."""
    return np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, size]))


class Depth:
    """Rows of the contexts of one length.

    ``kept`` rows are of contexts with a node, those that ``least`` training bytes follow; ``split``
    ones of nodes with children. Where ``least`` is over 1, rarer contexts below a node share one leaf.
    """

    def __init__(self, keys: np.ndarray, n: np.ndarray, least: float):
        self.keys, self.n, self.rest = keys, n, n
        starts = run_starts(keys >> 8)
        self.node = numbers_of(starts, len(keys))
        self.kept = (np.add.reduceat(n, starts) >= least)[self.node]
        self.split = np.zeros(len(keys), bool)
        self.up = None

    def shorter(self, least: float) -> Depth:
        """Rows of the contexts without their oldest byte; ``up`` says which of them each row is in."""
        keys, self.up = np.unique(self.keys >> 16 << 8 | self.keys & 255, return_inverse=True)
        above = Depth(keys, np.bincount(self.up, self.n, len(keys)).astype(np.int64), least)
        at = self.up[self.kept]
        above.has(np.bincount(at, self.n[self.kept], len(keys)).astype(np.int64))
        return above

    def has(self, below: np.ndarray) -> None:
        """``below``: what of each row's count is in nodes under it."""
        self.rest = self.n - below
        parents = np.zeros(int(self.node[-1]) + 1, bool)
        parents[self.node[below > 0]] = True
        self.split = parents[self.node]

    def level(self, bit: int) -> Level:
        return Level(self, bit)


class Level:
    """The decisions on one bit of the byte, in all contexts of a length."""

    def __init__(self, depth: Depth, bit: int):
        self.depth, self.bit = depth, (depth.keys >> (7 - bit) & 1).astype(bool)
        self.starts = run_starts(depth.keys >> (8 - bit))
        self.number = numbers_of(self.starts, len(depth.keys))
        self.zeros, self.ones = self.counts(depth.n)

    def counts(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, ones = np.add.reduceat(n, self.starts), np.add.reduceat(np.where(self.bit, n, 0), self.starts)
        return total - ones, ones

    def weigh(self, below: np.ndarray | None) -> None:
        """Logarithms of the mixed code probability of each decision, and the weight of its own estimate in it."""
        own = log_kt(self.zeros, self.ones)
        self.mixed, self.stop = own, np.ones(len(own))
        split = np.flatnonzero(self.depth.split[self.starts])
        self.rests = self.counts(self.depth.rest)
        if below is not None and len(split):
            deep = below[split] + log_kt(self.rests[0][split], self.rests[1][split])
            self.mixed = own.copy()
            self.mixed[split] = np.logaddexp(own[split], deep) - LN2
            self.stop[split] = np.exp(own[split] - LN2 - self.mixed[split])

    def gathered(self, above: Level) -> np.ndarray:
        """For each decision one context byte shorter, the sum over the nodes under it."""
        kept = self.depth.kept[self.starts]
        return np.bincount(above.number[self.depth.up[self.starts[kept]]], self.mixed[kept], len(above.starts))

    def next_bit(self, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Estimated probability of each row's bit."""
        seen = np.where(self.bit, ones[self.number], zeros[self.number])
        return (seen + 0.5) / ((zeros + ones)[self.number] + 1.0)

    def follow(self, known: np.ndarray, open_: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The state of each row at this depth from that at the depth above.

        ``known``: probability of the row's bit by the nodes so far; ``open_``: weight of those
        below; ``final``: the probability if no node follows.
        """
        stop, kept = self.stop[self.number], self.depth.kept
        seen = np.where(kept, known + open_ * stop * self.next_bit(self.zeros, self.ones), known)
        left = np.where(kept, open_ * (1 - stop), open_)
        return seen, left, np.where(kept, seen + left * self.next_bit(*self.rests), final)


class Subtrees:
    """All rows below some contexts of length ``top``, from rows of contexts of length ``depth``."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int, top: int, least: float):
        self.depths = [Depth(keys, n, least)]
        for _ in range(depth - top):
            self.depths.append(self.depths[-1].shorter(least))

    def weighed(self, bit: int) -> list[Level]:
        """The decisions on a bit, from the longest contexts to the shortest."""
        levels = [d.level(bit) for d in self.depths]
        below = None
        for level, above in zip(levels, [*levels[1:], None]):
            level.weigh(below)
            below = level.gathered(above) if above else None
        return levels

    def summary(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """What the contexts one byte shorter than ``top`` need: sums per decision, and counts per row, all and those in nodes."""
        last = self.depths[-1]
        keys, sums = [], []
        for bit in range(8):
            level = self.weighed(bit)[-1]
            at = level.starts[last.kept[level.starts]]
            keys.append(last.keys[at] >> 16 << 8 | 1 << bit | (last.keys[at] & 255) >> (8 - bit))
            sums.append(level.mixed[last.kept[level.starts]])
        decisions, at = np.unique(np.concatenate(keys), return_inverse=True)
        rows, up = np.unique(last.keys >> 16 << 8 | last.keys & 255, return_inverse=True)
        counts = [np.bincount(up, n, len(rows)).astype(np.int64) for n in (last.n, np.where(last.kept, last.n, 0))]
        return (decisions, np.bincount(at, np.concatenate(sums), len(decisions))), (rows, *counts)

    def log_p(self, rows: np.ndarray, states: np.ndarray) -> np.ndarray:
        """Natural logarithm of each byte's probability; ``states`` are those of ``rows``, the contexts one byte shorter than ``top``."""
        last = self.depths[-1]
        at = np.searchsorted(rows, last.keys >> 16 << 8 | last.keys & 255)
        out = np.zeros(len(self.depths[0].keys))
        for bit in range(8):
            levels = self.weighed(bit)[::-1]
            state = levels[0].follow(*states[bit][:, at])
            for level in levels[1:]:
                state = level.follow(*[s[level.depth.up] for s in state])
            out += np.log(state[2])
        return out


def top_states(decisions: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """States of the rows of the one-byte contexts after all decisions from the root on, from the summaries of all subtrees of two bytes."""
    keys, n, below = rows
    one = Depth(keys, n, least)
    one.has(below)
    root = one.shorter(least)
    root.kept[:] = True
    out = np.zeros((8, 3, len(keys)))
    for bit in range(8):
        level, above = one.level(bit), root.level(bit)
        first = keys[level.starts]
        wanted = first >> 8 << 8 | 1 << bit | (first & 255) >> (8 - bit)
        at = np.minimum(np.searchsorted(decisions[0], wanted), len(decisions[0]) - 1)
        level.weigh(np.where(decisions[0][at] == wanted, decisions[1][at], 0.0))
        above.weigh(level.gathered(above))
        start = np.zeros(len(root.keys)), np.ones(len(root.keys)), np.full(len(root.keys), 0.5)
        out[bit] = level.follow(*[s[one.up] for s in above.follow(*start)])
    return out
