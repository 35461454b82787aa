"""Counting quotient filters over packed n-grams of word ids.

An n-gram is ``n`` ids of 32 bits. A keyed Feistel permutation of those limbs mixes it
invertibly; the top ``bits`` bits of the result are its quotient, all the others its remainder.
Since the permutation can be undone and the remainder is kept in full, the filter is lossless.
It is held as the number of entries per quotient, the remainders in sorted order, and a counter
of one byte each, with larger counts aside.
"""

from __future__ import annotations

import numpy as np

LIMB = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)
#: Odd multipliers of the round function: fixed values.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: A counter of one byte; this value says that the count stands aside.
ASIDE = 255


def _round(limbs: np.ndarray, skip: int, number: int) -> np.ndarray:
    """32 bits made of all limbs but one."""
    state = np.full(limbs.shape[1], number + 1, np.uint64) * MIX[1]
    for i in range(len(limbs)):
        if i != skip:
            state = (state ^ limbs[i]) * MIX[0]
            state ^= state >> np.uint64(29)
    return state * MIX[1] >> LIMB


def permuted(limbs: np.ndarray) -> np.ndarray:
    """``limbs`` (n rows of 32-bit values, n > 1), mixed; every limb takes part three times."""
    out = limbs.astype(np.uint64)
    for number in range(3 * len(out)):
        out[number % len(out)] ^= _round(out, number % len(out), number)
    return out


def restored(limbs: np.ndarray) -> np.ndarray:
    """The inverse of ``permuted``."""
    out = limbs.astype(np.uint64)
    for number in reversed(range(3 * len(out))):
        out[number % len(out)] ^= _round(out, number % len(out), number)
    return out


def _words(limbs: np.ndarray) -> list[np.ndarray]:
    """The limbs two by two as 64-bit words, most significant first; a last odd limb stands alone."""
    out = [limbs[i] << LIMB | limbs[i + 1] for i in range(0, len(limbs) - 1, 2)]
    return out + ([limbs[-1]] if len(limbs) % 2 else [])


def summed(limbs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed limbs in sorted order without repeats, and their added counts. Sorted stretches are merged, not sorted anew."""
    if not limbs.shape[1]:
        return limbs, counts
    words = _words(limbs)
    order = np.argsort(words[0], kind="stable") if len(words) == 1 else np.lexsort(words[::-1])
    limbs, counts = limbs[:, order], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = (limbs[:, 1:] != limbs[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return limbs[:, at], np.add.reduceat(counts, at)


class CountingQuotientFilter:
    """Distinct mixed n-grams in sorted order, and how often each was added."""

    def __init__(self, limbs: np.ndarray, counts: np.ndarray):
        self.limbs, self.counts = limbs, counts

    @classmethod
    def of(cls, ids: np.ndarray) -> CountingQuotientFilter:
        """Of n-grams of ids, one per column; equal ones are counted."""
        mixed = permuted(ids)
        return cls(*summed(mixed, np.ones(mixed.shape[1], np.int64)))

    @classmethod
    def merged(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        return cls(*summed(np.concatenate([f.limbs for f in filters], axis=1), np.concatenate([f.counts for f in filters])))

    def ids(self) -> np.ndarray:
        """The n-grams themselves."""
        return restored(self.limbs)

    def parts(self, number: int) -> list[tuple[int, CountingQuotientFilter]]:
        """The filter cut into ``number`` equal ranges of quotients; empty ranges are left out."""
        of = self.limbs[0] * np.uint64(number) >> LIMB
        found, starts = np.unique(of, return_index=True)
        ends = [*starts[1:].tolist(), len(of)]
        return [(int(p), CountingQuotientFilter(self.limbs[:, a:b], self.counts[a:b])) for p, a, b in zip(found, starts.tolist(), ends)]

    def to_bytes(self) -> bytes:
        """Entries per quotient, remainders, counters, larger counts. A quotient has as many bits as the filter has entries."""
        n, m = self.limbs.shape
        low = int(self.limbs[0, 0]) if m else 0
        span = int(self.limbs[0, -1]) - low if m else 0
        bits = max(0, min(m.bit_length() - 1, 16))
        rest = max(0, span.bit_length() - bits)
        local = self.limbs[0] - np.uint64(low)
        runs = np.bincount((local >> np.uint64(rest)).astype(np.int64), minlength=1).astype("<u4")
        first = (local & np.uint64((1 << rest) - 1)).astype("<u4")
        kind = next(t for t, size in (("<u1", 8), ("<u2", 16), ("<u4", 33)) if rest <= size)
        small = np.minimum(self.counts, ASIDE).astype("u1")
        head = np.array([n, m, low, rest, len(runs)], "<u8")
        aside = self.counts[small == ASIDE].astype("<u8")
        return b"".join(a.tobytes() for a in (head, runs, first.astype(kind), self.limbs[1:].astype("<u4"), small, aside))

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        at = 0

        def take(kind: str, number: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, number, at)
            at += found.nbytes
            return found

        n, m, low, rest, quotients = (int(x) for x in take("<u8", 5))
        runs = take("<u4", quotients)
        first = take(next(t for t, size in (("<u1", 8), ("<u2", 16), ("<u4", 33)) if rest <= size), m).astype(np.uint64)
        high = np.repeat(np.arange(quotients, dtype=np.uint64), runs) << np.uint64(rest)
        others = take("<u4", (n - 1) * m).reshape(n - 1, m).astype(np.uint64)
        counts = take("u1", m).astype(np.int64)
        counts[counts == ASIDE] = take("<u8", int((counts == ASIDE).sum())).astype(np.int64)
        return cls(np.concatenate([[(high | first) + np.uint64(low)], others]), counts)
