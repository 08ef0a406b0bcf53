"""Maximal repeats of a set of strings from an enhanced suffix array.

Only suffixes that can start a repeat of ``least`` bytes are sorted: those whose first ``least``
bytes occur again, in a class of equal beginnings whose members are not all preceded by the same
byte (else every repeat in it extends to the left and is found there). The sorted suffixes and the
common prefixes of neighbours give the tree of common-prefix intervals by one scan with a stack; an
interval whose members differ in the byte before them is a maximal repeat, and its members are all
its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of suffixes that are laid out at once.
CELLS = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Hashed:
    """Hashes of any substring of a byte string in constant time."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


class Strings:
    """Strings in buckets; a suffix of string i may start anywhere in first[i] <= s <= last[i].

    Strings may be overlapping parts of a text: string i is what begins at ``offset[i]`` of
    ``text[i]``. One place of a text is one occurrence, whatever strings show it.
    """

    def __init__(
        self,
        strings: list[bytes],
        bucket: np.ndarray,
        first: np.ndarray,
        last: np.ndarray,
        text: np.ndarray,
        offset: np.ndarray,
    ):
        self.text, self.offset = text, offset
        self.size = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(strings), np.uint8)
        self.bucket, self.first, self.last = bucket, first, last

    def repeats(self, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Maximal repeats: length, strings and starts of all occurrences."""
        last = np.minimum(self.last, self.size - least)
        count = np.maximum(last - self.first + 1, 0)
        owner = np.repeat(np.arange(len(count)), count)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start += self.first[owner]
        at = self.begin[owner] + start
        key = Hashed(self.raw).of(at, at + least)
        key ^= mix(self.bucket.astype(np.uint64) + np.uint64(1))[owner]
        order = np.argsort(key, kind="stable")
        order = order[_shared(key[order])]
        if not len(order):
            return
        # In a class by place, and of several strings that show a place the one that goes furthest.
        held = owner[order]
        place = (self.text[held] << 40) + self.offset[held] + start[order]
        order = order[np.lexsort((start[order] - self.size[held], place, key[order]))]
        held = owner[order]
        place = (self.text[held] << 40) + self.offset[held] + start[order]
        new = np.r_[True, (place[1:] != place[:-1]) | (key[order][1:] != key[order][:-1])]
        order = order[new]
        order = order[_shared(key[order])]
        if not len(order):
            return
        heads = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        sizes = np.diff(np.r_[heads, len(order)])
        before = self.raw[np.maximum(at - 1, 0)].astype(np.int16)
        before[start == self.first[owner]] = -1
        ordered = before[order]
        low, high = np.minimum.reduceat(ordered, heads), np.maximum.reduceat(ordered, heads)
        wanted = (low < 0) | (low != high)
        kept = order[np.repeat(wanted, sizes)]
        if len(kept):
            group = np.repeat(np.arange(wanted.sum()), sizes[wanted])
            yield from self._scan(kept, group, owner, start, before, least)

    def _scan(self, suffix, group, owner, start, before, least):
        """Sort the suffixes of each group by what follows, then scan their common prefixes."""
        rest = self.size[owner[suffix]] - start[suffix] - least
        width = -(-int(rest.max()) // 8) * 8
        at = self.begin[owner[suffix]] + start[suffix] + least
        where = np.arange(width)
        after = np.zeros((len(suffix), width), np.uint8)
        step = max(1, CELLS // max(width, 1))
        for i in range(0, len(suffix) if width else 0, step):
            rows = slice(i, i + step)
            inside = where < rest[rows, None]
            after[rows][inside] = self.raw[(at[rows, None] + where)[inside]]
        words = np.ascontiguousarray(after).view(">u8") if width else after
        order = np.lexsort((rest, *(words[:, i] for i in reversed(range(words.shape[1]))), group))
        suffix, group, rest, after = suffix[order], group[order], rest[order], after[order]
        differ = after[1:] != after[:-1]
        shared = np.where(differ.any(1), differ.argmax(1), width) if width else np.zeros(len(differ))
        common = least + np.minimum(shared, np.minimum(rest[1:], rest[:-1])).astype(np.int64)
        common[group[1:] != group[:-1]] = 0
        owner, start = owner[suffix], start[suffix]
        for length, lo, hi in intervals(common.tolist(), before[suffix].tolist()):
            yield length, owner[lo:hi], start[lo:hi]


def _shared(ordered: np.ndarray) -> np.ndarray:
    """Which of the ordered values occur more than once."""
    same = np.zeros(len(ordered) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    return same[1:] | same[:-1]


def intervals(common: list[int], before: list[int]) -> Iterator[tuple[int, int, int]]:
    """Left-diverse common-prefix intervals (length, first, end) of sorted suffixes.

    ``common[i]`` is shared by suffixes i and i + 1; ``before`` is the byte before a suffix, or -1
    where there is none. Inner intervals come before those that hold them.
    """
    stack: list[list[int]] = []  # length, first, and the byte that all have before, or -1
    for i, now in enumerate([*common, 0]):
        first, byte = i, before[i]
        while stack and stack[-1][0] > now:
            length, lo, same = stack.pop()
            same = same if same == byte else -1
            if same < 0:
                yield length, lo, i + 1
            first, byte = lo, same
        if now:
            if stack and stack[-1][0] == now:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else -1
            else:
                stack.append([now, first, byte])


def maximal_repeats(strings: list[bytes], least: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """All maximal repeats of at least ``least`` bytes, each with all its (string, start)."""
    zero = np.zeros(len(strings), np.int64)
    each = np.arange(len(strings))
    found = Strings(strings, zero, zero, zero + (1 << 40), each, zero).repeats(least)
    return [(n, sorted(zip(o.tolist(), s.tolist(), strict=True))) for n, o, s in found]
