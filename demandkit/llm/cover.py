"""Hashes of byte strings at all places of a text, and its content-defined cover sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from demandkit.llm.words import GOLDEN, mix

_INDEX = np.arange(256, dtype=np.uint64)
#: Two tables of byte values and two odd bases, from the mixing function.
TABLES = (mix(_INDEX + GOLDEN), mix((_INDEX + np.uint64(256)) * GOLDEN))
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Window starts that are handled at once; places within a block take 24 bits.
BLOCK = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


class Powers:
    """Powers of a base and of its inverse, modulo 2^64."""

    def __init__(self, base: int, n: int):
        self.up, self.down = (np.full(n + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.cumprod(powers, out=powers)


_POWERS: list[Powers] = []


class Strings:
    """Hashes of any substrings of some bytes."""

    def __init__(self, data: np.ndarray):
        if not _POWERS or len(_POWERS[0].up) <= len(data):
            n = max(2 * BLOCK, len(data))
            _POWERS[:] = [Powers(b, n) for b in BASES]
        self.sums = [
            np.concatenate([np.zeros(1, np.uint64), np.cumsum(t[data] * p.up[: len(data)], dtype=np.uint64)])
            for t, p in zip(TABLES, _POWERS, strict=True)
        ]

    def hash(self, begin: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
        s = self.sums[kind]
        return mix((s[end] - s[begin]) * _POWERS[kind].down[begin] + (end - begin).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def blocks(ends: np.ndarray, size: int, length: int) -> Iterator[tuple[int, int]]:
    """Byte ranges that hold all strings of ``length`` that start in a block."""
    for begin in range(0, size, BLOCK):
        yield begin, min(size, begin + BLOCK + length)


def intervals(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Strings]:
    """First and last start, and cover place, of runs of ``length``-byte strings with one cover place.

    ``ends`` has the end of the text that each byte belongs to. The cover place of a
    string is that of its ``gram``-byte substring with the least hash (the first of equal
    ones), so equal strings have it at equal offsets, wherever they are.
    """
    n = len(data)
    strings = Strings(data)
    starts = np.arange(max(0, n - gram + 1))
    packed = strings.hash(starts, starts + gram) & ~_PLACE
    packed |= starts.astype(np.uint64)
    owner = _least(packed, length - gram + 1) & _PLACE if n >= length else np.zeros(0, np.uint64)
    owner = owner.astype(np.int64)
    at = np.arange(len(owner))
    valid = at + length <= ends[: len(owner)]
    at, owner = at[valid], owner[valid]
    if not len(at):
        return at, at, at, strings
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner) != 0))
    return at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])], owner[np.concatenate([[0], cut + 1])], strings
