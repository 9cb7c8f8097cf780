"""Minimal perfect hash over 128-bit keys: cascaded bit arrays, built and probed with whole numpy arrays.

On each level every remaining key takes a position of a bit array. Positions that one key alone takes get
their bit; the other keys go on to the next level. The slot of a key is the number of bits before its own, so
n keys fill exactly the slots 0 to n - 1. A key outside the set may reach any slot or none: callers keep a
fingerprint or the key itself in the slot and compare.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
LEVELS = 64


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a + b * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) % np.uint64(size)


def build(a: np.ndarray, b: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes of the levels and the bits of all levels, for distinct keys (a, b) of unsigned 64-bit halves."""
    sizes, words = [], []
    while len(a):
        if len(sizes) == LEVELS:
            raise ValueError("a key occurs twice")
        size = -(-int(GAMMA * len(a)) // 64) * 64
        at = _place(a, b, len(sizes), size)
        alone = np.bincount(at.astype(np.int64), minlength=size)[at] == 1
        bits = np.zeros(size, np.uint8)
        bits[at[alone]] = 1
        sizes.append(size)
        words.append(np.packbits(bits, bitorder="little"))
        a, b = a[~alone], b[~alone]
    return sizes, b"".join(w.tobytes() for w in words)


class Slots:
    """Looks up the slots of keys."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = [int(s) for s in sizes]
        self.words = np.frombuffer(bits, "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its bit."""
        out = np.full(len(a), -1, np.int64)
        left, start = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _place(a[left], b[left], level, size) + np.uint64(start)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = self.words[word]
            found = (held >> bit) & np.uint64(1) == 1
            below = held & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            out[left[found]] = rank[found]
            left, start = left[~found], start + size
        return out


def unsigned(values) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.int64).view(np.uint64)
