"""Word shingles as 64-bit numbers, for many texts at once in arrays.

A word's number is a polynomial of its bytes modulo 2**64, each byte first replaced by a
random 64-bit number (A-Z as a-z); prefix sums give the numbers of all words of a chunk
without a loop. A shingle's number mixes those of its words in order.
"""

from __future__ import annotations

import numpy as np

SPACES = (0x20, *range(0x09, 0x0E))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[0x41:0x5B] = BYTE[0x61:0x7B]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Polynomial:
    """Numbers of substrings from prefix sums; powers are kept for the longest chunk so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            n = max(len(data) + 1, 1 << 20)
            self.up, self.down = powers(BASE, n), powers(inverse, n)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE[data] * self.up[: len(data)], out=out[1:])
        return out

    def numbers(self, prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def chunk_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a line feed after each, and where each text begins (one more at the end)."""
    raw = [t.encode() for t in texts]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    return np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8), begins


def word_numbers(texts: list[str], polynomial: Polynomial) -> tuple[np.ndarray, np.ndarray]:
    """All words' numbers, and the first word of each text (one more at the end)."""
    data, begins = chunk_of(texts)
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return polynomial.numbers(polynomial.prefix(data), begin, end), np.searchsorted(begin, begins)


def shingle_sets(texts: list[str], words: int, polynomial: Polynomial) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; a text with fewer words has its whole sequence."""
    numbers, first = word_numbers(texts, polynomial)
    n = len(numbers)
    rolled = np.zeros(n, np.uint64)
    step = np.uint64(0xD6E8FEB86659FD93)
    for k in range(words):
        rolled[: n - k] = rolled[: n - k] * step + numbers[k:]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for value in numbers[a:b]:
                    whole = whole * step + value
            out.append(mix(np.array([whole ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
