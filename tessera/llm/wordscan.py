"""Words (runs of letters) of whole texts, found by array passes over code points."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from tessera.llm.common import code_points


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(is a letter, lower case) of every code point."""
    letter, lower = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            letter[c] = True
            low = x.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return letter, lower


@dataclass
class Words:
    """Letters of all texts one after the other, and the words that they make."""

    low: np.ndarray  #: each letter, lower case
    before: np.ndarray  #: the letter before it in its word, else 0
    after: np.ndarray  #: the letter after it in its word, else 0
    first: np.ndarray  #: place of each word's first letter among the letters
    length: np.ndarray  #: letters of each word
    start: np.ndarray  #: each word's first code point in its text
    counts: np.ndarray  #: words of each text

    @property
    def end(self) -> np.ndarray:
        return self.start + self.length


def words(array: pa.Array) -> Words:
    letter_of, lower_of = _tables()
    points, offsets = code_points(array)
    letter = letter_of[points]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inner = offsets[:-1]
    inner = inner[inner < len(points)]
    begins[inner] = letter[inner]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    at = np.flatnonzero(letter)
    low = lower_of[points[at]]
    first = np.searchsorted(at, starts)
    length = np.diff(np.append(first, len(at)))
    before, after = np.zeros_like(low), np.zeros_like(low)
    before[1:] = low[:-1]
    before[first] = 0
    after[:-1] = low[1:]
    after[first + length - 1] = 0
    return Words(low, before, after, first, length, starts - np.repeat(offsets[:-1], counts), counts)


def bucket(bits: int, *parts: np.ndarray) -> np.ndarray:
    """A hash of aligned code point arrays, ``bits`` wide."""
    h = np.zeros(len(parts[0]), np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return (h * np.uint32(0x85EBCA77) >> np.uint32(32 - bits)).astype(np.int64)
