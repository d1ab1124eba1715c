"""Word shingle sets of whole texts, as 64-bit hashes computed by array passes over UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm.common import mix64, utf8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWER = np.uint64(0x5851F42D4C957F2D)


def words(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text); words are lower-cased in A-Z, split at ASCII space."""
    data, offsets = utf8(array)
    letter = ~_SPACE[data]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = letter[inner]  # a text's first letter begins a word, whatever the text before ends with
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    at = np.flatnonzero(letter)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _POWER, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    value = (_LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix64(np.add.reduceat(value, first) + lengths.astype(np.uint64)), counts


def sets(array: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, set sizes): each text's distinct ``size``-word shingles, ascending; a shorter text is one shingle."""
    hashes, counts = words(array)
    out, sizes = [], np.zeros(len(counts), np.int64)
    ends = np.cumsum(counts)
    joined = np.zeros(0, np.uint64)
    if len(hashes) >= size:
        n = len(hashes) - size + 1
        joined = hashes[:n].copy()
        for k in range(1, size):
            joined = mix64(joined * np.uint64(31) + hashes[k : k + n])
    for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
        if not n:
            continue
        if n < size:
            short = np.uint64(n)
            with np.errstate(over="ignore"):
                for h in hashes[end - n : end]:
                    short = mix64(np.array([short * np.uint64(31) + h]))[0]
            found = np.array([short], np.uint64)
        else:
            found = np.sort(joined[end - n : end - size + 1])
            if len(found) > 1:
                found = found[np.append(True, found[1:] != found[:-1])]
        out.append(found)
        sizes[i] = len(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def digests(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for each set."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    sums = []
    for salt in (np.uint64(0x1234567), np.uint64(0x89ABCDEF01)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ salt))])
        sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return sums[0], sums[1]
