"""Words and shingles of whole texts as 64-bit hashes, many texts at a time.

A word is a run of bytes other than the six ASCII white-space characters, with
A-Z lower-cased. Every byte of a word has a place value, so that one sum over
bytes hashes all words of a block; bits are mixed before words are combined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
BLOCK = 1 << 20  # bytes hashed together; longer texts take several blocks

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_VALUE[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xD6E8FEB86659FD93) ** np.arange(SHINGLE + 1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of raw bytes, and each word's first byte; begins: where texts begin."""
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    own = begins[begins < len(raw)]
    first[own] = ~space[own]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = np.diff(starts, append=len(raw))
    offset = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    return mix(np.add.reduceat(_VALUE[raw[starts[0]:]] * powers[offset], starts - starts[0])), starts


def _pieces(raw: np.ndarray, offsets: np.ndarray):
    """(first text, begins, bytes) of blocks; a long text is cut at white space."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1
        if end > at:
            end = min(end, n)
            yield at, offsets[at:end] - offsets[at], raw[offsets[at]:offsets[end]]
            at = end
            continue
        low, high = offsets[at], offsets[at + 1]
        while low < high:
            cut = min(low + BLOCK, high)
            while cut < high and not _SPACE[raw[cut]]:
                cut += 1
            yield at, np.zeros(1, np.int64), raw[low:cut]
            low = cut
        at += 1


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (n + 1 numbers)."""
    n = len(texts)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    hashes, counts = [], np.zeros(n, np.int64)
    for at, begins, block in _pieces(raw, offsets):
        got, starts = _block(block, begins)
        hashes.append(got)
        owner = np.searchsorted(begins, starts, "right") - 1
        counts[at:at + len(begins)] += np.bincount(owner, minlength=len(begins))
    all_words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return all_words, np.concatenate([[0], np.cumsum(counts)])


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted non-negative 63-bit numbers.

    Fewer words than a shingle has: the whole sequence is the one shingle. No
    words: an empty set.
    """
    hashes, bounds = words(texts)
    rolled = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE if len(rolled) else 0):
        rolled += hashes[k:len(hashes) - SHINGLE + 1 + k] * _PLACE[k]
    rolled = (mix(rolled) >> np.uint64(1)).astype(np.int64)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        size = high - low
        if size >= SHINGLE:
            sets.append(np.unique(rolled[low:high - SHINGLE + 1]))
        elif size:
            whole = (hashes[low:high] * _PLACE[:size]).sum(keepdims=True) + _PLACE[-1:] * np.uint64(size)
            sets.append((mix(whole) >> np.uint64(1)).astype(np.int64))
        else:
            sets.append(np.empty(0, np.int64))
    return sets
