"""Counting quotient filters of word-id n-grams: exact counters in little space.

An n-gram of ids with b bits each is one number of n * b bits, kept as a left
and a right half. An invertible permutation spreads these numbers evenly. The
top bits of the result are the quotient: they are not stored, but given by a bit
for each quotient that occurs and a bit for each entry that ends its quotient's
run. All other bits are the remainder, kept in full, so nothing is lost and the
n-gram can be computed back. Entries lie in the order of the permuted numbers;
filters with the same permutation are merged like sorted lists.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cohortry.llm.wordhash import mix

KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
ESCAPE = 255  # counters from here on take eight bytes more

FILTER = pa.schema([
    ("range", pa.int32()), ("chunk", pa.int64()), ("occupied", pa.binary()), ("ends", pa.binary()), ("left", pa.binary()),
    ("right", pa.binary()), ("counts", pa.binary()), ("large", pa.binary()),
])
FILTER_COLUMNS = (
    "range int, chunk bigint, occupied binary, ends binary, left binary, right binary, counts binary, large binary"
)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _planes(values: np.ndarray, bits: int) -> bytes:
    """The low bytes of numbers of so many bits."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :-(-bits // 8)]).tobytes()


def _numbers(raw: bytes, bits: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    width = -(-bits // 8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(n, width)
    return out.view("<u8").ravel().astype(np.uint64)


def in_order(left: np.ndarray, right: np.ndarray, right_bits: int, left_bits: int) -> np.ndarray:
    if left_bits + right_bits <= 64:
        return np.argsort((left << np.uint64(right_bits)) | right, kind="stable")
    return np.lexsort((right, left))


@dataclass(frozen=True)
class Layout:
    """n-grams of n ids of `bits` bits. Filters are cut by the top `range_bits` of the
    permuted number, so that one range of all filters is merged in one task."""

    n: int
    bits: int
    range_bits: int
    quotient_bits: int

    @property
    def left_bits(self) -> int:
        return self.bits * -(-self.n // 2)

    @property
    def right_bits(self) -> int:
        return self.bits * (self.n // 2)

    def permuted(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        half = -(-self.n // 2)
        left, right = (self._joined(part) for part in (words[:half], words[half:]))
        for k in range(0, 4, 2):
            left = left ^ (mix(right + np.uint64(KEYS[k])) & _mask(self.left_bits))
            right = right ^ (mix(left + np.uint64(KEYS[k + 1])) & _mask(self.right_bits))
        return left, right

    def inverse(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        for k in (2, 0):
            right = right ^ (mix(left + np.uint64(KEYS[k + 1])) & _mask(self.right_bits))
            left = left ^ (mix(right + np.uint64(KEYS[k])) & _mask(self.left_bits))
        return self._apart(left, -(-self.n // 2)) + self._apart(right, self.n // 2)

    def _joined(self, words: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(words[0]), np.uint64)
        for w in words:
            out = (out << np.uint64(self.bits)) | w.astype(np.uint64)
        return out

    def _apart(self, value: np.ndarray, n: int) -> list[np.ndarray]:
        return [(value >> np.uint64(self.bits * k)) & _mask(self.bits) for k in range(n - 1, -1, -1)]

    def ranges(self, left: np.ndarray) -> np.ndarray:
        return (left >> np.uint64(self.left_bits - self.range_bits)).astype(np.int64)

    def segments(self, chunk: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> list[tuple]:
        """One row for each range that has entries; entries come in order."""
        own = self.ranges(left)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]]) if len(own) else [0]
        quotient = (left >> np.uint64(self.left_bits - self.quotient_bits)).astype(np.int64)
        rest_bits, rows = self.left_bits - self.quotient_bits, []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            q = quotient[a:b] - (int(own[a]) << (self.quotient_bits - self.range_bits))
            occupied = np.zeros(1 << (self.quotient_bits - self.range_bits), bool)
            occupied[q] = True
            ends = np.append(q[1:] != q[:-1], True)
            big = counts[a:b] >= ESCAPE
            rows.append((
                int(own[a]), chunk, np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                _planes(left[a:b] & _mask(rest_bits), rest_bits), _planes(right[a:b], self.right_bits),
                np.minimum(counts[a:b], ESCAPE).astype(np.uint8).tobytes(), counts[a:b][big].astype("<i8").tobytes(),
            ))
        return rows

    def entries(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Permuted halves and counts of a segment's entries."""
        counts = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
        n = len(counts)
        counts[counts == ESCAPE] = np.frombuffer(row["large"], "<i8")
        size = 1 << (self.quotient_bits - self.range_bits)
        quotients = np.flatnonzero(np.unpackbits(np.frombuffer(row["occupied"], np.uint8), count=size))
        ends = np.unpackbits(np.frombuffer(row["ends"], np.uint8), count=n)
        run = np.cumsum(ends) - ends
        quotient = quotients[run] + (row["range"] << (self.quotient_bits - self.range_bits))
        rest_bits = self.left_bits - self.quotient_bits
        left = (quotient.astype(np.uint64) << np.uint64(rest_bits)) | _numbers(row["left"], rest_bits, n)
        return left, _numbers(row["right"], self.right_bits, n), counts

    def merged(self, filters: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Merge segments of one range: halves and summed counts of the distinct entries, and for each
        entry of the segments, one after another, which of these it is."""
        parts = [self.entries(row) for row in filters]
        left, right, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = in_order(left, right, self.right_bits, self.left_bits)
        left, right, counts = left[order], right[order], counts[order]
        first = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(first) - 1
        return left[first], right[first], np.add.reduceat(counts, np.flatnonzero(first)), which
