"""Probabilities of words under a unigram vocabulary, over all their segmentations.

A word with the marker before it is a lattice: an edge for each piece that
matches somewhere, and for a character that is no piece, one over its bytes. The
forward recursion adds up all paths in log space, the backward one gives how
often each piece is expected. Both run over many words of similar length at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from cohortry.llm.pieces import BYTE, MARK, NORMAL, UNIGRAM, USER, parse

CELLS = 1 << 16  # characters of the words that are computed together
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _values(points: np.ndarray) -> np.ndarray:
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, a row each, zeros behind; and their lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    table = np.zeros((len(words), int(sizes.max())), np.uint32)
    table[np.arange(table.shape[1]) < sizes[:, None]] = flat
    return table, sizes


def _prefixes(table: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes."""
    out = np.zeros((table.shape[0], table.shape[1] + 1), np.uint64)
    values = _values(table)
    for j in range(table.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + values[:, j]
    return out


@dataclass(frozen=True)
class Block:
    """Words of one block: which they are, their lengths, and for each end and length of a piece its number or -1."""

    rows: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray
    foreign: list[str]


class Lattice:
    """The pieces of a model file, found by hash and confirmed by their characters.

    Numbers of pieces: those that may stand in a word, then 256 bytes, then the
    end of a text. Foreign characters of a block are numbered behind those.
    """

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            model = parse(file.read())
        # No piece may reach across words.
        kept = [(p, s) for p, s, kind in model.pieces if kind in (NORMAL, USER) and p and MARK not in p[1:]]
        self.pieces = [p for p, _ in kept]
        self.longest = max(map(len, self.pieces), default=1)
        self.bytes_at, self.end = len(kept), len(kept) + 256
        self.first = self._first(model.kind, np.array([s for _, s in kept]))
        table, sizes = _points(self.pieces) if kept else (np.zeros((0, 1), np.uint32), np.zeros(0, np.int64))
        hashes = _prefixes(table)[np.arange(len(kept)), sizes]
        order = np.argsort(hashes)
        self._hashes, self._ids, self._table = hashes[order], order, np.pad(table, ((0, 0), (0, max(0, self.longest - table.shape[1]))))
        self._may = np.zeros(1 << 20, bool)
        self._may[hashes >> np.uint64(44)] = True
        self._powers = _BASE ** np.arange(self.longest + 1, dtype=np.uint64)

    def _first(self, kind: int, scores: np.ndarray) -> np.ndarray:
        """Log weights from the file's scores: log probabilities of a unigram model, else ranks, taken by Zipf's law."""
        weights = np.full(self.end + 1, 1.0 / (len(scores) + 257))
        if kind == UNIGRAM:
            weights[:len(scores)] = np.exp(scores)
        else:
            weights[np.argsort(-scores, kind="stable")] = 1.0 / np.arange(1, len(scores) + 1)
        return np.log(weights / weights.sum())

    def _lookup(self, hashes: np.ndarray, points: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for none; points and begins: where each candidate stands."""
        found = np.full(hashes.shape, -1, np.int32)
        rows, cols = np.nonzero(self._may[hashes >> np.uint64(44)])
        if len(rows) and len(self._hashes):
            wanted = hashes[rows, cols]
            at = np.minimum(np.searchsorted(self._hashes, wanted), len(self._hashes) - 1)
            same = self._hashes[at] == wanted
            rows, cols, ids = rows[same], cols[same], self._ids[at[same]]
            for k in range(self.longest):  # each character of a match
                on = k <= cols
                bad = np.zeros(len(rows), bool)
                bad[on] = points[rows[on], begins[cols[on]] + k] != self._table[ids[on], k]
                if bad.any():
                    rows, cols, ids = rows[~bad], cols[~bad], ids[~bad]
            found[rows, cols] = ids
        return found

    def blocks(self, words: list[str]) -> Iterator[Block]:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            ahead = sizes[order[at:at + CELLS]] * np.arange(1, min(CELLS, len(order) - at) + 1)
            stop = at + max(1, int(np.searchsorted(ahead, CELLS, "right")))
            rows = order[at:stop]
            yield self._block(rows, [MARK + words[i] for i in rows])
            at = stop

    def _block(self, rows: np.ndarray, words: list[str]) -> Block:
        points, sizes = _points(words)
        hashes = _prefixes(points)
        width = points.shape[1]
        ids = np.full((width, len(words), min(self.longest, width)), -1, np.int32)
        for j in range(1, width + 1):
            begins = np.arange(j - 1, max(-1, j - 1 - self.longest), -1)
            own = hashes[:, j, None] - hashes[:, begins] * self._powers[1:len(begins) + 1]
            ids[j - 1, :, :len(begins)] = self._lookup(own, points, begins)
        lone = ids[:, :, 0].T < 0
        foreign, place = np.unique(points[lone], return_inverse=True)
        ids[:, :, 0].T[lone] = self.end + 1 + place.ravel()
        return Block(rows, sizes, ids, [chr(c) for c in foreign])

    def extended(self, weights: np.ndarray, foreign: list[str]) -> np.ndarray:
        """Weights with those of foreign characters, the sums of their bytes', and minus infinity for no piece."""
        more = [sum(weights[self.bytes_at + b] for b in c.encode("utf-8", "surrogatepass")) for c in foreign]
        return np.concatenate([weights, np.array(more, float), [-np.inf]])

    def forward(self, block: Block, weights: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations of each prefix."""
        width, n, longest = block.ids.shape
        alpha = np.full((n, width + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, width + 1):
            begins = np.arange(j - 1, max(-1, j - 1 - longest), -1)
            paths = alpha[:, begins] + weights[block.ids[j - 1, :, :len(begins)]]
            most = paths.max(axis=1)
            alpha[:, j] = most + np.log(np.exp(paths - most[:, None]).sum(axis=1))
        return alpha

    def log_words(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """Natural logarithms of the words' probabilities."""
        out = np.zeros(len(words))
        for block in self.blocks(words):
            alpha = self.forward(block, self.extended(weights, block.foreign))
            out[block.rows] = alpha[np.arange(len(block.rows)), block.sizes]
        return out

    def expected(self, words: list[str], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """How often each piece occurs in so many of these words, over all segmentations by their weights."""
        total = np.zeros(self.end + 1)
        for block in self.blocks(words):
            wide = self.extended(weights, block.foreign)
            alpha = self.forward(block, wide)
            width, n, longest = block.ids.shape
            each = np.arange(n)
            all_, times = alpha[each, block.sizes], counts[block.rows]
            beta = np.full((n, width + 1), -np.inf)
            beta[each, block.sizes] = 0
            sums = np.zeros(len(wide))
            for j in range(width, 0, -1):
                begins = np.arange(j - 1, max(-1, j - 1 - longest), -1)
                ids = block.ids[j - 1, :, :len(begins)]
                after = wide[ids] + beta[:, j, None]
                share = np.exp(alpha[:, begins] + after - all_[:, None]) * times[:, None]
                sums += np.bincount(ids.ravel() % len(wide), share.ravel(), len(wide))
                beta[:, begins] = np.logaddexp(beta[:, begins], after)
            total += sums[:self.end + 1]
            for c, s in zip(block.foreign, sums[self.end + 1:-1], strict=True):
                for b in c.encode("utf-8", "surrogatepass"):
                    total[self.bytes_at + b] += s
        return total


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """One for each worker and file."""
    return Lattice(path)
