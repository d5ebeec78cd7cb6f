"""Packing token ids into sequences by multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.tokens import byte_level, encoded


@dataclass(frozen=True)
class PackSpec:
    """window: tokens of a sequence. end_id follows each document.

    batch: remainders that are packed together, in pieces of at most `longest`
    tokens. waste: share of padding in a batch, beyond one window, above which
    pieces are halved, down to `shortest` tokens.
    """

    tokenizer: str
    window: int = 1024
    end_id: int = 0
    batch: int = 1024
    longest: int = 256
    waste: float = 0.01
    shortest: int = 64


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest differencing into so many windows: each item's window, and the windows' sums.

    A partial partition is its windows' sums in ascending order, those that are
    zero left out. The two partitions whose sums differ most are merged, the
    fullest window of one with the emptiest of the other, and what all windows
    have in common is taken off, until one partition is left. Merged windows
    are the nodes of a forest whose leaves are items.
    """
    n = len(sizes)
    parent = np.arange(4 * n, dtype=np.int64)
    fresh = n
    sums: list = [np.array([s], np.int64) for s in sizes]
    nodes: list = [np.array([i], np.int64) for i in range(n)]
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = len(sums[a]) + len(sums[b]) - windows
        if both <= 0:
            joined, kept = np.concatenate([sums[a], sums[b]]), np.concatenate([nodes[a], nodes[b]])
        else:
            # The emptiest `both` windows of each meet, in opposite order.
            x, y = nodes[a][:both], nodes[b][:both][::-1]
            if fresh + both > len(parent):
                parent = np.concatenate([parent, np.arange(len(parent), 2 * len(parent) + both, dtype=np.int64)])
            met = np.arange(fresh, fresh + both)
            fresh += both
            parent[x], parent[y] = met, met
            joined = np.concatenate([sums[a][:both] + sums[b][:both][::-1], sums[a][both:], sums[b][both:]])
            kept = np.concatenate([met, nodes[a][both:], nodes[b][both:]])
        order = np.argsort(joined, kind="stable")
        joined, kept = joined[order], kept[order]
        spread = int(joined[-1]) - (int(joined[0]) if len(joined) == windows else 0)
        sums[a], nodes[a], sums[b], nodes[b] = joined, kept, None, None
        heapq.heappush(heap, (-spread, a))
    last = heap[0][1]
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            break
        parent = above
    rank = np.full(len(parent), -1, np.int64)
    rank[nodes[last]] = np.arange(len(nodes[last]))
    return rank[parent[:n]], sums[last]


def windows_of(sizes: np.ndarray, window: int) -> np.ndarray:
    """Each item's window, near-equal; the number of windows rises while one is too full."""
    count = max(1, -(-int(sizes.sum()) // window))
    while True:
        part, sums = differenced(sizes, count)
        over = int(sums[-1]) - window
        if over <= 0:
            return part
        # Every window gets so much emptier by `step` more of them.
        count += max(1, over * count // (2 * window))


def padding(length: int, window: int) -> int:
    return 0 if length & (length - 1) == 0 else window - length


def packed(sizes: np.ndarray, spec: PackSpec) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Pieces (item, begin, length) of items below the window, and each piece's window.

    Items are cut at `longest`, and at half of it again while that leaves too
    much padding.
    """
    best, longest = None, spec.longest
    while True:
        pieces = [
            (i, at, min(longest, size - at)) for i, size in enumerate(sizes.tolist()) for at in range(0, size, longest)
        ]
        lengths = np.array([p[2] for p in pieces], np.int64)
        part = windows_of(lengths, spec.window)
        lost = sum(padding(int(s), spec.window) for s in np.bincount(part, lengths))
        if best is None or lost < best[0]:
            best = lost, pieces, part
        if best[0] <= spec.waste * float(sizes.sum()) + spec.window or longest // 2 < spec.shortest:
            return best[1], best[2]
        longest //= 2


KINDS = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
COLUMNS = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _pack_partition(spec: PackSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_level(spec.tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens) below a window

        def full() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), KINDS, strict=True)], schema=KINDS)
            rows.clear()
            return out

        def place() -> None:
            nonlocal sequence
            pieces, part = packed(np.array([len(w[2]) for w in waiting], np.int64), spec)
            filled = [0] * (int(part.max()) + 1)
            for (i, begin, size), window in zip(pieces, part.tolist(), strict=True):
                doc_id, start, ids, total = waiting[i]
                body = ids[begin:begin + size].tobytes()
                rows.append((doc_id, start + begin, size, body, total, sequence + window, filled[window]))
                filled[window] += size
            sequence += len(filled)
            waiting.clear()

        for batch in batches:
            for doc_id, ids in encoded(batch, encoder):
                ids = np.append(ids, np.uint32(spec.end_id)).astype("<u4")
                whole = len(ids) // spec.window * spec.window
                for at in range(0, whole, spec.window):
                    rows.append((doc_id, at, spec.window, ids[at:at + spec.window].tobytes(), len(ids), sequence, 0))
                    sequence += 1
                if whole < len(ids):
                    waiting.append((doc_id, whole, ids[whole:], len(ids)))
                if len(waiting) == spec.batch:
                    place()
                if len(rows) >= 4096:
                    yield full()
        if waiting:
            place()
        if rows:
            yield full()

    return run


def pack(docs: DataFrame, spec: PackSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    A document is its text's ids and the end id. Its full windows are sequences
    of their own; what remains is packed with other remainders of the same
    partition, so nothing is shuffled and a lost task repeats alike. ids are
    little-endian unsigned 32-bit numbers. A text that is null or empty is the
    end id alone; a null doc_id stays null; repeated rows are packed each for
    itself. Other columns aren't read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pack_partition(spec), COLUMNS)
