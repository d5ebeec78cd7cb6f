"""Language-model scores: the marginal probability of a text over all its segmentations.

A text is its words, each with the marker before it, and one end. No piece
reaches across words, so the sum over all segmentations of a text is the product
of the sums of its words, and each different word is computed once. The pieces
and their first weights are those of a vocabulary file; the weights are then
estimated anew from all words of the training documents, by expected counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry.functions.scale import materialized
from cohortry.llm.codes import Codes, slices
from cohortry.llm.lattice import lattice

UNIT = 1 << 16  # expected counts are added up as whole numbers of such parts


@dataclass(frozen=True)
class ScoreSpec:
    """vocabulary: a model file of pieces. rounds: of estimation. prior: how many
    counts the file's weights are worth. chunk, words: of a chunk at most, all and
    different ones, unless one document has more."""

    vocabulary: str
    rounds: int = 2
    prior: float = 32000.0
    chunk: int = 3_000_000
    words: int = 400_000
    folds: int = 7
    held_fold: int = 2


def held_out(doc_id: Column, spec: ScoreSpec) -> Column:
    """False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % spec.folds == spec.held_fold, F.lit(False))


CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("words", pa.list_(pa.string())), ("trained", pa.list_(pa.int64())), ("n_trained", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("codes", pa.binary()),
])
CHUNK_COLUMNS = (
    "chunk bigint, words array<string>, trained array<bigint>, n_trained bigint, doc_ids array<bigint>, held array<boolean>, "
    "sizes array<bigint>, codes binary"
)


def _encode(spec: ScoreSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, codes, parts, held = TaskContext.get().partitionId() << 32, Codes(), [], 0
        docs: list[tuple] = []

        def full() -> pa.RecordBatch:
            nonlocal chunk, codes, held
            flat = np.concatenate([np.empty(0, np.uint32), *parts])
            sizes = np.array([d[2] for d in docs], np.int64)
            trained = np.repeat(np.array([not d[1] for d in docs]), sizes)
            counts = np.bincount(flat[trained], minlength=len(codes))
            row = (
                chunk, [w.decode() for w in codes], counts, sum(not d[1] for d in docs), [d[0] for d in docs], [d[1] for d in docs],
                sizes, flat.tobytes(),
            )
            chunk, codes, held = chunk + 1, Codes(), 0
            parts.clear()
            docs.clear()
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, CHUNKS, strict=True)], schema=CHUNKS)

        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                size = 0
                for part in slices((text.as_py() or "").encode()):
                    words = part.lower().split()
                    parts.append(np.fromiter(map(codes.__getitem__, words), np.uint32, len(words)))
                    size += len(words)
                docs.append((doc_id, out, size))
                held += size
                if held >= spec.chunk or len(codes) >= spec.words or len(docs) >= 1 << 18:
                    yield full()
        if docs:
            yield full()

    return run


def _expected(spec: ScoreSpec, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = lattice(spec.vocabulary), np.zeros(len(weights))
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            total += own.expected(batch.column(0).to_pylist(), counts, weights)
        parts = np.round(total * UNIT).astype(np.int64)
        some = np.flatnonzero(parts)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(parts[some])], names=["piece", "parts"])

    return run


def fit(words: DataFrame, ends: int, spec: ScoreSpec) -> np.ndarray:
    """Log weights of pieces, bytes and the end, from words (word, c) and the number of training texts.

    A round's result is one number for each piece of the vocabulary; only those
    reach the driver, and sums of whole numbers don't depend on their order.
    """
    own = lattice(spec.vocabulary)
    weights = own.first
    for _ in range(spec.rounds):
        found = words.mapInArrow(_expected(spec, weights), "piece int, parts bigint").groupBy("piece").agg(F.sum("parts").alias("parts"))
        counts = spec.prior * np.exp(own.first)
        for row in found.collect():
            counts[row.piece] += row.parts / UNIT
        counts[own.end] += ends
        weights = np.log(counts / counts.sum())
    return weights


def _score(spec: ScoreSpec, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = lattice(spec.vocabulary), (None, 0.0)
        for batch in batches:
            words = batch.column(2).to_pylist()
            known = dict([last])
            fresh = list(dict.fromkeys(w for w in words if w not in known))
            known |= zip(fresh, own.log_words(fresh, weights).tolist(), strict=True)
            if words:
                last = words[-1], known[words[-1]]
            logs = pa.array([known[w] for w in words], pa.float64())
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(3), logs], names=["chunk", "pos", "c", "log_p"])

    return run


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])


def _add_up(tokens: int, types: int, ends: int, log_end: float):
    """Scores of the documents of one chunk, from what each of its words scores."""
    floor = tokens + types + 1

    def run(chunk: pa.Table, words: pa.Table) -> pa.Table:
        row = {name: chunk.column(name)[0] for name in ("doc_ids", "held", "sizes", "codes")}
        codes = np.frombuffer(row["codes"].as_py(), np.uint32)
        sizes = row["sizes"].values.to_numpy(zero_copy_only=False)
        place = words.column("pos").to_numpy()
        c, log_p = np.zeros(len(place), np.int64), np.zeros(len(place))
        c[place], log_p[place] = words.column("c").to_numpy(), words.column("log_p").to_numpy()
        log_base = np.array([math.log10((x + 1) / floor) for x in c.tolist()])
        stops = np.cumsum(sizes)
        base, score, known = np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
        # By document, so that no more arrays of a whole chunk's words are made.
        for k, (a, b) in enumerate(zip(stops - sizes, stops, strict=True)):
            own = codes[a:b]
            base[k], score[k], known[k] = log_base[own].sum(), log_p[own].sum(), np.count_nonzero(c[own])
        known += ends > 0
        return pa.table([
            row["doc_ids"].values, row["held"].values, pa.array(sizes + 1), pa.array(known), pa.array(np.full(len(sizes), tokens, np.int64)),
            pa.array(base + math.log10((ends + 1) / floor)), pa.array((score + log_end) / math.log(10)),
        ], schema=RESULT)

    return run


def scored(docs: DataFrame, spec: ScoreSpec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Words are runs of characters other than ASCII white space, A-Z lower-cased;
    every text has one end besides. base_score adds log10((c + 1) / (N + V + 1))
    of its tokens, counted in the training rows; score is the base-10 logarithm
    of the text's probability. A null or empty text is its end alone. A null id
    is trained on. Repeated rows count and come back each; a very long text is
    read whole, in slices; other columns aren't read. Without training rows N
    and V are 0 and the file's weights hold. An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col), spec).alias("held"), F.col(text_col).cast("string").alias("text"),
    )
    chunks = materialized(rows.mapInArrow(_encode(spec), CHUNK_COLUMNS))
    entries = F.posexplode(F.arrays_zip("words", "trained")).alias("pos", "entry")
    each = chunks.select("chunk", entries).select("chunk", "pos", "entry.words", "entry.trained")
    # A chunk has a word once, so the most frequent word has as many rows as there are chunks.
    own = W.partitionBy("words")
    counted = materialized(each.select(
        "chunk", "pos", F.col("words").alias("word"), F.sum("trained").over(own).alias("c"),
        (F.row_number().over(own.orderBy("chunk")) == 1).alias("once"),
    ))
    known = counted.where("once AND c > 0").select("word", "c")
    ends = chunks.agg(F.sum("n_trained")).first()[0] or 0
    total = known.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, types = (total.n or 0) + ends, total.v + (ends > 0)
    weights = fit(known, ends, spec)
    logs = counted.select("chunk", "pos", "word", "c").mapInArrow(_score(spec, weights), "chunk bigint, pos int, c bigint, log_p double")
    adding = _add_up(tokens, types, ends, float(weights[lattice(spec.vocabulary).end]))
    # What is grouped goes to Python whole: the words, the larger part of a chunk, stay away.
    texts = chunks.select("chunk", "doc_ids", "held", "sizes", "codes")
    return texts.groupBy("chunk").cogroup(logs.groupBy("chunk")).applyInArrow(
        adding, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
