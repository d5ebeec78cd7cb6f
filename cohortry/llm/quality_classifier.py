"""Text quality by compression: which of two dictionaries suits a text better.

One zstandard dictionary is built from good labelled text, one from bad. A text
is compressed in short blocks with each; the difference of the sizes, divided
by the text's size, and the same of its worst block are calibrated to a
probability by logistic regression on labelled texts that no dictionary saw.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scale import drawn, hash_of, materialized


@dataclass(frozen=True)
class ClassifierSpec:
    """At most `rows` labelled texts of each class are used to fit, in hash order:
    even hashes for the dictionaries, of which at most `blocks` blocks, odd ones
    for calibration. The rest shapes the compression."""

    rows: int = 6000
    blocks: int = 4000
    block: int = 2048
    dictionary: int = 65536
    level: int = 3
    cutoff: float = 0.3


@dataclass(frozen=True)
class Model:
    """Dictionaries, and the log-odds as a weighted sum of the two measures."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float]
    spec: ClassifierSpec

    def measures(self) -> Callable[[str | None], tuple[float, float]]:
        spec = self.spec

        def packer(raw: bytes) -> zstandard.ZstdCompressor:
            entries = zstandard.ZstdCompressionDict(raw)
            entries.precompute_compress(level=spec.level)
            return zstandard.ZstdCompressor(level=spec.level, dict_data=entries, write_content_size=False, write_dict_id=False)

        good, bad = packer(self.good), packer(self.bad)

        def measure(text: str | None) -> tuple[float, float]:
            parts = cut(text, spec.block)
            gain = [len(bad.compress(p)) - len(good.compress(p)) for p in parts]
            sizes = [len(p) + 1 for p in parts]
            # A short rest of a text says little by itself.
            least = min(spec.block // 8, max(sizes))
            return sum(gain) / sum(sizes), min(g / n for g, n in zip(gain, sizes, strict=True) if n >= least)

        return measure


def cut(text: str | None, block: int) -> list[bytes]:
    raw = (text or "").encode()
    return [raw[i:i + block] for i in range(0, len(raw), block)] or [b""]


def _cut_rows(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts = cut(text.as_py(), block)
                yield pa.record_batch([pa.array([label] * len(parts), pa.int32()), pa.array(parts, pa.binary())], names=["label", "part"])

    return run


def _measure_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = model.measures()
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64())], names=["label", "whole", "worst"])

    return run


def _dictionary(parts: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few or too equal parts, the parts themselves."""
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:] or b"\n" * 8


def _calibrated(x: np.ndarray, y: np.ndarray, odds: float) -> tuple[float, float, float]:
    """Intercept and weights of a logistic regression with a weak prior; odds shift the intercept to the labels' own share."""
    if not len(y) or y.min() == y.max():
        return (float(odds), 60.0, 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w, prior = np.zeros(3), np.diag([1e-6, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + prior, z.T @ (y - p) - prior @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / scale
    return (float(w[0] - slopes @ mean + odds - np.log(y.sum() / (len(y) - y.sum()))), float(slopes[0]), float(slopes[1]))


def fit(docs: DataFrame, labels: DataFrame, spec: ClassifierSpec = ClassifierSpec(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from labels (doc_id, quality 0 or 1); rows with other labels or null ids aren't used.

    Without labelled text of both classes every text gets the same score.
    """
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")
    )
    shares = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen = [
        drawn(marked.where(F.col("label") == k), ["id"], 5, spec.rows, shares.get(k, 0)).withColumn("h", hash_of("id", seed=5))
        for k in (0, 1)
    ]
    # At most 2 * rows rows.
    sample = materialized(
        docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(chosen[0].union(chosen[1])), "id")
        .select("label", "text", "h", (F.pmod(F.conv(F.substring("h", 1, 4), 16, 10).cast("int"), F.lit(2)) == 0).alias("own"))
    )
    parts = sample.where("own").select("label", "text").mapInArrow(_cut_rows(spec.block), "label int, part binary")
    held = {k: [bytes(r.part) for r in parts.where(F.col("label") == k).orderBy(F.md5("part"), "part").limit(spec.blocks).collect()] for k in (0, 1)}
    blank = Model(_dictionary(held[1], spec.dictionary), _dictionary(held[0], spec.dictionary), (0.0, 0.0, 0.0), spec)
    rest = sample.where("NOT own").select("label", "text").mapInArrow(_measure_rows(blank), "label int, whole double, worst double").collect()
    odds = float(np.log((shares.get(1, 0) + 1) / (shares.get(0, 0) + 1)))
    x = np.array([(r.whole, r.worst) for r in rest]).reshape(-1, 2)
    weights = _calibrated(x, np.array([float(r.label) for r in rest]), odds)
    return Model(blank.good, blank.bad, weights if held[0] and held[1] else (odds, 0.0, 0.0), spec)


def score(model: Model, text: Column) -> Column:
    """The probability of label 1 of whole texts; a null text counts as empty."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        measure, (w0, w1, w2) = model.measures(), model.weights
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch]).reshape(-1, 2)
            yield pa.array(1 / (1 + np.exp(-np.clip(w0 + found @ np.array([w1, w2]), -30, 30))))

    return scored(text)


def held_out(doc_id: Column) -> Column:
    """Rows that labels are not learnt from; a null id isn't one."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def classified(docs: DataFrame, labels: DataFrame, spec: ClassifierSpec = ClassifierSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, fitted on labelled rows that aren't held out.

    Null and empty texts are scored as empty ones; repeated rows get the same
    score; other columns aren't read; an empty table gives an empty result.
    """
    model = fit(docs, labels.where(~held_out(F.col(id_col))), spec, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), score(model, F.col(text_col).cast("string")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= spec.cutoff).cast("int").alias("predicted"))
