"""Phrase collocations from exact n-gram counts in counting quotient filters.

Documents become chunks of coded words. Words seen often enough in their
language get global ids; the rest can be in no candidate and parts a text as its
marks do. For each length every chunk builds a filter of its n-grams, cut into
ranges of the permuted numbers; the segments of a range meet in one task and are
merged. The answer to a chunk is one bit for each of its entries: whether the
n-gram is frequent. The next length only counts n-grams both of whose parts are,
which loses none, as a phrase is never more frequent than a part of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry.functions.scale import materialized, numbered
from cohortry.llm.codes import slices
from cohortry.llm.quotient_filter import FILTER, FILTER_COLUMNS, Layout, in_order

MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(10 if b in MARKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class CollocationSpec:
    """least: counts of a candidate. longest: its words, 4 at most. covered: percent of a
    phrase's count from which a longer one makes it redundant. top: rows of a language.
    chunk: words of a chunk. entries: of all filters that one merging task takes."""

    least: int = 30
    longest: int = 4
    covered: int = 80
    top: int = 2000
    chunk: int = 1_000_000
    entries: int = 500_000


class _Words(dict):
    """Numbers from 1 for the words of one language; all languages share the list of entries. Marks are 0."""

    def __init__(self, lang: str, entries: list[tuple[str, bytes]]) -> None:
        super().__init__({b"\n": 0})
        self._lang, self._entries = lang, entries

    def __missing__(self, word: bytes) -> int:
        self._entries.append((self._lang, word))
        self[word] = code = len(self._entries)
        return code


CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
    ("codes", pa.binary()),
])
CHUNK_COLUMNS = "chunk bigint, langs array<string>, words array<string>, counts array<bigint>, codes binary"


def _tokens(text: str) -> Iterator[list[bytes]]:
    """A text's words in order, b"\\n" where pieces meet."""
    for part in slices(text.encode(), MARKS + b" \t"):
        part = part.translate(_TABLE).replace(b"\n", b" \n ")
        while b"  " in part:
            part = part.replace(b"  ", b" ")
        if part := part.strip(b" "):
            yield part.split(b" ")


def _encode(spec: CollocationSpec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, entries, langs, parts, held = TaskContext.get().partitionId() << 32, [], {}, [], 0

        def full() -> pa.RecordBatch:
            nonlocal chunk, held
            flat = np.concatenate([np.empty(0, np.uint32), *parts])
            counts = np.bincount(flat, minlength=len(entries) + 1)[1:]
            row = chunk, [e[0] for e in entries], [e[1].decode() for e in entries], counts, flat.tobytes()
            chunk, held = chunk + 1, 0
            for x in (entries, langs, parts):
                x.clear()
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, CHUNKS, strict=True)], schema=CHUNKS)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                codes = langs.get(lang) or langs.setdefault(lang, _Words(lang, entries))
                for words in _tokens(text.as_py() or ""):
                    parts.append(np.fromiter(map(codes.__getitem__, words), np.uint32, len(words)))
                    held += len(words)
                parts.append(np.zeros(1, np.uint32))
                held += 1
                if held >= spec.chunk:
                    yield full()
        if entries:
            yield full()

    return run


STREAMS = pa.schema([("chunk", pa.int64()), ("ids", pa.binary()), ("begins", pa.binary()), ("eligible", pa.int64())])
STREAM_COLUMNS = "chunk bigint, ids binary, begins binary, eligible bigint"


def _stream(chunk: int, ids: np.ndarray, begins: np.ndarray, n: int) -> pa.Table:
    """The ids in which n-grams begin at `begins`; ids that none covers are left out."""
    covered = begins.copy()
    for k in range(1, n):
        covered[k:] |= begins[:-k]
    ids, begins = ids[covered], begins[covered]
    rows = [(chunk, ids.astype("<u4").tobytes(), np.packbits(begins).tobytes(), int(begins.sum()))] if len(ids) else []
    return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(STREAMS)], schema=STREAMS)


def _relabel(chunk: pa.Table, known: pa.Table) -> pa.Table:
    """Chunk's codes become global ids; 0 for marks and words that are too rare."""
    codes = np.frombuffer(chunk.column("codes")[0].as_py(), np.uint32)
    ids = np.zeros(int(codes.max(initial=0)) + 1, np.uint32)
    ids[known.column("pos").to_numpy() + 1] = known.column("id").to_numpy()
    stream = ids[codes]
    begins = stream > 0
    begins[:-1] &= begins[1:].copy()
    begins[-1:] = False
    return _stream(chunk.column("chunk")[0].as_py(), stream, begins, 2)


def _distinct(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n-grams given by columns: a place of each different one, which one each is, and their counts."""
    pair = lambda a, b: (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    rank = lambda x: np.unique(x, return_inverse=True)[1].astype(np.uint64)
    if len(words) == 2:
        key = pair(*words)
    elif len(words) == 3:
        key = pair(rank(pair(*words[:2])), words[2])
    else:
        key = pair(rank(pair(*words[:2])), rank(pair(*words[2:])))
    _, first, which, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    return first, which, counts


def _filtered(ids: np.ndarray, begins: np.ndarray, layout: Layout) -> tuple[np.ndarray, ...]:
    """A chunk's entries in the filter's order: halves, counts, which entry each begin is, and the begins."""
    at = np.flatnonzero(begins)
    words = [ids[at + k] for k in range(layout.n)]
    first, which, counts = _distinct(words)
    left, right = layout.permuted([w[first] for w in words])
    order = in_order(left, right, layout.right_bits, layout.left_bits)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return left[order], right[order], counts[order], place[which], at


def _unpacked(ids: bytes, begins: bytes) -> tuple[np.ndarray, np.ndarray]:
    words = np.frombuffer(ids, "<u4")
    return words, np.unpackbits(np.frombuffer(begins, np.uint8), count=len(words)).astype(bool)


def _count(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, ids, begins in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                left, right, counts, _, _ = _filtered(*_unpacked(ids.as_py(), begins.as_py()), layout)
                rows = layout.segments(chunk, left, right, counts)
                for k in range(0, len(rows), 64):
                    cols = zip(*rows[k:k + 64], strict=True)
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, FILTER, strict=True)], schema=FILTER)

    return run


MERGED = pa.schema([("chunk", pa.int64()), ("range", pa.int32()), ("bits", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
MERGED_COLUMNS = "chunk bigint, range int, bits binary, words binary, counts binary"


def _merge(layout: Layout, least: int):
    """The frequent n-grams of one range in a row without chunk, and the bits for each chunk."""

    def run(filters: pa.Table) -> pa.Table:
        rows = filters.to_pylist()
        left, right, counts, which = layout.merged(rows)
        often = counts >= least
        words = layout.inverse(left[often], right[often])
        out = [(None, rows[0]["range"], None, np.stack(words, axis=1).astype("<u4").tobytes(), counts[often].astype("<i8").tobytes())]
        stops = np.cumsum([len(r["counts"]) for r in rows])
        for row, part in zip(rows, np.split(often[which], stops[:-1]), strict=True):
            out.append((row["chunk"], row["range"], np.packbits(part).tobytes(), None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), MERGED, strict=True)], schema=MERGED)

    return run


def _narrow(layout: Layout):
    """Keep what can begin a frequent n-gram of one word more: both its parts are frequent."""

    def run(stream: pa.Table, replies: pa.Table) -> pa.Table:
        row = stream.to_pylist()[0]
        ids, begins = _unpacked(row["ids"], row["begins"])
        left, _, _, which, at = _filtered(ids, begins, layout)
        sizes = np.unique(layout.ranges(left), return_counts=True)[1]
        bits = [r["bits"] for r in sorted(replies.to_pylist(), key=lambda r: r["range"])]
        often = np.concatenate([
            np.unpackbits(np.frombuffer(b, np.uint8), count=int(n)) for b, n in zip(bits, sizes, strict=True)
        ]).astype(bool)
        good = np.zeros(len(ids), bool)
        good[at] = often[which]
        good[:-1] &= good[1:].copy()
        good[-1:] = False
        return _stream(row["chunk"], ids, good, layout.n + 1)

    return run


def _rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1), strict=True):
                ids, a = np.frombuffer(words.as_py(), "<u4").astype(np.int64), np.frombuffer(counts.as_py(), "<i8")
                grams = pa.ListArray.from_arrays(pa.array(np.arange(0, len(ids) + 1, n), pa.int32()), pa.array(ids))
                yield pa.record_batch([grams, pa.array(a)], names=["w", "a"])

    return run


def counted(docs: DataFrame, spec: CollocationSpec) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """From (lang, text): totals (lang, n), words (id, lang, word, a), and for 2, 3, ... words phrases (w, a)."""
    chunks = materialized(docs.mapInArrow(_encode(spec), CHUNK_COLUMNS))
    entries = F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("pos", "e")
    each = chunks.select("chunk", entries).select("chunk", "pos", F.col("e.langs").alias("lang"), F.col("e.words").alias("word"), F.col("e.counts").alias("n"))
    # A chunk has a word once, so the most frequent word has as many rows as there are chunks.
    own = W.partitionBy("lang", "word")
    summed = materialized(each.select(
        "*", F.sum("n").over(own).alias("a"), (F.row_number().over(own.orderBy("chunk")) == 1).alias("once"),
    ))
    totals = summed.groupBy("lang").agg(F.sum("n").alias("n"))
    often = summed.where(F.col("a") >= spec.least)
    words = materialized(numbered(often.where("once").select("lang", "word", "a"), ["lang", "word"], 11, out="id"))
    known = often.select("chunk", "pos", "lang", "word").join(words, ["lang", "word"]).select("chunk", "pos", "id")
    streams = materialized(chunks.select("chunk", "codes").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_relabel, STREAM_COLUMNS))
    bits = max(1, int(words.agg(F.max("id")).first()[0] or 1).bit_length())
    if bits > 32:
        raise ValueError("more than 2**32 frequent words")
    phrases = []
    for n in range(2, spec.longest + 1):
        eligible = streams.agg(F.sum("eligible")).first()[0] or 0
        left_bits = bits * -(-n // 2)
        range_bits = min(left_bits, max(0, (eligible // spec.entries).bit_length()))
        layout = Layout(n, bits, range_bits, min(left_bits, max(range_bits, spec.chunk.bit_length())))
        filters = streams.mapInArrow(_count(layout), FILTER_COLUMNS)
        merged = materialized(filters.groupBy("range").applyInArrow(_merge(layout, spec.least), MERGED_COLUMNS))
        found = merged.where("chunk IS NULL").select("words", "counts")
        phrases.append(materialized(found.mapInArrow(_rows(n), "w array<bigint>, a bigint")))
        if n < spec.longest:
            replies = merged.where("chunk IS NOT NULL").select("chunk", "range", "bits")
            streams = materialized(streams.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_narrow(layout), STREAM_COLUMNS))
    return totals, words, phrases


def highest(rows: DataFrame, group: str, order: list, tie: str, n: int, bucket: int = 100_000) -> DataFrame:
    """The first n rows of each group, as `rank`; groups are thinned out in buckets before they are sorted as a whole."""
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(W.partitionBy(group, *by).orderBy(*order)))
    left = rows.count()
    while left > bucket:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(tie), F.lit(-(-left // bucket))))
        rows = materialized(ranked(salted, "_salt").where(F.col("rank") <= n).drop("rank", "_salt"))
        before, left = left, rows.count()
        if 2 * left > before:
            break
    return ranked(rows).where(F.col("rank") <= n)


def collocations(docs: DataFrame, spec: CollocationSpec = CollocationSpec(), lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first phrases.

    A piece of a text ends at . , ; : ! ? and line ends; its words are what lies
    between spaces and tabs, A-Z lower-cased. All whole texts count, repeated
    rows each. A null or empty text has no words; a null lang is `und`. Other
    columns aren't read; an empty table gives an empty result. Ties in score
    and count are ordered by phrase.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    totals, words, phrases = counted(rows, spec)
    union = lambda frames: reduce(DataFrame.union, frames)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    found = union(phrases)
    # Each cut of each candidate, with the counts of its two parts.
    parts = union([words.select(F.array("id").alias("w"), "a"), *phrases[:-1]])
    cuts = found.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.slice("w", 1, F.col("k")), "rest": F.slice("w", F.col("k") + 1, F.size("w") - F.col("k"))})
    cuts = cuts.join(parts.select(F.col("w").alias("first"), F.col("a").alias("l")), "first").join(
        parts.select(F.col("w").alias("rest"), F.col("a").alias("r")), "rest"
    ).withColumn("score", F.expr("CAST(a AS DECIMAL(20,0)) * 2000000BD div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    best = cuts.groupBy("w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # The most frequent longer phrase around each candidate.
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), s -> slice(w, s, m))))")
    around = found.where(F.size("w") > 2).select(F.explode(inner).alias("w"), "a").groupBy("w").agg(F.max("a").alias("longer"))
    alone = best.join(around, "w", "left").where(
        F.coalesce(exact("longer") * 100 < exact("a") * spec.covered, F.lit(True))
    )
    spelt = alone.select("w", "a", "best", F.posexplode("w").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    named = materialized(spelt.groupBy("w", "a", "best").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("x")
    ).select("lang", F.array_join("x.word", " ").alias("phrase"), "a", "best.l", "best.r", "best.score"))
    first = highest(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], "phrase", spec.top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
