"""A token store: documents' ids in blocks with one shared compression dictionary.

The store is a folder of Parquet files whose rows are blocks, written by Spark,
so a lost executor's files are never seen half-written and any file system that
Spark reaches will do. A block holds consecutive documents in id order:

    data      the documents' zstandard frames, one after another
    ends      where each frame ends in data: the offset index
    doc_ids   the documents' ids
    sizes     the documents' token counts
    first_id, last_id   bounds for looking one document up
    part, at  the writing task and the block's first token in that task
    dictionary_hash     SHA-256 of the dictionary it needs

Each document is its own frame of little-endian unsigned 32-bit ids, so a short
document is read by one ranged read and one small decompression. The dictionary
lies in the folder beside it, named by its hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scale import drawn
from cohortry.llm.tokens import byte_level, encoded


@dataclass(frozen=True)
class StoreSpec:
    """The dictionary is trained on at most `sample` documents, each up to
    `sample_bytes` of its ids, and has at most `dictionary_bytes`; it affects
    size alone. A block closes at block_docs documents or block_bytes."""

    tokenizer: str
    end_id: int = 0
    level: int = 3
    sample: int = 2000
    sample_bytes: int = 8192
    dictionary_bytes: int = 65536
    block_docs: int = 512
    block_bytes: int = 1 << 22


BLOCKS = pa.schema([
    ("part", pa.int32()), ("at", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()),
    ("tokens", pa.int64()), ("dictionary_hash", pa.string()), ("doc_ids", pa.list_(pa.int64())),
    ("sizes", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("data", pa.binary()),
])
BLOCK_COLUMNS = (
    "part int, at bigint, first_id bigint, last_id bigint, tokens bigint, dictionary_hash string, "
    "doc_ids array<bigint>, sizes array<bigint>, ends array<bigint>, data binary"
)


def serialized(ids: np.ndarray, spec: StoreSpec) -> bytes:
    return np.append(ids, np.uint32(spec.end_id)).astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, spec: StoreSpec) -> bytes:
    """A raw dictionary from a bounded sample in hash order; too few rows give an empty one."""
    sample = drawn(docs, ["doc_id", F.xxhash64("text")], 9, spec.sample, docs.count())
    rows = sample.select(F.substring("text", 1, spec.sample_bytes).alias("text")).collect()
    ids = byte_level(spec.tokenizer).batch([r.text for r in rows])
    pieces = [serialized(x, spec)[:spec.sample_bytes] for x in ids]
    try:
        return zstandard.train_dictionary(spec.dictionary_bytes, pieces).as_bytes() if len(pieces) >= 16 else b""
    except zstandard.ZstdError:
        return b""  # the sample has nothing in common


def _dictionary(raw: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}


def _write_blocks(spec: StoreSpec, raw: bytes):
    name = hashlib.sha256(raw).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=spec.level, **_dictionary(raw))
        part, at = TaskContext.get().partitionId(), 0
        ids: list = []
        sizes: list[int] = []
        ends: list[int] = []
        data = bytearray()

        def block() -> pa.RecordBatch:
            nonlocal at
            known, total = [i for i in ids if i is not None], sum(sizes)
            row = (part, at, known[0] if known else None, known[-1] if known else None, total, name, list(ids), list(sizes), list(ends), bytes(data))
            out = pa.record_batch([pa.array([v], f.type) for v, f in zip(row, BLOCKS, strict=True)], schema=BLOCKS)
            at += total
            for x in (ids, sizes, ends, data):
                x.clear()
            return out

        for batch in batches:
            for doc_id, found in encoded(batch, byte_level(spec.tokenizer)):
                body = serialized(found, spec)
                ids.append(doc_id)
                sizes.append(len(body) // 4)
                data += pack.compress(body)
                ends.append(len(data))
                if len(ids) == spec.block_docs or len(data) >= spec.block_bytes:
                    yield block()
        if ids:
            yield block()

    return run


def write_store(docs: DataFrame, path: str, spec: StoreSpec, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write all documents in ascending id order; null ids come first, ties by text.

    A null or empty text is the end id alone; repeated rows are stored each.
    Other columns aren't read. An empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    raw = train_dictionary(rows, spec)
    spark.createDataFrame(
        [(hashlib.sha256(raw).hexdigest(), bytearray(raw))], "dictionary_hash string, dictionary binary"
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    # Hash as the last key: equal ids, and null ones, can be dealt to several tasks.
    tie = F.xxhash64("text")
    ordered = rows.withColumn("tie", tie).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(_write_blocks(spec, raw), BLOCK_COLUMNS).write.parquet(f"{path}/blocks")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The store's dictionary, checked against its hash."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    raw = bytes(row.dictionary)
    if hashlib.sha256(raw).hexdigest() != row.dictionary_hash:
        raise ValueError("the dictionary doesn't match its hash")
    return raw


def _read_blocks(raw: bytes):
    name = hashlib.sha256(raw).hexdigest()
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(**_dictionary(raw))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_hash"] != name:
                    raise ValueError("a block needs another dictionary")
                sizes = np.array(row["sizes"], np.int64)
                starts = row["begin"] + np.cumsum(sizes) - sizes
                view = memoryview(row["data"])
                frames = [unpack.decompress(view[a:b]) for a, b in zip([0, *row["ends"][:-1]], row["ends"], strict=True)]
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(frames, pa.binary())], schema=kinds)

    return run


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; start counts the ids of all before it."""
    blocks = spark.read.schema(BLOCK_COLUMNS).parquet(f"{path}/blocks")
    # One row for each writing task: few, whatever the data.
    parts = blocks.groupBy("part").agg(F.sum("tokens").alias("total")).collect()
    before, sum_ = {}, 0
    for r in sorted(parts):
        before[r.part] = sum_
        sum_ += r.total
    offsets = spark.createDataFrame(list(before.items()), "part int, before bigint")
    placed = blocks.join(F.broadcast(offsets), "part").select(
        (F.col("before") + F.col("at")).alias("begin"), "doc_ids", "sizes", "ends", "data", "dictionary_hash"
    )
    raw = read_dictionary(spark, path)
    return placed.mapInArrow(_read_blocks(raw), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """One document's ids, for each row with that id: reads the blocks around it, decompresses its frames."""
    raw = read_dictionary(spark, path)
    blocks = spark.read.schema(BLOCK_COLUMNS).parquet(f"{path}/blocks").where(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)
    )
    unpack, found = zstandard.ZstdDecompressor(**_dictionary(raw)), []
    spots = blocks.select(F.posexplode("doc_ids").alias("k", "id"), "ends", "data").where(F.col("id") == doc_id)
    begin = F.when(F.col("k") > 0, F.expr("get(ends, k - 1)")).otherwise(0)
    cut = F.expr("substring(data, CAST(low AS INT) + 1, CAST(high - low AS INT))")
    for row in spots.withColumns({"low": begin, "high": F.expr("get(ends, k)")}).select(cut.alias("frame")).toLocalIterator():
        found.append(np.frombuffer(unpack.decompress(bytes(row.frame)), "<u4").tolist())
    return found
