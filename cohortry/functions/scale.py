"""Helpers for data that does not fit one task: stored tables and numbering."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cohortry-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{use_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession, name: str = "table") -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; plans over them end to work."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


SWEPT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_sweeping, _before, _lock = 0, None, threading.Lock()


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written, and don't
    wait for the driver's garbage collector. Writes may overlap; the session's setting comes back with the last."""
    global _sweeping, _before
    with _lock:
        if not _sweeping:
            _before = spark.conf.get(SWEPT, None)
            spark.conf.set(SWEPT, "true")
        _sweeping += 1
    try:
        yield
    finally:
        with _lock:
            _sweeping -= 1
            if not _sweeping and _before is None:
                spark.conf.unset(SWEPT)
            elif not _sweeping:
                spark.conf.set(SWEPT, _before)


def materialized(df: DataFrame) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    It survives lost executors, cuts the lineage, and later steps see real
    sizes and can prune columns. The files stay until cleanup() or discard();
    what was shuffled for them doesn't.
    """
    path = fresh_folder(df.sparkSession)
    with swept(df.sparkSession):
        df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    if (made := _made.get()) is not None:
        made.append(stored)
    return stored


_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


@contextmanager
def noted() -> Iterator[list[DataFrame]]:
    """The list of tables that materialized() stores inside, in this thread."""
    token = _made.set([])
    try:
        yield _made.get()
    finally:
        _made.reset(token)


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialized() that no later step reads; others are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def hash_of(*keys: Column | str, seed: int) -> Column:
    """A uniform, reproducible hexadecimal hash of the keys."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def hash_number(*keys: Column | str, seed: int) -> Column:
    """hash_of as an integer below 2**60, far above any number of rows."""
    return F.conv(F.substring(hash_of(*keys, seed=seed), 1, 15), 16, 10).cast("bigint")


def hash_unit(*keys: Column | str, seed: int) -> Column:
    """hash_of as a number in [0, 1)."""
    return hash_number(*keys, seed=seed) / F.lit(float(1 << 60))


def numbered(
    df: DataFrame, key: list[str], seed: int, by: list[str] | None = None,
    out: str = "rank", digits: int = 4,
) -> DataFrame:
    """Number rows 1..n in hash order, within each `by` group.

    A plain row_number would sort a whole group in one task. Rows are instead
    numbered inside 16**digits buckets of the hash, which are equally filled
    whatever the data, and the bucket's offset is added.
    """
    by = by or []
    rows = df.withColumn("_h", hash_of(*key, seed=seed)).withColumn(
        "_b", F.substring("_h", 1, digits)
    )
    sizes = rows.groupBy(*by, "_b").agg(F.count("*").alias("_size"))
    before = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_b", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    local = W.partitionBy(*by, "_b").orderBy("_h", *key)
    return (
        rows.withColumn("_rn", F.row_number().over(local))
        .join(offsets, [*by, "_b"])
        .withColumn(out, (F.col("_rn") + F.col("_off")).cast("bigint"))
        .drop("_h", "_b", "_rn", "_off")
    )


def drawn(df: DataFrame, keys: list[Column | str], seed: int, n: int, rows: int) -> DataFrame:
    """At most n of so many rows, those with the lowest hash.

    A plain ORDER BY with LIMIT sends n rows of every task to the driver. Here
    rows above the share that n needs are dropped by a filter first, so about
    1.3 n are sent in all, however many tasks there are.
    """
    share = min(1.0, (1.3 * n + 100) / max(rows, 1))
    hashed = df.withColumn("_h", hash_of(*keys, seed=seed))
    unit = F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint") / F.lit(float(1 << 60))
    return hashed.filter(unit <= share).orderBy("_h").limit(n).drop("_h")


def lowest(df: DataFrame, key: list[str], seed: int, n: int, digits: int = 4) -> DataFrame:
    """The n rows with the lowest hash, as `numbered` ranks them.

    Rows are counted in 16**digits buckets of the hash. Buckets that lie below
    the limit as a whole are kept by a filter, and only the one in which it
    falls is numbered, so the other rows are neither shuffled nor sorted.
    """
    rows = df.withColumn("_h", hash_of(*key, seed=seed)).withColumn("_b", F.substring("_h", 1, digits))
    upto = W.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    # One line for each bucket.
    filled = rows.groupBy("_b").agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(upto))
    edge = filled.filter(F.col("_upto") >= n).orderBy("_b").first()
    if edge is None:
        return df
    inside = rows.filter(F.col("_b") < edge["_b"])
    last = rows.filter(F.col("_b") == edge["_b"]).withColumn(
        "_rn", F.row_number().over(W.partitionBy("_b").orderBy("_h", *key))
    )
    last = last.filter(F.col("_rn") <= n - (edge["_upto"] - edge["_n"])).drop("_rn")
    return inside.unionByName(last).drop("_h", "_b")
