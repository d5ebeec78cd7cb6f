"""Shards balanced in bytes, tokens and rows at once: vector bin packing.

Rows with equal text form a group. A group that is large against a shard is
placed by itself; the rest are dealt by hash into bundles, whose number doesn't
depend on the data, and bundles are placed as groups are. So what the driver
places is bounded, whatever the number of documents. Each goes where the dot
product of its vector with the residual capacity is highest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry.functions.scale import materialized

MEASURES = ("size", "tokens", "rows")


@dataclass(frozen=True)
class ShardSpec:
    """bundles: of small groups, for each shard. A group that has more than
    1 / large of a shard in any measure is placed by itself; one that has more
    than a shard is first split by document into `parts` pieces.
    slots: rows that are numbered together."""

    shards: int = 16
    bundles: int = 512
    large: int = 128
    parts: int = 256
    slots: int = 1024


def estimated_tokens(text: Column) -> Column:
    """Words and marks: close enough to a tokenizer's count for balance."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\w+|[^\w\s]")), F.lit(0)).cast("bigint")


def placed(items: np.ndarray, totals: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, largest first, by the highest dot product with what is left.

    items: one row of measures each. An item goes to a shard that has room in
    every measure if there is one, otherwise where it exceeds least.
    """
    share = items / np.maximum(totals, 1) * shards
    left = np.ones((shards, items.shape[1]))
    out = np.empty(len(items), np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        fits = (left >= share[i] - 1e-12).all(axis=1)
        score = left @ share[i]
        over = (share[i] - left).max(axis=1)
        best = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmin(over))
        out[i] = best
        left[best] -= share[i]
    return settled(share, out, 1 - left)


#: How much the measures weigh when what was placed is settled; bytes are what the law promises.
WEIGHTS = np.array([16.0, 1.0, 1.0])


def settled(share: np.ndarray, place: np.ndarray, load: np.ndarray, rounds: int = 5000) -> np.ndarray:
    """Moves single items from the fullest to the emptiest shard of a measure while that evens them out."""
    place, load = place.copy(), load.copy()
    for _ in range(rounds):
        for measure in range(share.shape[1]):
            full, empty = int(load[:, measure].argmax()), int(load[:, measure].argmin())
            own = np.flatnonzero(place == full)
            gain = (WEIGHTS * (share[own] ** 2 - share[own] * (load[full] - load[empty]))).sum(axis=1)
            if len(own) and gain.min() < -1e-12:
                item = own[gain.argmin()]
                place[item] = empty
                load[full] -= share[item]
                load[empty] += share[item]
                break
        else:
            break
    return place


def shard(
    docs: DataFrame, spec: ShardSpec = ShardSpec(), id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None,
) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, shard, slot) of every row.

    size is the text's UTF-8 bytes plus one; a null text counts like an empty
    one, but forms a group of its own. Equal texts share a shard unless they
    exceed it together. slot numbers a shard's rows from 0 without gaps;
    repeated rows get different slots, rows that don't differ in id and text
    in no particular order. A null id is an id like others. Other columns
    aren't read, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    raw = F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))
    rows = materialized(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        (estimated_tokens(text) if tokens is None else tokens.cast("bigint")).alias("tokens"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(text, text.isNull()).alias("g1"), F.xxhash64(F.lit(1), text).alias("g2"),
    ))
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    again = [F.sum(m).alias(m) for m in MEASURES]
    groups = materialized(rows.groupBy("g1", "g2").agg(*sums))
    totals_row = groups.agg(*again, F.count("*").alias("groups")).first()
    if not totals_row["groups"]:
        return rows.select("doc_id", "size", "tokens", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"))
    totals = np.array([float(totals_row[m] or 0) for m in MEASURES])
    above = lambda share: F.greatest(*[F.col(m) * spec.shards * share > F.lit(t) for m, t in zip(MEASURES, totals, strict=True)])
    # At most large * shards groups for each measure.
    large = [r for r in groups.where(above(spec.large)).select("g1", "g2", above(1).alias("split")).collect()]
    names = spark.createDataFrame([(r.g1, r.g2, r.split) for r in large], "g1 bigint, g2 bigint, split boolean")
    bundle = F.pmod("g2", F.lit(spec.bundles * spec.shards))
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(spec.parts))
    # names has a bounded number of rows, see above.
    named = rows.join(F.broadcast(names), ["g1", "g2"], "left").withColumns({
        "k1": F.when(F.col("split").isNull(), bundle).otherwise(F.col("g1")),
        "k2": F.when(F.col("split").isNull(), F.lit(-1)).otherwise(F.col("g2")),
        "k3": F.when(F.col("split").isNull(), F.lit(-1)).when(F.col("split"), part).otherwise(F.lit(-2)),
    })
    items = sorted(named.groupBy("k1", "k2", "k3").agg(*sums).collect())
    shard_of = placed(np.array([[float(r[m] or 0) for m in MEASURES] for r in items]), totals, spec.shards)
    places = spark.createDataFrame(
        [(r.k1, r.k2, r.k3, int(s)) for r, s in zip(items, shard_of, strict=True)], "k1 bigint, k2 bigint, k3 bigint, shard int"
    )
    buckets = max(1, int(totals_row["rows"]) // (spec.shards * spec.slots))
    out = named.join(F.broadcast(places), ["k1", "k2", "k3"]).select(
        "doc_id", "size", "tokens", "text_crc32", "shard",
        F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(3)), F.lit(buckets)).alias("bucket"),
    )
    counts = out.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return out.withColumn("rank", F.row_number().over(own) - 1).join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("before") + F.col("rank")).alias("slot")
    )
