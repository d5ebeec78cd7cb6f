"""Exact quantiles for groups of any size.

percentile() keeps every distinct value of a group in one task. That is the
right plan for ordinary groups, and what is used for them. A group with more
than `hot_rows` rows is instead narrowed down: its value range is cut into
buckets whose width grows with the distance from the smallest value, rows are
counted per bucket, and only the bucket holding the wanted rank is looked at
again, until no such bucket has more than `hot_rows` rows of different values.
Every level is stored, so each reads what the one before has left. The answer
is the exact order statistic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry.functions.scale import materialized
from cohortry.specs import HOT_ROWS

# Octaves between the smallest step of a bucket range and its whole width.
OCTAVES = 40

# Up to this many groups (and the few buckets wanted of each) are broadcast; more
# are joined by a shuffle on the group and one of SALTS shares of its rows.
FEW_GROUPS, SALTS = 1000, 64

Spread = Callable[[DataFrame], DataFrame]


def hot_groups(rows: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Groups with more than hot_rows rows; there are at most rows/hot_rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)


def salted(rows: DataFrame) -> DataFrame:
    """Deal the rows of each group out to SALTS shares, whatever their values."""
    return rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))


def to_salts(small: DataFrame) -> DataFrame:
    """Each row once for every share."""
    return small.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))


@dataclass
class Hot:
    """Groups too large for one task. Few of them, by count, are broadcast;
    more are joined by a shuffle that splits their rows."""

    groups: DataFrame
    few: bool

    def rest(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        return self._joined(rows, keys, "left_anti")

    def rows(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        return self._joined(rows, keys, "left_semi")

    def _joined(self, rows: DataFrame, keys: list[str], how: str) -> DataFrame:
        if self.few:
            return rows.join(F.broadcast(self.groups), keys, how)
        return salted(rows).join(to_salts(self.groups), [*keys, "_salt"], how).drop("_salt")


def checked(groups: DataFrame) -> Hot | None:
    """Count the hot groups, up to FEW_GROUPS; None if there are none."""
    n = groups.limit(FEW_GROUPS + 1).count()
    return Hot(groups, n <= FEW_GROUPS) if n else None


def quantiles(
    rows: DataFrame, keys: list[str], value: str, probs: dict[str, float],
    hot_rows: int = HOT_ROWS, hot: Hot | None | str = "count",
) -> DataFrame:
    """One column per entry of probs for each group; missing values skipped.
    `hot` are the groups above hot_rows, if they are known; they are counted otherwise."""
    rows = rows.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    if not keys:
        rows, keys, drop = rows.withColumn("_all", F.lit(0)), ["_all"], ["_all"]
    else:
        drop = []
    plain = lambda df: df.groupBy(*keys).agg(
        *[F.percentile("_v", F.lit(p)).alias(name) for name, p in probs.items()]
    )
    if hot == "count":
        hot = checked(hot_groups(rows, keys, hot_rows))
    if hot is None:
        return plain(rows).drop(*drop)
    cold = plain(hot.rest(rows, keys))
    found = narrowed_quantiles(hot.rows(rows, keys), keys, "_v", probs, few=hot.few, hot_rows=hot_rows)
    return cold.unionByName(found).drop(*drop)


def narrowed_quantiles(
    rows: DataFrame, keys: list[str], value: str, probs: dict[str, float],
    period: str | None = None, spread: Spread | None = None,
    buckets: int = 4096, few: bool = False, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Quantiles by repeated narrowing of the bucket that holds the rank.

    With `period` and `spread`, counts are kept per period and spread() maps
    them to the snapshots they belong to (column "snapshot"), so windows that
    overlap share one pass over the rows. `few` says the groups were counted
    and are few enough to broadcast. A bucket's smallest and largest value are
    those of its rows, so every level parts them; 40 octaves fit into one
    level, so values far outside cost one more level, not one each.
    """
    base = [*keys, *([period] if period else [])]
    group = [*keys, *(["snapshot"] if spread else [])]
    spread = spread or (lambda df: df)
    rows = materialized(salted(rows.select(*base, F.col(value).cast("double").alias("_v"))))

    first = materialized(rows.groupBy(*base).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    ))
    nodes = (
        first.groupBy(*keys)
        .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        .withColumn("_node", F.lit(""))
    )
    sizes = spread(first.select(*base, "_n")).groupBy(*group).agg(F.sum("_n").alias("_n"))
    wanted = []
    for name, p in probs.items():
        at = F.lit(p) * (F.col("_n") - 1)
        wanted += [
            F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"),
                     rank.cast("bigint").alias("rank"), (at - F.floor(at)).alias("share"))
            for side, rank in (("low", F.floor(at)), ("high", F.ceil(at)))
        ]
    asked = (
        sizes.select(*group, F.explode(F.array(*wanted)).alias("_q"))
        .select(*group, "_q.*")
        .withColumn("_node", F.lit(""))
    )

    # At most two buckets per group, snapshot and quantile are looked into.
    sized = F.broadcast if few else to_salts
    node = [*keys, "_node"] if few else [*keys, "_node", "_salt"]
    member = rows.withColumn("_node", F.lit(""))
    while True:
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        octave = F.log2(F.lit(1.0) + share * F.lit(float(1 << OCTAVES))) / F.log2(F.lit(1.0 + (1 << OCTAVES)))
        bucket = F.when(
            F.col("_hi") > F.col("_lo"),
            F.when(F.col("_v") >= F.col("_hi"), F.lit(buckets))
            .otherwise(F.least(F.floor(octave * buckets), F.lit(buckets - 1))),
        ).otherwise(F.lit(0)).cast("int")
        member = member.join(sized(nodes), node).withColumn("_b", bucket).drop("_lo", "_hi")
        counts = materialized(member.groupBy(*base, "_node", "_b").agg(
            F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        ))
        path = F.concat_ws(".", "_node", "_b")
        asked = _descend(asked, spread(counts.select(*base, "_node", "_b", "_n")), group, "_b")
        asked = materialized(asked.withColumn("_node", path).drop("_b"))
        bounds = counts.groupBy(*keys, "_node", "_b").agg(
            F.sum("_n").alias("_n"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
        ).withColumn("_node", path).drop("_b")
        nodes = materialized(bounds.join(asked.select(*keys, "_node").distinct(), [*keys, "_node"], "left_semi"))
        largest = nodes.filter(F.col("_hi") > F.col("_lo")).agg(F.max("_n")).first()[0] or 0
        nodes = nodes.drop("_n")
        kept = member.withColumn("_node", path).drop("_b")
        member = materialized(kept.join(sized(nodes.drop("_lo", "_hi")), node, "left_semi"))
        if largest <= hot_rows:
            break

    counts = member.groupBy(*base, "_node", "_v").agg(F.count("*").alias("_n"))
    found = _descend(asked, spread(counts), group, "_v")

    def at(name: str) -> Column:
        pick = lambda side: F.max(
            F.when((F.col("name") == name) & (F.col("side") == side), F.col("_v"))
        )
        share = F.max(F.when(F.col("name") == name, F.col("share")))
        return (pick("low") + (pick("high") - pick("low")) * share).alias(name)

    return found.groupBy(*group).agg(*[at(name) for name in probs])


def _descend(asked: DataFrame, counts: DataFrame, group: list[str], step: str) -> DataFrame:
    """Find, for every asked rank, the step (bucket or value) that holds it."""
    merged = counts.groupBy(*group, "_node", step).agg(F.sum("_n").alias("_n"))
    upto = W.partitionBy(*group, "_node").orderBy(step).rowsBetween(W.unboundedPreceding, 0)
    cumulated = merged.withColumn("_upto", F.sum("_n").over(upto))
    return (
        asked.join(cumulated, [*group, "_node"])
        .filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_n")))
        .withColumn("rank", F.col("rank") - (F.col("_upto") - F.col("_n")))
        .drop("_n", "_upto")
    )
