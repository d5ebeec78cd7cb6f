"""Scaling, correlation and the numbers behind descriptive plots."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.quantiles import quantiles
from cohortry.specs import HOT_ROWS


#: Columns of one aggregate. The code of more is too long a method for the JVM to compile.
TOGETHER = 8


def fit_moments(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column, in one job of an aggregate
    for a few columns each. The result is one row for each column whatever the size of the data."""
    line = lambda c: F.struct(F.lit(c).alias("c"), F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))
    groups = [columns[k:k + TOGETHER] for k in range(0, len(columns), TOGETHER)]
    parts = [df.agg(F.array(*map(line, group)).alias("_lines")) for group in groups]
    if not parts:
        return {}
    lines = reduce(DataFrame.union, parts).select(F.inline("_lines")).collect()
    return {row["c"]: (row["m"], row["s"]) for row in lines}


def apply_moments(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a constant column becomes 0."""
    def scaled(c: str) -> Column:
        mean, dev = moments[c]
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(c) - F.lit(mean)) / F.lit(dev if dev else 1.0)

    return df.select(
        *[scaled(c).alias(c) if c in moments else F.col(c) for c in df.columns]
    )


def standardize(train: DataFrame, everything: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fit on the training rows, apply to both. Rows are scaled in place, so
    nothing is joined back by key."""
    moments = fit_moments(train, columns)
    return apply_moments(train, moments), apply_moments(everything, moments)


def unpivot(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, feature, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.*")


def _pair_sums(means: np.ndarray):
    """Per batch, for each pair of columns over the rows that have both: count,
    sums, sums of squares and of products, of values less the column's mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - means
            there = np.isfinite(x).astype(float)
            x = np.where(there > 0, x, 0.0)
            total = total + np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        if not np.isscalar(total):
            n, s, q, p = total.reshape(4, -1)
            yield pa.record_batch({"k": np.arange(len(n), dtype=np.int32), "n": n, "s": s, "q": q, "p": p})

    return run


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson correlation as rows (i, j, r): of the rows in which
    both columns have a value. A constant column has none.

    Tasks sum up their rows; the sums, four for each pair of columns, are
    added by pair.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    moments = fit_moments(rows, columns)
    means = np.array([moments[c][0] or 0.0 for c in columns])
    sums = rows.mapInArrow(_pair_sums(means), "k int, n double, s double, q double, p double")
    width = len(columns)
    total = sums.groupBy("k").agg(*[F.sum(c).alias(c) for c in "nsqp"])
    names = F.array(*[F.lit(c) for c in columns])
    left = total.withColumns({"i": F.floor(F.col("k") / width).cast("int"), "j": F.col("k") % width})
    right = left.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    spread = (F.col("q") - F.col("s") * F.col("s") / F.col("n")) * (F.col("q2") - F.col("s2") * F.col("s2") / F.col("n"))
    r = (F.col("p") - F.col("s") * F.col("s2") / F.col("n")) / F.sqrt(spread)
    tiny = F.lit(1e-18) * F.col("q") * F.col("q2")
    return left.join(right, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("i"), F.get(names, F.col("j")).alias("j"),
        F.when((F.col("n") > 1) & (spread > tiny), r).alias("r"),
    )


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe_by_class(
    df: DataFrame, columns: list[str], target: str = "target", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles."""
    rows = unpivot(df, [target], columns)
    keys = [target, "feature"]
    base = rows.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return base.join(quantiles(rows, keys, "value", QUARTILES, hot_rows), keys, "left")


def histogram_by_class(
    df: DataFrame, column: str, width: float, log: bool = False, target: str = "target"
) -> DataFrame:
    """Rows per class and bin of fixed width, of x or of log10(x)."""
    x = F.col(column).cast("double")
    if log:
        df = df.filter(x > 0)
        x = F.log10(x)
    return (
        df.groupBy(target, F.floor(x / F.lit(width)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def boxplot_stats(
    df: DataFrame, columns: list[str], target: str = "target", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Quartiles and whiskers: the outermost values within 1.5 quartile
    distances, and the number of values outside. Two passes over the rows,
    joined to one line per class and column."""
    rows = unpivot(df, [target], columns)
    keys = [target, "feature"]
    boxes = quantiles(rows, keys, "value", QUARTILES, hot_rows)
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    fenced = rows.join(boxes, keys)
    inside = (F.col("value") >= F.col("q25") - reach) & (F.col("value") <= F.col("q75") + reach)
    return fenced.groupBy(*keys, *QUARTILES).agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count(F.when(~inside, F.lit(1))).alias("n_outside"),
    )


def class_counts(df: DataFrame, target: str = "target") -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n"))


def both_below(df: DataFrame, a: str, b: str, bound: float) -> DataFrame:
    """Rows with both columns under a bound."""
    return df.filter((F.col(a) < bound) & (F.col(b) < bound))


def strictly_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(column) > low) & (F.col(column) < high))
