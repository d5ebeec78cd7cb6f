"""Aggregates with the null and tie rules the pipeline relies on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordering(*cols: str) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def last_value(value: Column | str, *order: str, where: Column | None = None) -> Column:
    """Last non-missing value in the given order.

    A struct of the order columns decides; rows with a missing value get a
    missing order and are skipped. Unlike last(), this does not depend on the
    order rows arrive in and combines before the shuffle.
    """
    value = F.col(value) if isinstance(value, str) else value
    keep = value.isNotNull() if where is None else value.isNotNull() & where
    return F.max_by(value, F.when(keep, ordering(*order)))


def total(value: Column | str, where: Column | None = None) -> Column:
    """Sum with an empty or all-missing group giving 0."""
    value = F.col(value) if isinstance(value, str) else value
    if where is not None:
        value = F.when(where, value)
    return F.coalesce(F.sum(value), F.lit(0))


def tally(where: Column) -> Column:
    """Number of rows for which the condition holds."""
    return F.count(F.when(where, F.lit(1)))


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows with a missing key: they belong to no group."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key. Combines before the shuffle, so a key with
    very many versions sends one row per task."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), ordering(*order)).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    )
