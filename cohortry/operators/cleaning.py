"""Filters, corrections, fills and key membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions import scalars as S

EVENT_ORDER = ("@timestamp", "date_last_updated", "event_id")


def exclude_values(df: DataFrame, excluded: dict[str, tuple]) -> DataFrame:
    """Drop rows having an excluded value; missing values are kept."""
    keep = [S.not_equal(c, *values) for c, values in excluded.items()]
    return df.filter(reduce(lambda a, b: a & b, keep))


def latest_version(registry: DataFrame, tie: str | None = None) -> DataFrame:
    """Newest registry row per company."""
    order = ["date_last_updated"] + ([tie] if tie else [])
    return A.newest(registry, ["company_id"], order)


def _matches(match: dict) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in match.items()])


def apply_corrections(events: DataFrame, corrections: list[specs.Correction]) -> DataFrame:
    """Delete rows, or swap the timestamps of two rows.

    The corrections are a short list in the caller's code, so each becomes a
    condition. A swap reads the two timestamps in one aggregate over the rows
    that match (a scan with a pushed filter) and sets them as literals.
    """
    for fix in corrections:
        if fix.op == "delete":
            events = events.filter(~_matches(fix.match))
        elif fix.op == "swap":
            one, two = _matches(fix.match), _matches(fix.other)
            found = (
                events.filter(one | two)
                .agg(
                    F.min(F.when(one, F.col("@timestamp"))).alias("a"),
                    F.min(F.when(two, F.col("@timestamp"))).alias("b"),
                )
                .first()
            )
            if found.a is None or found.b is None:
                continue
            a, b = F.lit(found.a), F.lit(found.b)
            kind = events.schema["@timestamp"].dataType
            events = events.withColumn(
                "@timestamp",
                F.when(one, b.cast(kind)).when(two, a.cast(kind)).otherwise(F.col("@timestamp")),
            )
        else:
            raise ValueError(f"unknown correction {fix.op!r}")
    return events


def corrections_join(events: DataFrame, corrections: DataFrame, keys: list[str]) -> DataFrame:
    """Corrections held as a table: keys, op ("delete" or "set"), new_timestamp.

    For long correction lists; one join instead of one condition per entry.
    """
    fixes = corrections.select(*keys, F.col("op").alias("_op"), F.col("new_timestamp").alias("_new"))
    kind = events.schema["@timestamp"].dataType
    return (
        events.join(fixes, keys, "left")
        .filter(S.not_equal("_op", "delete"))
        .withColumn(
            "@timestamp",
            F.when(F.col("_op").eqNullSafe("set"), F.col("_new").cast(kind)).otherwise(
                F.col("@timestamp")
            ),
        )
        .drop("_op", "_new")
    )


def exclude_by_last_state(
    events: DataFrame, plans: tuple[str, ...] = specs.EXCLUDED_PLANS,
    order: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """Drop every event of companies whose last plan is excluded."""
    last = A.with_keys(events, "company").groupBy("company").agg(
        A.last_value("plan", *order).alias("_plan")
    )
    gone = last.filter(F.col("_plan").isin(*plans)).select("company")
    return events.join(gone, "company", "left_anti")


def clean_lifecycle(
    events: DataFrame, corrections: list[specs.Correction] = (),
    order: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """Scanned events to analysable ones: corrections, identical rows, switch
    actions, companies that left for an excluded plan, test companies."""
    events = apply_corrections(events, list(corrections)).dropDuplicates()
    events = exclude_values(events, {"action": specs.SWITCH_ACTIONS})
    events = exclude_by_last_state(events, order=order)
    return exclude_values(
        events,
        {"company_name": specs.TEST_COMPANY_NAMES, "plan": ("aplicateca2", "aplicateca5")},
    )


def signup_cohort(events: DataFrame, basic: str | int = "basic") -> DataFrame:
    """Companies with an initial sign-up for the basic plan, which `basic`
    gives by name or by ordinal."""
    return (
        events.filter((F.col("action") == specs.SIGNUP) & (F.col("plan") == F.lit(basic)))
        .select("company")
        .distinct()
    )


def members(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows whose key is listed; a missing key is not."""
    return df.join(_as_key(keys, key or on, on), on, "left_semi")


def non_members(df: DataFrame, keys: DataFrame, on: str, key: str | None = None) -> DataFrame:
    """Rows whose key is not listed; a missing key is kept."""
    return df.join(_as_key(keys, key or on, on), on, "left_anti")


def _as_key(keys: DataFrame, key: str, on: str) -> DataFrame:
    return keys.select(F.col(key).alias(on))


def drop_keys(df: DataFrame, on: str, keys: list) -> DataFrame:
    """Drop a short list of known-bad keys given in code."""
    return df.filter(S.not_equal(on, *keys)) if keys else df


def in_period(
    df: DataFrame, ym: str = "timestamp_ym", start: str | None = None, before: str | None = None,
    at: str | None = None,
) -> DataFrame:
    """yyyymm bounds: start inclusive, before exclusive.

    With `at`, the timestamp behind the month, the bounds are also put on it as
    literals, which reach the scan of a table that isn't partitioned; on a
    table that stores the month as a partition they prune partitions.
    """
    for bound, holds in ((start, lambda c, v: c >= v), (before, lambda c, v: c < v)):
        if bound:
            df = df.filter(holds(F.col(ym), F.lit(bound)))
            if at:
                df = df.filter(holds(F.col(at), F.lit(f"{bound[:4]}-{bound[4:]}-01").cast("timestamp")))
    return df


def fill_constants(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Constant per column for missing values."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(fills[c]).cast(df.schema[c].dataType)).alias(c)
            if c in fills else F.col(c)
            for c in df.columns
        ]
    )


def fill_from(df: DataFrame, fills: dict[str, tuple[str, int]]) -> DataFrame:
    """Missing values from another column times a sign."""
    return df.select(
        *[
            F.coalesce(F.col(c), F.col(fills[c][0]) * F.lit(fills[c][1])).alias(c)
            if c in fills else F.col(c)
            for c in df.columns
        ]
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without any missing value."""
    return df.na.drop("any")


def project_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select columns under new names, in the given order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def improbable(scores: DataFrame, key: str, probability: str, below: float, year: str) -> DataFrame:
    """Rows of one year scored under a probability."""
    return scores.filter((F.col(probability) < below) & F.col(key).contains(year))
