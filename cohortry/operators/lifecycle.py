"""Company tables derived from lifecycle events (plans as ordinals)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions import scalars as S
from cohortry.operators.cleaning import EVENT_ORDER

TS = "@timestamp"


def _is_premium() -> Column:
    return S.is_true(F.col("plan").isin(*specs.PREMIUM_PLANS))


def _by_company(events: DataFrame):
    return A.with_keys(events, "company").groupBy("company")


def first_signup(events: DataFrame) -> DataFrame:
    """First sign-up and first premium sign-up or upgrade, in one pass."""
    signup = F.col("action") == specs.SIGNUP
    premium = _is_premium() & F.col("action").isin(specs.SIGNUP, specs.UPGRADE)
    return (
        _by_company(events.filter(signup | premium))
        .agg(
            F.min(F.when(signup, F.col(TS))).alias("data_alta_basic"),
            F.min(F.when(premium, F.col(TS))).alias("data_alta_premium"),
        )
    )


REGISTRY_COLUMNS = [
    "country", "date_first_client", "date_first_invoice", "number_clients", "postal_code",
    "company_name", "xin_value",
]


def company_master(
    events: DataFrame, registry: DataFrame, order: tuple[str, ...] = EVENT_ORDER
) -> DataFrame:
    """One row per company: sign-ups, registry data, waiting times, active flag."""
    known = registry.select(F.col("company_id").alias("company"), *REGISTRY_COLUMNS)
    since = lambda c: S.elapsed_days(c, "data_alta_basic")
    return (
        first_signup(events)
        .join(known, "company", "left")
        .withColumn("days_until_premium", since("data_alta_premium"))
        .withColumn("days_until_invoice", since("date_first_invoice"))
        .withColumn("days_until_client", since("date_first_client"))
        .join(active_premium(events, order), "company", "left")
    )


def churn_premium(events: DataFrame, order: tuple[str, ...] = EVENT_ORDER) -> DataFrame:
    """Companies whose last paid premium event ends the subscription.

    One pass: the last values look at premium events outside the demo only,
    the first sign-up at all premium sign-ups.
    """
    paid = S.not_equal("payment_type", specs.DEMO_PAYMENT)
    signup = F.col("action") == specs.SIGNUP
    per_company = _by_company(events.filter(_is_premium())).agg(
        A.last_value(TS, *order, where=paid).alias("data_baixa_prem"),
        A.last_value("action", *order, where=paid).alias("_action"),
        A.last_value("plan", *order, where=paid).alias("churn_plan"),
        F.min(F.when(signup, F.col(TS))).alias("_alta"),
    )
    return per_company.filter(F.col("_action").isin(*specs.PREMIUM_END_ACTIONS)).select(
        "company",
        "data_baixa_prem",
        S.elapsed_days("data_baixa_prem", "_alta").alias("days_active_prem"),
        "churn_plan",
        F.lit(1).alias("churn"),
    )


def churn_basic(events: DataFrame, order: tuple[str, ...] = EVENT_ORDER) -> DataFrame:
    """Companies whose last basic event is a cancellation."""
    return (
        _by_company(events.filter(F.col("plan") == 0))
        .agg(*[A.last_value(c, *order).alias(c) for c in (TS, "action", "plan")])
        .filter(F.col("action") == specs.CANCEL)
    )


def last_state(
    events: DataFrame, columns: tuple[str, ...] = ("action", "plan"),
    order: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """Last non-missing value of each column per company."""
    return _by_company(events).agg(*[A.last_value(c, *order).alias(c) for c in columns])


def last_plan(events: DataFrame, order: tuple[str, ...] = EVENT_ORDER) -> DataFrame:
    return last_state(events, ("plan",), order).withColumnRenamed("plan", "actual_plan")


def active_premium(events: DataFrame, order: tuple[str, ...] = EVENT_ORDER) -> DataFrame:
    """Companies now on a paid premium plan."""
    return (
        last_state(events, ("action", "plan", "payment_type"), order)
        .filter(
            F.col("action").isin(*specs.ACTIVE_ACTIONS)
            & F.col("plan").isin(*specs.PREMIUM_PLANS)
            & S.not_equal("payment_type", specs.DEMO_PAYMENT)
        )
        .select("company", F.lit(1).alias("active_prem"))
    )


def plan_asof(
    events: DataFrame, snapshots: Column, grain: str = "month",
    order: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """Plan of every company as of each snapshot from its first event on.

    Events are reduced to one row per (company, period) before any window, so
    a window holds at most as many rows as there are periods.
    """
    filled = _plan_changes(events, grain, order)
    return carry_forward(filled, ["company"], "period", snapshots).drop("period")


def _plan_changes(events: DataFrame, grain: str, order: tuple[str, ...]) -> DataFrame:
    per_period = (
        A.with_keys(events, "company")
        .withColumn("period", S.period_index(TS, grain))
        .groupBy("company", "period")
        .agg(A.last_value("plan", *order).alias("_plan"))
    )
    w = W.partitionBy("company").orderBy("period")
    return per_period.withColumn("actual_plan", F.last("_plan", ignorenulls=True).over(w)).drop("_plan")


def plans_asof(
    events: DataFrame, snapshots: Column, grain: str = "month",
    order: tuple[str, ...] = EVENT_ORDER,
) -> DataFrame:
    """plan_asof() as one row per company: the place of its first snapshot in the
    list of all, _begin, and its plans from there on, _plans, no longer than the calendar."""
    changes = _plan_changes(events, grain, order).filter("period IS NOT NULL").groupBy("company").agg(
        F.min("period").alias("_since"),
        F.sort_array(F.collect_list(F.struct("period", "actual_plan"))).alias("_changes"),
    )
    begin = place(changes, snapshots)("_since")
    upto = lambda s: F.element_at(F.filter("_changes", lambda c: c["period"] <= s), -1)["actual_plan"]
    later = F.slice(snapshots, begin + 1, F.greatest(F.size(snapshots) - begin, F.lit(0)))
    listed = changes.select("company", "_changes", begin.alias("_begin"), later.alias("_later"))
    return listed.select("company", "_begin", F.transform("_later", upto).alias("_plans"))


def by_period(rows: DataFrame, snapshots: Column, value: Callable[[Column], Column], after: int = 0) -> Column:
    """An array with value(period) for each period from the first snapshot to the last, and `after` more.

    value() may read the array column _snapshots. A scalar subquery like
    `snapshots`: computed once per query and no longer than the calendar, so that
    rows look up what they would else work out from all snapshots.
    """
    calendar = rows.sparkSession.range(1).select(snapshots.alias("_snapshots"))
    periods = F.sequence(F.element_at("_snapshots", 1), F.element_at("_snapshots", -1) + after)
    lists = F.when(F.size("_snapshots") > 0, F.transform(periods, value))
    return calendar.select(lists.alias("_lists")).scalar()


def place(rows: DataFrame, snapshots: Column) -> Callable[[str], Column]:
    """Number of snapshots before a period, which may lie outside of the calendar."""
    earlier = by_period(rows, snapshots, lambda p: F.size(F.filter("_snapshots", lambda s: s < p)), after=1)
    first, last = F.get(snapshots, F.lit(0)), F.get(snapshots, F.size(snapshots) - 1)
    return lambda c: F.get(earlier, F.least(F.greatest(F.col(c), first), last + 1) - first)


def carry_forward(
    states: DataFrame, keys: list[str], period: str, snapshots: Column
) -> DataFrame:
    """Repeat each state for the snapshots until the key's next state; adds
    "snapshot", keeps the period the state is from."""
    w = W.partitionBy(*keys).orderBy(period)
    before = place(states, snapshots)
    until = F.when(F.col("_next").isNull(), F.size(snapshots)).otherwise(before("_next"))
    return (
        states.withColumn("_next", F.lead(period).over(w))
        .filter(F.col(period).isNotNull())
        .withColumns({"_from": before(period), "_upto": until})
        .withColumn("snapshot", F.explode(F.slice(snapshots, F.col("_from") + 1, F.greatest(F.col("_upto") - F.col("_from"), F.lit(0)))))
        .drop("_next", "_from", "_upto")
    )
