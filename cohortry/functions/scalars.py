"""Column expressions: null-aware comparison, dates, plans and channels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortry import specs


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_equal(c: Column | str, *values) -> Column:
    """True unless c is one of the values; a missing c is kept."""
    c = as_column(c)
    return reduce(lambda a, b: a & b, [~c.eqNullSafe(F.lit(v)) for v in values])


def is_true(c: Column) -> Column:
    """A condition with missing taken as false."""
    return F.coalesce(c, F.lit(False))


# -- dates ---------------------------------------------------------------

def year_month(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyyMM")


def period_index(ts: Column | str, grain: str = "month") -> Column:
    """Consecutive integer number of the period a timestamp falls in."""
    ts = as_column(ts)
    if grain == "month":
        return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")
    if grain == "quarter":
        return (F.year(ts) * 4 + F.quarter(ts) - 1).cast("int")
    raise ValueError(f"unknown grain {grain!r}")


def year_month_index(ym: Column | str) -> Column:
    """yyyymm to the month number used by period_index."""
    n = as_column(ym).cast("int")
    return (F.floor(n / 100) * 12 + n % 100 - 1).cast("int")


def period_end(index: Column | str, grain: str = "month") -> Column:
    """First day after the period: the date a snapshot is taken."""
    months = as_column(index) + 1 if grain == "month" else (as_column(index) + 1) * 3
    return F.make_date(F.floor(months / 12).cast("int"), (months % 12 + 1).cast("int"), F.lit(1))


def period_label(index: Column | str, grain: str = "month") -> Column:
    """yyyymm of the period's last month, by arithmetic: a date formatted for each row is slow."""
    months = as_column(index) if grain == "month" else as_column(index) * 3 + 2
    year = F.floor(months / 12)
    usual = (year * 100 + months % 12 + 1).cast("string")
    return F.when(year.between(1000, 9999), usual).otherwise(
        F.date_format(F.date_sub(period_end(index, grain), 1), "yyyyMM")
    )


def snapshot_date(ym: Column | str) -> Column:
    """First day of the month after yyyymm."""
    return F.add_months(F.to_date(as_column(ym), "yyyyMM"), 1)


def calendar_days(end: Column | str, start: Column | str) -> Column:
    """Difference of the calendar dates, whatever the time of day."""
    return F.datediff(F.to_date(as_column(end)), F.to_date(as_column(start)))


def elapsed_days(end: Column | str, start: Column | str) -> Column:
    """Whole days of elapsed time, rounded down (so -1 hour is -1 day)."""
    seconds = F.unix_micros(as_column(end).cast("timestamp")) - F.unix_micros(
        as_column(start).cast("timestamp")
    )
    return F.floor(seconds / F.lit(86_400_000_000)).cast("bigint")


def minus_days(ts: Column | str, days: int) -> Column:
    return as_column(ts) - F.make_dt_interval(F.lit(days))


def minus_months(ts: Column | str, months: int) -> Column:
    """Same time of day `months` earlier, clamped to the month's last day."""
    return as_column(ts) - F.make_ym_interval(F.lit(0), F.lit(months))


def utc_timestamp(c: Column | str) -> Column:
    return F.to_timestamp(as_column(c))


# -- codes ---------------------------------------------------------------

def plan_ordinal(plan: Column | str) -> Column:
    """Plan name to its ordinal; missing is -1, an unknown name is an error."""
    plan = as_column(plan)
    chain = F.when(plan.isNull(), F.lit(-1))
    for name, ordinal in specs.PLAN_ORDINALS.items():
        chain = chain.when(plan == name, F.lit(ordinal))
    ordinals = [str(n) for n in (-1, *specs.PLAN_ORDINALS.values())]
    unknown = F.raise_error(F.concat(F.lit("unknown plan name: "), plan.cast("string"))).cast("int")
    return chain.when(plan.cast("string").isin(*ordinals), plan.try_cast("int")).otherwise(unknown).cast("int")


def channel_group(channel: Column | str, groups: dict | None = None) -> Column:
    """Raw channel code to its group; codes of no group pass through.

    Each group is one IN list, which Spark evaluates as a hash-set probe
    inside generated code, so no join is needed.
    """
    channel = as_column(channel)
    chain = F
    for group, codes in (groups or specs.CHANNEL_GROUPS).items():
        chain = chain.when(channel.isin(*codes), F.lit(group))
    return chain.otherwise(channel)


def dominant_channel(suffix: str = "_acum") -> Column:
    """Channel with the largest flag, first listed on ties."""
    flags = {name + suffix: name for name in specs.CHANNEL_FLAGS}
    top = F.greatest(*flags)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in flags])
    chain = F.when(total == 0, F.lit("no channel"))
    for flag in flags:
        chain = chain.when(F.col(flag) == top, F.lit(flag))
    return chain


def tenure_years(days: Column | str) -> Column:
    """0 below 180 days, otherwise the years begun."""
    days = as_column(days)
    return F.when(days < 180, F.lit(0)).otherwise(F.ceil(days / 365)).cast("bigint")


def surrogate_party_id(party: Column | str, company: Column | str) -> Column:
    """A party id for companies without one, the same on every run."""
    digest = F.sha2(as_column(company).cast("string"), 256)
    return F.coalesce(as_column(party), F.concat(F.lit("IN"), F.upper(F.substring(digest, 1, 9))))


def composite_key(company: Column | str, ym: Column | str) -> Column:
    return F.concat_ws("-", as_column(company).cast("string"), as_column(ym))


# -- transaction predicates ----------------------------------------------

def is_sent(state="state", kind="kind") -> Column:
    return is_true(F.col(state) == "sent") | is_true(F.col(kind) == "issue")


def is_received(state="state", kind="kind") -> Column:
    return is_true(F.col(state) == "received") | is_true(F.col(kind) == "reception")


def is_success(success="success", state="state") -> Column:
    """success is true, or it is missing and the state is no failure."""
    ok, bad = F.col(success), F.col(state).isin(*specs.FAILED_STATES)
    return is_true(ok) | (ok.isNull() & ~is_true(bad))


def is_failure(success="success", state="state") -> Column:
    """success is false, or the state is a failure.

    'refused' counts only while success is not true; the other failure
    states count even then, so such a row is both a success and a failure.
    """
    ok, state = F.col(success), F.col(state)
    others = [s for s in specs.FAILED_STATES if s != "refused"]
    return (
        is_true(~ok)
        | (~is_true(ok) & is_true(state == "refused"))
        | is_true(state.isin(*others))
    )


def has_peppol_channel(channel="channel_original") -> Column:
    return F.coalesce(F.col(channel), F.lit("")).contains("peppol")


def is_outgoing(channel="channel_original") -> Column:
    """The recording company is the sender."""
    return ~has_peppol_channel(channel) & is_sent()


def is_incoming(channel="channel_original") -> Column:
    """The recording company is the receiver."""
    settled = is_true(F.col("kind") == "issue") & is_true(
        F.col("state").isin("paid", "accepted")
    )
    return ~has_peppol_channel(channel) & (is_received() | settled)
