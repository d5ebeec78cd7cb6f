"""Transaction features per party.

Every transaction becomes two rows, one for its sender and one for its
receiver. All additive features are then conditional aggregates of a single
grouping, combined before the shuffle; a party holding a large share of the
rows sends one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions import scalars as S
from cohortry.functions.quantiles import checked, quantiles
from cohortry.functions.scale import materialized

KEY = "xin_value"
SENT, REC = "sent", "rec"
ROLES = (SENT, REC)
ORDER = ("timestamp", "id")


def party_rows(tx: DataFrame, *columns: str) -> DataFrame:
    """One row per (transaction, role): party id, partner, role, and the
    requested transaction columns. Rows without a party are dropped."""
    side = lambda party, partner, role: F.struct(
        F.col(party).alias(KEY), F.col(partner).alias("partner"), F.lit(role).alias("role")
    )
    sides = F.array(
        side("sender_xin_value", "receiver_xin_value", SENT),
        side("receiver_xin_value", "sender_xin_value", REC),
    )
    return A.with_keys(tx.select(F.explode(sides).alias("_side"), *columns).select("_side.*", *columns), KEY)


def _is(role: str) -> Column:
    return F.col("role") == role


def amount() -> Column:
    return F.abs(F.col("import"))


def cents() -> Column:
    """Amount as a whole number, so that medians are exact."""
    return (amount().cast(T.DecimalType(18, 2)) * 100).cast("bigint")


# -- aggregate lists shared with the snapshot panel -----------------------

def plan_counts() -> list[Column]:
    return [A.tally(F.col("company_plan") == p).alias(f"plan_{p}") for p in (0, 1, 2)]


def success_counts() -> list[Column]:
    return [
        A.tally(S.is_success()).alias("success_true"),
        A.tally(S.is_failure()).alias("success_false"),
    ]


def international_counts() -> list[Column]:
    flag = F.col("international").cast("int")
    return [
        A.total(flag, _is(role)).cast("bigint").alias(f"international_{role}") for role in ROLES
    ]


def tx_counts() -> list[Column]:
    names = {SENT: "trans_sum_sent", REC: "trans_sum_received"}
    return [A.tally(_is(role)).alias(name) for role, name in names.items()]


def amount_totals() -> list[Column]:
    cols = []
    for role in ROLES:
        largest = F.coalesce(F.max(F.when(_is(role), amount())), F.lit(0).cast("decimal(18,2)"))
        cols += [
            largest.alias(f"import_max_{role}"),
            A.total(amount(), _is(role)).alias(f"import_sum_{role}"),
        ]
    return cols


ADDITIVE_INPUT = ("company_plan", "success", "state", "international", "import")


def additive() -> list[Column]:
    return plan_counts() + success_counts() + international_counts() + tx_counts() + amount_totals()


# How the additive features combine when periods are merged into a window.
MERGE = {"import_max_sent": F.max, "import_max_rec": F.max}


def last_plans() -> list[Column]:
    names = {SENT: "last_trans_plan", REC: "last_trans_plan_rec"}
    return [
        A.last_value("company_plan", *ORDER, where=_is(role)).alias(name)
        for role, name in names.items()
    ]


def last_times() -> list[Column]:
    return [F.max(F.when(_is(role), F.col("timestamp"))).alias(f"last_{role}") for role in ROLES]


# -- whole-history features -----------------------------------------------

def tx_by_plan(tx: DataFrame) -> DataFrame:
    """Transactions per plan, both roles together."""
    return party_rows(tx, "company_plan").groupBy(KEY).agg(*plan_counts())


def last_tx_plan(tx: DataFrame) -> DataFrame:
    """Plan of the latest transaction as sender and as receiver."""
    last = party_rows(tx, "company_plan", *ORDER).groupBy(KEY).agg(*last_plans())
    return last.withColumn("last_trans_plan", F.coalesce("last_trans_plan", F.lit(-1)))


def is_listed() -> Column:
    """The party has a part of its own: it received a received transaction or
    sent a sent one."""
    return (_is(SENT) & S.is_sent()) | (_is(REC) & S.is_received())


def partner_pairs(tx: DataFrame, *more: Column) -> DataFrame:
    """(party, role, partner) with a flag per half: the partner was met in a
    sent, in a received transaction. One row per pair however often the two
    traded, so even a party in a third of all rows is spread by its partners.

    What holds for a sender and its receiver holds for the receiver and its
    sender, so pairs are grouped once and turned round afterwards.
    """
    pairs = (
        tx.filter(S.is_sent() | S.is_received())
        .groupBy("sender_xin_value", "receiver_xin_value")
        .agg(F.max(S.is_sent()).alias("sent_half"), F.max(S.is_received()).alias("rec_half"), *more)
    )
    own = [c for c in pairs.columns if c not in ("sender_xin_value", "receiver_xin_value")]
    return party_rows(pairs, *own)


def distinct_counterparties(tx: DataFrame, senders_only: bool = False) -> DataFrame:
    """Distinct receivers and senders. A partner met in both halves counts
    twice. senders_only keeps just the parties that sent something."""
    both = F.col("sent_half").cast("int") + F.col("rec_half").cast("int")
    met = F.col("partner").isNotNull()
    listed = (_is(SENT) & F.col("sent_half"))
    if not senders_only:
        listed = listed | (_is(REC) & F.col("rec_half"))
    return (
        partner_pairs(tx)
        .groupBy(KEY)
        .agg(
            A.total(both, _is(SENT) & met).cast("bigint").alias("num_receivers"),
            A.total(both, _is(REC) & met).cast("bigint").alias("num_senders"),
            F.max(listed).alias("_listed"),
        )
        .filter("_listed")
        .drop("_listed")
    )


def tx_success(tx: DataFrame) -> DataFrame:
    """Successes and failures, both roles together."""
    return party_rows(tx, "success", "state").groupBy(KEY).agg(*success_counts())


def international(tx: DataFrame) -> DataFrame:
    return party_rows(tx, "international").groupBy(KEY).agg(*international_counts())


def modal_channels(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent channel per role from counted (keys, role, channel, n)."""
    rank = F.struct(-F.col("n"), F.col("channel"))
    return rows.groupBy(*keys).agg(
        *[F.min_by("channel", F.when(_is(role), rank)).alias(f"channel_{role}") for role in ROLES]
    )


def channel_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per (keys, role, channel): few rows even for a hot party."""
    return (
        rows.filter(F.col("channel").isNotNull())
        .groupBy(*keys, "role", "channel")
        .agg(F.count("*").alias("n"))
    )


def modal_channel(tx: DataFrame) -> DataFrame:
    """Most frequent channel as sender and receiver; missing if none known."""
    rows = party_rows(tx, "channel")
    known = modal_channels(channel_counts(rows, [KEY]), [KEY])
    return rows.select(KEY).distinct().join(known, KEY, "left")


def channel_summary(tx: DataFrame) -> DataFrame:
    """International counts and modal channels side by side."""
    return international(tx).join(modal_channel(tx), KEY, "full")


def frequency(tx: DataFrame) -> DataFrame:
    return party_rows(tx).groupBy(KEY).agg(*tx_counts())


MONTHLY_NAMES = {
    SENT: ("trans_med_sent", "trans_max_sent"), REC: ("trans_med_received", "trans_max_received"),
}


def monthly_stats() -> list[Column]:
    """Median and maximum of monthly counts (column n)."""
    cols = []
    for role, (median, largest) in MONTHLY_NAMES.items():
        n = F.when(_is(role), F.col("n"))
        cols += [
            F.coalesce(F.median(n), F.lit(0.0)).alias(median),
            F.coalesce(F.max(n), F.lit(0)).alias(largest),
        ]
    return cols


def monthly_count_stats(tx: DataFrame) -> DataFrame:
    """Median and maximum of the monthly counts; a party has one count per
    month and role, so the median never sees more rows than months."""
    counts = party_rows(tx, "timestamp_ym").groupBy(KEY, "role", "timestamp_ym").agg(
        F.count("*").alias("n")
    )
    return counts.groupBy(KEY).agg(*monthly_stats())


def _role_medians(tx: DataFrame, names: dict[str, str], hot_rows: int) -> DataFrame:
    rows = party_rows(tx, "import").select(KEY, "role", cents().alias("cents"))
    medians = quantiles(rows, [KEY, "role"], "cents", {"m": 0.5}, hot_rows)
    return medians.groupBy(KEY).agg(
        *[F.max(F.when(_is(role), F.col("m") / 100)).alias(name) for role, name in names.items()]
    )


def amount_stats(tx: DataFrame, hot_rows: int = specs.HOT_ROWS) -> DataFrame:
    """Median, maximum and sum of the absolute amount per role.

    Sizes, maxima and sums come from one pass, which also tells the groups that are
    too large for one task; medians look at the amounts once more.
    """
    rows = party_rows(tx, "import")
    keys = [KEY, "role"]
    totals = materialized(rows.groupBy(*keys).agg(
        F.count(cents()).alias("_n"), F.max(amount()).alias("max"), F.sum(amount()).alias("sum")
    ))
    hot = checked(totals.filter(F.col("_n") > hot_rows).select(*keys))
    medians = quantiles(rows.select(*keys, cents().alias("cents")), keys, "cents", {"m": 0.5}, hot_rows, hot)
    zero = F.lit(0).cast("decimal(18,2)")
    sides = totals.groupBy(KEY).agg(*[
        col for role in ROLES for col in (
            F.coalesce(F.max(F.when(_is(role), F.col("max"))), zero).alias(f"import_max_{role}"),
            A.total("sum", _is(role)).alias(f"import_sum_{role}"),
        )
    ])
    middles = medians.groupBy(KEY).agg(
        *[F.max(F.when(_is(role), F.col("m") / 100)).alias(f"import_med_{role}") for role in ROLES]
    )
    return sides.join(middles, KEY, "left").na.fill(0.0, [f"import_med_{role}" for role in ROLES])


def lifetime_median_amount(tx: DataFrame, hot_rows: int = specs.HOT_ROWS) -> DataFrame:
    """Median absolute amount over the whole history, missing if no tx."""
    return _role_medians(tx, {role: f"med_import_{role}_t" for role in ROLES}, hot_rows)


def recency_days(tx: DataFrame, snapshot: Column) -> DataFrame:
    """Calendar days from the last transaction to the snapshot date."""
    last = party_rows(tx, "timestamp").groupBy(KEY).agg(*last_times())
    return last.select(KEY, *recency_columns(snapshot))


def recency_columns(snapshot: Column) -> list[Column]:
    return [
        S.calendar_days(snapshot, "last_sent").alias("days_from_last_transaction"),
        S.calendar_days(snapshot, "last_rec").alias("days_from_last_transaction_rec"),
    ]
