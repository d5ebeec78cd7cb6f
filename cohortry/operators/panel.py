"""The snapshot panel: one row per (company, party id, period).

There is no loop over snapshots. Transactions are reduced once to one row per
(party, period), which is stored; windows over several periods and states as
of a period are derived from that table. Only medians and distinct partners
look at the transactions again, once each.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions import quantiles as Q
from cohortry.functions import scalars as S
from cohortry.functions.scale import materialized
from cohortry.operators import lifecycle, party, running
from cohortry.operators.party import KEY, REC, ROLES, SENT
from cohortry.specs import SnapshotSpec


def snapshot_list(rows: DataFrame) -> Column:
    """All periods with a transaction, as one array value.

    A scalar subquery: computed once per query, and no larger than the
    calendar. "period" must be a column of rows.
    """
    return rows.select("period").distinct().agg(F.sort_array(F.collect_set("period"))).scalar()


def snapshot_count(tx: DataFrame, spec: SnapshotSpec) -> int:
    """Number of periods with a transaction."""
    return with_period(tx, spec).agg(F.count_distinct("period")).first()[0]


def with_period(tx: DataFrame, spec: SnapshotSpec) -> DataFrame:
    return tx.withColumn("period", S.period_index("timestamp", spec.grain))


def in_window(spec: SnapshotSpec, snapshot: Column, period: Column) -> Column:
    """Does the snapshot's window cover the period?"""
    if not spec.trailing:
        return snapshot == period
    if spec.yyyymm_arithmetic:
        # Literal form: subtracts from the number yyyymm, so a window never
        # reaches back over a year end.
        ym = lambda m: F.floor(m / 12) * 100 + m % 12 + 1
        return (snapshot >= period) & (ym(period) > ym(snapshot) - spec.n_periods)
    return (snapshot >= period) & (snapshot < period + spec.n_periods)


def into_windows(rows: DataFrame, snapshots: Column, spec: SnapshotSpec) -> DataFrame:
    """Rows copied to the snapshots whose window covers them ("snapshot"
    replaces "period"). At most n_periods copies; none for period windows."""
    if not spec.trailing:
        out = rows.withColumnRenamed("period", "snapshot")
        if spec.first_after is None:
            return out
        first = S.year_month_index(F.lit(spec.first_after))
        if spec.grain == "quarter":
            first = F.floor(first / 3)
        early = F.col("snapshot") == F.element_at("_snapshots", 1)
        return (
            out.withColumn("_snapshots", snapshots)
            .filter(~early | (F.col("snapshot") > first))
            .drop("_snapshots")
        )
    # Looked up for each row, instead of comparing the row with every snapshot.
    covered = lifecycle.by_period(rows, snapshots, lambda p: F.filter("_snapshots", lambda s: in_window(spec, s, p)))
    at = F.col("period") - F.get(snapshots, F.lit(0))
    return rows.withColumn("snapshot", F.explode(F.get(covered, at))).drop("period")


def trailing_rows(tx: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Transactions joined to every snapshot whose window covers them."""
    tx = with_period(tx, spec)
    return into_windows(tx, snapshot_list(tx), spec)


# -- one row per (party, period) ------------------------------------------------

def rollup(tx: DataFrame, channels: bool = True, counts_only: bool = False, plans: bool = True, counted: bool = False) -> DataFrame:
    """Everything that can be said about a party's period from that period's
    rows alone, in one pass: additive features, last plans and times, modal
    channels. Windows and states are derived from this much smaller table.
    With counts_only, plans, amounts and successes are left out. Without plans the last
    plans are: their order holds a text, which aggregates by sorting all rows. With counted,
    channels stay as listed_counts()."""
    rows = party.party_rows(tx, "period", *party.ADDITIVE_INPUT, "kind", "channel", *party.ORDER)
    features = party.tx_counts() if counts_only else party.additive()
    if plans and not counts_only:
        features = [*features, *party.last_plans()]
    cols = [
        *features, *party.last_times(),
        F.max(party.is_listed()).alias("_listed"),
        F.max((F.col("role") == SENT) & S.is_sent()).alias("_sender"),
    ]
    if not channels:
        return rows.groupBy(KEY, "period").agg(*cols)
    if counted:
        return rows.groupBy(KEY, "period").agg(*cols, *listed_counts())
    return with_modal_channels(rows, rows.groupBy(KEY, "period").agg(*cols, *listed_counts()))


# Channel groups in the order that decides ties.
LISTED = sorted(specs.CHANNEL_FLAGS.values())


def listed_counts() -> list[Column]:
    """One number per role and listed channel group. Unlike mode() they need no map for each
    group of rows, whose making and storing takes longer than all other features."""
    return [
        A.tally((F.col("role") == r) & (F.col("channel") == name)).alias(f"_{r}_{i}")
        for r in ROLES for i, name in enumerate(LISTED)
    ]


COUNTED = [f"_{r}_{i}" for r in ROLES for i in range(len(LISTED))]


def with_modal_channels(
    rows: DataFrame, rolled: DataFrame, at: str = "period", spread: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Most frequent channels from listed_counts(). Channels of no group, if
    there are any, are counted on their own and compared with the listed ones;
    spread takes their counts per period to `at`."""
    wide = len(LISTED) + 1
    # The number decides; on ties the first name, which has the largest remainder.
    top = {r: F.greatest(*[F.col(f"_{r}_{i}") * wide + (wide - 1 - i) for i in range(len(LISTED))]) for r in ROLES}
    counted = {r: F.floor(top[r] / wide) for r in ROLES}
    names = F.array(*[F.lit(name) for name in LISTED])
    named = {r: F.when(counted[r] > 0, F.get(names, (wide - 1 - top[r] % wide).cast("int"))) for r in ROLES}
    rest = rows.filter(F.col("channel").isNotNull() & ~F.col("channel").isin(*LISTED)).select(KEY, "period", "role", "channel")
    if rest.isEmpty():
        return rolled.withColumns({f"channel_{r}": named[r] for r in ROLES}).drop(*COUNTED)
    rank = lambda n, channel: F.struct((-n).alias("n"), channel.alias("channel"))
    counts = party.channel_counts(rest, [KEY, "period"])
    other = (spread(counts) if spread else counts).groupBy(KEY, at).agg(*[
        F.min(F.when(F.col("role") == r, rank(F.col("n"), F.col("channel")))).alias(f"_other_{r}") for r in ROLES
    ])
    best = {r: F.least(F.when(named[r].isNotNull(), rank(counted[r], named[r])), F.col(f"_other_{r}")) for r in ROLES}
    return rolled.join(other, [KEY, at], "left").withColumns(
        {f"channel_{r}": best[r]["channel"] for r in ROLES}
    ).drop(*COUNTED, *[f"_other_{r}" for r in ROLES])


ADDITIVE = [
    "plan_0", "plan_1", "plan_2", "success_true", "success_false", "international_sent",
    "international_rec", "trans_sum_sent", "trans_sum_received", "import_max_sent",
    "import_sum_sent", "import_max_rec", "import_sum_rec",
]


def window_features(rolled: DataFrame, snapshots: Column, spec: SnapshotSpec) -> DataFrame:
    """Additive features of trailing windows, merged from the periods."""
    windows = into_windows(rolled.select(KEY, "period", *ADDITIVE), snapshots, spec)
    return windows.groupBy(KEY, "snapshot").agg(
        *[party.MERGE.get(c, F.sum)(c).alias(c) for c in ADDITIVE]
    )


def window_monthly_stats(rolled: DataFrame, snapshots: Column, spec: SnapshotSpec) -> DataFrame:
    """Median and maximum of the counts of the window's periods."""
    sides = F.array(
        F.struct(F.lit(SENT).alias("role"), F.col("trans_sum_sent").alias("n")),
        F.struct(F.lit(REC).alias("role"), F.col("trans_sum_received").alias("n")),
    )
    counts = rolled.select(KEY, "period", F.explode(sides).alias("_s")).select(KEY, "period", "_s.*")
    return into_windows(counts.filter("n > 0"), snapshots, spec).groupBy(KEY, "snapshot").agg(
        *party.monthly_stats()
    )


def window_channels(tx: DataFrame, snapshots: Column, spec: SnapshotSpec) -> DataFrame:
    """Modal channels per (party, snapshot), from counts per channel."""
    rows = party.party_rows(tx, "period", "channel")
    counts = channels_into_windows(party.channel_counts(rows, [KEY, "period"]), snapshots, spec)
    return party.modal_channels(counts, [KEY, "snapshot"])


def channels_into_windows(counts: DataFrame, snapshots: Column, spec: SnapshotSpec) -> DataFrame:
    counts = into_windows(counts, snapshots, spec)
    if spec.trailing:
        counts = counts.groupBy(KEY, "snapshot", "role", "channel").agg(F.sum("n").alias("n"))
    return counts


# -- medians --------------------------------------------------------------------

LIFETIME = {r: f"med_import_{r}_t" for r in ROLES}
WINDOW = {r: f"import_med_{r}" for r in ROLES}


def amounts(tx: DataFrame) -> DataFrame:
    return party.party_rows(tx, "period", "import", "company_plan", *party.ORDER).select(
        KEY, "role", "period", party.cents().alias("cents"), "company_plan", *party.ORDER
    )


def hot_parties(rolled: DataFrame, hot_rows: int) -> Q.Hot | None:
    """(party, role) groups over hot_rows rows, or None if there are none.
    Counted on the rollup, not on the transactions."""
    counts = rolled.groupBy(KEY).agg(
        F.sum("trans_sum_sent").alias(SENT), F.sum("trans_sum_received").alias(REC)
    )
    named = [F.when(F.col(r) > hot_rows, F.lit(r)) for r in ROLES]
    hot = counts.select(KEY, F.explode(F.array(*named)).alias("role")).filter("role IS NOT NULL")
    return Q.checked(hot)


def _by_role(medians: DataFrame, at: str, names: dict[str, dict[str, str]]) -> DataFrame:
    return medians.groupBy(KEY, at).agg(
        *[
            F.max(F.when(F.col("role") == role, F.col(value) if value == "plan" else F.col(value) / 100)).alias(name)
            for value, by_role in names.items()
            for role, name in by_role.items()
        ]
    )


def window_medians(
    values: DataFrame, snapshots: Column, spec: SnapshotSpec, hot: Q.Hot | None = None
) -> DataFrame:
    """Median amount of each window. `hot` lists (party, role) groups too
    large for one task; their values are counted into buckets instead."""
    keys = [KEY, "role"]

    def plain(df: DataFrame) -> DataFrame:
        return into_windows(df, snapshots, spec).groupBy(*keys, "snapshot").agg(
            F.percentile("cents", F.lit(0.5)).alias("window")
        )

    if hot is None:
        medians = plain(values)
    else:
        medians = plain(hot.rest(values, keys)).unionByName(
            Q.narrowed_quantiles(
                hot.rows(values, keys), keys, "cents", {"window": 0.5}, period="period",
                spread=lambda df: into_windows(df, snapshots, spec), few=hot.few,
            )
        )
    return _by_role(medians, "snapshot", {"window": WINDOW})


# A role and a period as one number, in the order of both.
SIDE = 1 << 40
STATES = {"lifetime": LIFETIME, "window": WINDOW, "plan": {SENT: "last_trans_plan", REC: "last_trans_plan_rec"}}


def growing_states(n_periods: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per party, role and period: median of all amounts up to it and of its own, and its last plan.

    Rows (party, at, cents, plan) come in that order, `at` being role and period as one
    number. Of a party and role the amounts so far stay sorted, so a period costs no more
    than merging its own into them. Rows of a batch's last period wait for the next batch.
    With more than one period, the second median is that of the n_periods up to a period;
    periods without rows whose window has some come too, with this median alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, party_id, role, grown, recent = None, None, None, [], []
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                rows = kept
            else:
                rows = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            if rows is None or not rows.num_rows:
                continue
            rows = rows.combine_chunks()
            codes = rows.column(0).chunk(0).dictionary_encode().indices.to_numpy()
            at = rows.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (at[1:] != at[:-1])])
            ends = np.r_[starts[1:], len(at)]
            # Periods up to the next one with rows, of the same party and role.
            alone = (codes[starts][1:] != codes[starts][:-1]) | (np.diff(at[starts]) > SIDE // 2)
            ahead = np.r_[np.where(alone, n_periods, np.minimum(np.diff(at[starts]), n_periods)), n_periods]
            if batch is not None:
                kept, starts, ends, ahead = rows.slice(starts[-1]), starts[:-1], ends[:-1], ahead[:-1]
            if not len(starts):
                continue
            parties, roles = codes[starts], (at[starts] + SIDE // 2) // SIDE
            fresh = np.r_[True, (parties[1:] != parties[:-1]) | (roles[1:] != roles[:-1])]
            fresh[0] = (rows.column(0)[0].as_py(), roles[0]) != (party_id, role)
            party_id, role = rows.column(0)[int(starts[-1])].as_py(), roles[-1]
            cents = rows.column(2).chunk(0)
            if cents.null_count:
                values = cents.to_pylist()
            else:
                values = cents.to_numpy().tolist()
            middles, more = [], []
            for first, start, end, gap in zip(fresh.tolist(), starts.tolist(), ends.tolist(), ahead.tolist()):
                if first:
                    grown, recent = [], []
                own = values[start:end]
                if cents.null_count:
                    own = [v for v in own if v is not None]
                if len(own) < 32:
                    if len(own) > 1:
                        own.sort()
                    for v in own:
                        bisect.insort(grown, v)
                else:
                    own.sort()
                    grown.extend(own)
                    grown.sort()
                n, k = len(grown), len(own)
                here = own
                if n_periods > 1:
                    now = int(at[start])
                    recent = [x for x in recent if x[0] > now - n_periods] + [(now, own)]
                    here = window_of(recent)
                    for later in range(now + 1, now + gap):
                        held = window_of([x for x in recent if x[0] > later - n_periods])
                        more.append((start, later, *((held[(len(held) - 1) // 2], held[len(held) // 2]) if held else (None, None))))
                m = len(here)
                middles.append((
                    *((grown[(n - 1) // 2], grown[n // 2]) if k else (None, None)),
                    *((here[(m - 1) // 2], here[m // 2]) if m else (None, None)),
                ))
            pairs = np.array(middles, dtype=float).reshape(-1, 4)
            halves = (pairs[:, ::2] + pairs[:, 1::2]) / 2
            found = rows.select([0, 1]).take(starts)
            yield pa.RecordBatch.from_arrays([
                found.column(0).combine_chunks(), found.column(1).combine_chunks(),
                pa.array(halves[:, 0], from_pandas=True), pa.array(halves[:, 1], from_pandas=True),
                rows.column(3).take(ends - 1).combine_chunks(),
            ], names=["party", "at", "lifetime", "window", "plan"])
            if more:
                whose, later, low, high = zip(*more)
                halves = (np.array(low, dtype=float) + np.array(high, dtype=float)) / 2
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(np.array(whose)).combine_chunks(), pa.array(later, pa.int64()),
                    pa.nulls(len(more), pa.float64()), pa.array(halves, from_pandas=True), pa.nulls(len(more), rows.column(3).type),
                ], names=["party", "at", "lifetime", "window", "plan"])

    return run


def window_of(recent: list[tuple[int, list]]) -> list:
    """The sorted values of a few periods, each of which has its own sorted."""
    if len(recent) == 1:
        return recent[0][1]
    return sorted(itertools.chain.from_iterable(own for _, own in recent))


def period_medians(values: DataFrame, snapshots: Column, hot: Q.Hot | None = None, spec: SnapshotSpec = SnapshotSpec()) -> DataFrame:
    """Per active (party, period): median of the amounts in its window, the period or the
    trailing ones, and of all amounts up to it, and the period's last plans. Trailing
    windows also have rows for periods that they reach from an earlier one.

    They need a party's rows together and in order, so they share one shuffle and sort.
    """
    keys = [KEY, "role"]
    values = values.filter("period IS NOT NULL")

    def plain(df: DataFrame) -> DataFrame:
        at = F.when(F.col("role") == REC, F.lit(SIDE)).otherwise(F.lit(0)) + F.col("period")
        dealt = df.select(KEY, at.cast("bigint").alias("at"), "cents", F.col("company_plan").cast("int").alias("plan"), *party.ORDER)
        # Rows without a plan come first, so that a period's last row has its last plan.
        ordered = dealt.repartition(KEY).sortWithinPartitions(KEY, "at", F.col("plan").isNotNull(), *party.ORDER)
        found = ordered.select(KEY, "at", "cents", "plan").mapInArrow(
            growing_states(spec.n_periods if spec.trailing else 1), "party string, at bigint, lifetime double, window double, plan int"
        )
        role = F.floor((F.col("at") + SIDE // 2) / SIDE)
        return found.select(
            F.col("party").alias(KEY), F.when(role == 1, F.lit(REC)).otherwise(F.lit(SENT)).alias("role"),
            (F.col("at") - role * SIDE).cast("int").alias("period"), "lifetime", "window", "plan",
        )

    if hot is None:
        return _by_role(plain(values), "period", STATES)
    large = materialized(hot.rows(values, keys))

    def onward(df: DataFrame) -> DataFrame:
        later = lifecycle.by_period(df, snapshots, lambda p: F.filter("_snapshots", lambda s: s >= p))
        at = F.col("period") - F.get(snapshots, F.lit(0))
        return df.withColumn("snapshot", F.explode(F.get(later, at))).drop("period")

    own = lambda df: into_windows(df, snapshots, spec) if spec.trailing else df.withColumnRenamed("period", "snapshot")
    grown = Q.narrowed_quantiles(large, keys, "cents", {"lifetime": 0.5}, "period", onward, few=hot.few)
    single = Q.narrowed_quantiles(large, keys, "cents", {"window": 0.5}, "period", own, few=hot.few)
    plans = large.groupBy(*keys, "period").agg(A.last_value("company_plan", *party.ORDER).cast("int").alias("plan"))
    found = single.join(grown, [*keys, "snapshot"], "left").withColumnRenamed("snapshot", "period")
    found = plans.join(found, [*keys, "period"], "full" if spec.trailing else "left")
    return _by_role(plain(hot.rest(values, keys)).unionByName(found), "period", STATES)


# -- states -----------------------------------------------------------------------

def new_partners(tx: DataFrame, *at: str) -> DataFrame:
    """Partners met for the first time, per party and `at`, which is its period or nothing.

    Distinct counts over a growing history are running sums of first
    meetings, so history is never rescanned.
    """
    first = lambda flag: F.min(F.when(flag, F.col("period")))
    pairs = party.partner_pairs(
        tx, first(S.is_sent()).alias("p_sent"), first(S.is_received()).alias("p_rec")
    )
    met = pairs.filter(F.col("partner").isNotNull()).select(
        KEY, "role", F.explode(F.array("p_sent", "p_rec")).alias("period")
    ).filter(F.col("period").isNotNull())
    is_ = lambda role: F.col("role") == role
    return met.groupBy(KEY, *at).agg(
        A.tally(is_(SENT)).alias("new_receivers"), A.tally(is_(REC)).alias("new_senders")
    )


# Columns of a row's own period that lifetime accumulations need beside trailing windows.
OWN = {f"own_{c}": c for c in ("plan_0", "plan_1", "plan_2", "trans_sum_sent")}


def framed_features(dense: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Additive features and monthly counts of trailing windows. Every active period
    of a party is a row of `dense`, so a window is a frame of its rows."""
    here = lambda c: F.when(F.col("snapshot") == F.col("period"), F.col(c))
    frame = W.partitionBy(KEY).orderBy("snapshot").rangeBetween(1 - spec.n_periods, 0)
    cols = {c: party.MERGE.get(c, F.sum)(here(c)).over(frame) for c in ADDITIVE}
    for role, n in ((SENT, "trans_sum_sent"), (REC, "trans_sum_received")):
        median, largest = party.MONTHLY_NAMES[role]
        counted = F.when(F.col(n) > 0, here(n))
        cols[median] = F.coalesce(F.percentile(counted, F.lit(0.5)).over(frame), F.lit(0.0))
        cols[largest] = F.coalesce(F.max(counted).over(frame), F.lit(0))
    return dense.select(
        *[c for c in dense.columns if c not in ADDITIVE], *[c.alias(name) for name, c in cols.items()],
        *[here(c).alias(own) for own, c in OWN.items()],
    )


def own_features(spec: SnapshotSpec, medians: bool) -> list[str]:
    """Features of an active period itself, beside the states that hold on."""
    return list(ADDITIVE) if spec.trailing else [*ADDITIVE, *(WINDOW.values() if medians else ()), "channel_sent", "channel_rec"]


def party_blocks(
    tx: DataFrame, rolled: DataFrame, snapshots: Column, spec: SnapshotSpec, values: DataFrame | None, hot: Q.Hot | None,
) -> DataFrame:
    """A row per party and period with the rollup, the partners first met and, with values, medians and last plans.

    What looks at the transactions again is stored as its few results, so that its shuffles
    end with it. The blocks are dealt out by party once, which the windows over them need anyway.
    """
    blocks = [rolled, materialized(new_partners(tx, "period"))]
    if values is not None:
        # These bring the last plans with them.
        found = period_medians(values, snapshots, hot, spec) if spec.trailing else period_medians(values, snapshots, hot)
        blocks = [rolled.drop(*STATES["plan"].values()), blocks[1], materialized(found)]
    # A block has one row for each party and period. It is carried as one value: the code for so many
    # columns apart would be too long a method for the JVM to compile.
    names = [f"_block_{k}" for k in range(len(blocks))]
    own = [[c for c in b.columns if c not in (KEY, "period")] for b in blocks]
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [b.select(KEY, "period", F.struct(*cs).alias(name)) for b, cs, name in zip(blocks, own, names)],
    )
    met = rows.repartition(KEY).groupBy(KEY, "period").agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
    return met.select(KEY, "period", *[f"{name}.{c}" for name, cs in zip(names, own) for c in cs])


def window_states(
    tx: DataFrame, rolled: DataFrame, snapshots: Column, spec: SnapshotSpec, values: DataFrame | None, hot: Q.Hot | None,
) -> DataFrame:
    """party_states() of trailing windows: a row per party and period from which on its features are others.

    Those are its active periods and the n_periods after each, up to the next; the
    last of these stands for the time without any transaction in the window.
    """
    medians = values is not None
    w = W.partitionBy(KEY).orderBy("period")
    blocks = party_blocks(tx, rolled, snapshots, spec, values, hot)
    latest_active = F.last(F.when(F.col("trans_sum_sent").isNotNull(), F.col("period")), ignorenulls=True)
    until = F.least(F.lead("period").over(w) - 1, latest_active.over(w.rowsBetween(W.unboundedPreceding, 0)) + spec.n_periods)
    points = F.when(F.col("period").isNotNull(), F.sequence("period", F.greatest("period", "_until")))
    rows = blocks.withColumn("_until", until).withColumn(
        "snapshot", F.explode(F.coalesce(points, F.array(F.lit(None).cast("int"))))
    )
    w = W.partitionBy(KEY).orderBy("snapshot")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    # A row that only stands for the time after another one has nothing of its own.
    here = lambda c: F.when(F.col("snapshot").eqNullSafe(F.col("period")), F.col(c))
    latest = lambda c: F.last(c, ignorenulls=True).over(upto).alias(c)
    listed = F.max("_sender" if spec.senders_only else "_listed").over(upto)
    met = lambda c: F.when(listed, F.coalesce(F.sum(here(c)).over(upto), F.lit(0)))
    frame = w.rangeBetween(1 - spec.n_periods, 0)
    cols = {c: party.MERGE.get(c, F.sum)(here(c)).over(frame) for c in (*ADDITIVE, *COUNTED)}
    # A party has one row for each period, so its window lies in as many rows at most as it has periods.
    reached = lambda c, k: c if k == 0 else F.when(F.lag("snapshot", k).over(w) > F.col("snapshot") - spec.n_periods, F.lag(c, k).over(w))
    counts = {
        role: F.sort_array(F.array(*[reached(F.when(F.col(n) > 0, here(n)), k) for k in range(spec.n_periods)]))
        for role, n in ((SENT, "trans_sum_sent"), (REC, "trans_sum_received"))
    }
    states = rows.select(
        KEY, *[latest(c) for c in ("last_trans_plan", "last_trans_plan_rec", "last_sent", "last_rec")],
        *[latest(c) for c in (LIFETIME.values() if medians else ())],
        met("new_receivers").alias("num_receivers"), met("new_senders").alias("num_senders"), "snapshot",
        *[c.alias(name) for name, c in cols.items()], *[c.alias(f"_n_{role}") for role, c in counts.items()],
        *[here(c).alias(own) for own, c in OWN.items()], *[here(c).alias(c) for c in (WINDOW.values() if medians else ())],
    )
    monthly = {}
    for role in ROLES:
        # Missing counts come first.
        ordered, own = F.col(f"_n_{role}"), F.size(F.array_compact(f"_n_{role}"))
        at = lambda half, ordered=ordered, own=own: F.get(ordered, spec.n_periods - own + half)
        median, largest = party.MONTHLY_NAMES[role]
        middle = (at(F.floor((own - 1) / 2).cast("int")) + at(F.floor(own / 2).cast("int"))) / F.lit(2.0)
        monthly[median] = F.when(own > 0, middle).otherwise(F.lit(0.0))
        monthly[largest] = F.coalesce(F.get(ordered, F.lit(spec.n_periods - 1)), F.lit(0))
    last = [*OWN, *(WINDOW.values() if medians else ())]
    none = F.lit(0).cast("bigint")
    states = states.select(
        *[c for c in states.columns if c not in (*COUNTED, *last, *(f"_n_{r}" for r in ROLES))],
        *[c.alias(name) for name, c in monthly.items()], *last,
        # Counts of no row at all are none, which no channel is the most frequent of.
        *[F.coalesce(c, none).alias(c) for c in COUNTED],
    )
    states = with_modal_channels(
        party.party_rows(tx, "period", "channel"), states, "snapshot", lambda counts: channels_into_windows(counts, snapshots, spec)
    )
    last = [*OWN, "channel_sent", "channel_rec", *(WINDOW.values() if medians else ())]
    return states.select(*[c for c in states.columns if c not in last], *last).withColumnRenamed("snapshot", "period")


def party_states(
    tx: DataFrame, rolled: DataFrame, snapshots: Column, spec: SnapshotSpec, values: DataFrame | None, hot: Q.Hot | None,
) -> DataFrame:
    """Per party and active period: the states from then on, and features of the period
    itself. Without values, amounts aren't looked at."""
    medians = values is not None
    active = party_blocks(tx, rolled, snapshots, spec, values, hot)
    lifetime = list(LIFETIME.values()) if medians else []
    w = W.partitionBy(KEY).orderBy("period").rowsBetween(W.unboundedPreceding, 0)
    latest = lambda c: F.last(c, ignorenulls=True).over(w).alias(c)
    listed = F.max("_sender" if spec.senders_only else "_listed").over(w)
    met = lambda c: F.when(listed, F.coalesce(F.sum(c).over(w), F.lit(0)))
    return active.select(
        KEY,
        "period",
        *[latest(c) for c in ("last_trans_plan", "last_trans_plan_rec", "last_sent", "last_rec")],
        *[latest(c) for c in lifetime],
        met("new_receivers").alias("num_receivers"),
        met("new_senders").alias("num_senders"),
        *own_features(spec, medians),
    )


def valued(tx: DataFrame, rolled: DataFrame, spec: SnapshotSpec, medians: bool) -> tuple[DataFrame | None, Q.Hot | None]:
    """The amounts and the groups of them that are too large for one task, if medians are asked for."""
    return (amounts(tx), hot_parties(rolled, spec.hot_rows)) if medians else (None, None)


def party_features(
    tx: DataFrame, rolled: DataFrame, snapshots: Column, spec: SnapshotSpec, medians: bool = True,
) -> DataFrame:
    """All features per (party, snapshot), from the party's first transaction on.

    States (partner counts, last plans and times, lifetime medians) hold until
    the party's next active period. Features of a period window belong to the
    snapshot of that period only; of a trailing window, they come from the rows
    of its periods. Without medians, amounts aren't looked at.
    """
    values, hot = valued(tx, rolled, spec, medians)
    states = party_states(tx, rolled, snapshots, spec, values, hot)
    dense = lifecycle.carry_forward(states, [KEY], "period", snapshots)
    if spec.trailing:
        blocks = [window_channels(tx, snapshots, spec)]
        if medians:
            blocks.append(window_medians(values, snapshots, spec, hot))
        if spec.yyyymm_arithmetic:
            here = [F.when(F.col("snapshot") == F.col("period"), F.col(c)).alias(name) for name, c in OWN.items()]
            features = dense.select("*", *here).drop("period", *ADDITIVE)
            blocks += [window_features(rolled, snapshots, spec), window_monthly_stats(rolled, snapshots, spec)]
        else:
            features = framed_features(dense, spec).drop("period")
        for block in blocks:
            features = features.join(block, [KEY, "snapshot"], "left")
        return features
    return only_counted(dense, snapshots, spec, medians).drop("period")


def only_counted(rows: DataFrame, snapshots: Column, spec: SnapshotSpec, medians: bool) -> DataFrame:
    """Features of a period's window, only in the row of that period's snapshot."""
    own = own_features(spec, medians)
    counted = F.col("snapshot") == F.col("period")
    if spec.first_after is not None:
        first = S.year_month_index(F.lit(spec.first_after))
        if spec.grain == "quarter":
            first = F.floor(first / 3)
        counted = counted & ((F.col("snapshot") != F.element_at("_all", 1)) | (F.col("period") > first))
        rows = rows.withColumn("_all", snapshots)
    return rows.withColumns({c: F.when(counted, F.col(c)) for c in own}).drop("_all")


# -- the panel ----------------------------------------------------------------------

def spine(
    events: DataFrame, ids: DataFrame, snapshots: Column, spec: SnapshotSpec,
    order: tuple[str, ...] = lifecycle.EVENT_ORDER,
) -> DataFrame:
    """(company, party id, snapshot) with the plan as of the snapshot. A
    company with several party ids has one row for each."""
    plans = lifecycle.plan_asof(events, snapshots, spec.grain, order)
    return with_party_ids(plans, ids)


def with_party_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select(F.col("company_id").alias("company"), KEY), "company", "left")


def days_since_milestones(rows: DataFrame, companies: DataFrame, churn: DataFrame, at: Column) -> DataFrame:
    """Days from sign-up, premium and premium end to the snapshot; negative
    before the event, missing if it never happens."""
    return with_days(with_milestones(rows, companies, churn), at)


def with_milestones(rows: DataFrame, companies: DataFrame, churn: DataFrame) -> DataFrame:
    starts = companies.select("company", "data_alta_basic", "data_alta_premium")
    return rows.join(starts, "company", "left").join(churn.select("company", "data_baixa_prem"), "company", "left")


def with_days(rows: DataFrame, at: Column) -> DataFrame:
    return (
        rows.withColumn("days_since_alta_basic", S.elapsed_days(at, "data_alta_basic"))
        .withColumn("days_since_alta_premium", S.elapsed_days(at, "data_alta_premium"))
        .withColumn("days_since_baixa_prem", S.elapsed_days(at, "data_baixa_prem"))
        .drop("data_alta_basic", "data_alta_premium", "data_baixa_prem")
    )


def owned_rows(
    owners: DataFrame, states: DataFrame, snapshots: Column, spec: SnapshotSpec, medians: bool, gathered: bool = False,
) -> DataFrame:
    """A row per company, party id and snapshot from the company's _begin on, with the
    states its party has by then.

    Companies meet their parties' few states, which lie by party already, and rows are
    made of the pairs. So neither these rows nor their snapshots are shuffled or sorted.
    Gathered, the pairs are dealt out by company before, and rows lie as their running columns need them.
    """
    w = W.partitionBy(KEY).orderBy("period")
    held = [c for c in states.columns if c not in (KEY, "period")]
    at = lifecycle.place(states, snapshots)
    # A state holds up to the party's next one; the first row also stands for the time before.
    placed = states.withColumns({"_next": F.lead("period").over(w), "_first": F.lag("period").over(w).isNull()})
    placed = placed.filter("period IS NOT NULL").withColumns({
        "_from": at("period"), "_upto": F.when(F.col("_next").isNotNull(), at("_next")),
    }).withColumnRenamed(KEY, "_party").drop("_next")
    # Companies without a party id meet nothing, and need not meet in one task.
    named = owners.withColumn("_named", F.coalesce(KEY, F.concat(F.lit("\0"), F.col("company").cast("string"))))
    pairs = named.join(placed, (F.col("_named") == F.col("_party")) & F.col(KEY).isNotNull(), "left")
    start = F.when(F.coalesce("_first", F.lit(True)), F.col("_begin")).otherwise(F.greatest("_from", "_begin"))
    stop = F.coalesce("_upto", F.size(snapshots))
    spans = pairs.withColumns({"_start": start, "_stop": stop}).filter("_start < _stop").withColumn(
        "_plans", F.slice("_plans", F.col("_start") - F.col("_begin") + 1, F.col("_stop") - F.col("_start"))
    )
    kept = [*[c for c in owners.columns if c not in ("_begin", "_plans")], "period"]
    spans = spans.select(*kept, "_start", "_from", "_plans", *held)
    if gathered:
        spans = spans.repartition("company")
    rows = spans.select(*kept, "_start", "_from", *held, F.posexplode("_plans").alias("_k", "actual_plan")).withColumn("_at", F.col("_start") + F.col("_k"))
    here = F.col("_at") >= F.col("_from")
    rows = rows.select(
        *kept, F.get(snapshots, F.col("_at")).alias("snapshot"), "actual_plan", *[F.when(here, F.col(c)).alias(c) for c in held],
    )
    # Rows of trailing windows change with the window, and need no look at their period.
    return rows.drop("period") if spec.trailing else only_counted(rows, snapshots, spec, medians).drop("period")


def feature_panel(
    tx: DataFrame, events: DataFrame, ids: DataFrame, companies: DataFrame, churn: DataFrame,
    spec: SnapshotSpec = SnapshotSpec(), order: tuple[str, ...] = lifecycle.EVENT_ORDER,
    own: bool = False, medians: bool = True, gathered: bool = False,
) -> DataFrame:
    """All features of every company at every snapshot from its first event on.
    With own, those of OWN stay in a trailing panel; without medians, those of amounts are left out.
    Gathered, the rows lie by company, for running columns."""
    tx = with_period(tx, spec)
    literal = spec.trailing and spec.yyyymm_arithmetic
    rolled = materialized(rollup(tx, channels=not literal, plans=not medians, counted=spec.trailing))
    snapshots = snapshot_list(rolled)
    date = S.period_end("snapshot", spec.grain)

    # Companies are few and narrow: their dates are added before the rows
    # multiply by party ids and meet the wide features.
    if literal:
        rows = lifecycle.plan_asof(events, snapshots, spec.grain, order)
        rows = with_party_ids(days_since_milestones(rows, companies, churn, date), ids)
        joined = rows.join(party_features(tx, rolled, snapshots, spec, medians), [KEY, "snapshot"], "left")
    else:
        plans = with_milestones(lifecycle.plans_asof(events, snapshots, spec.grain, order), companies, churn)
        states_of = window_states if spec.trailing else party_states
        states = states_of(tx, rolled, snapshots, spec, *valued(tx, rolled, spec, medians))
        joined = with_days(owned_rows(with_party_ids(plans, ids), states, snapshots, spec, medians, gathered), date)
        if spec.trailing:
            first = [KEY, "snapshot", "company", "actual_plan", "days_since_alta_basic", "days_since_alta_premium", "days_since_baixa_prem"]
            joined = joined.select(*first, *[c for c in states.columns if c not in (KEY, "period")])
    joined = joined.drop(*([] if own else OWN)).select(
        "*", S.period_label("snapshot", spec.grain).alias("timestamp_ym"),
        *party.recency_columns(date),
    ).drop("last_sent", "last_rec")
    return fill_panel(joined)


def latest_rows(
    tx: DataFrame, events: DataFrame, ids: DataFrame, companies: DataFrame, churn: DataFrame, spec: SnapshotSpec,
) -> DataFrame:
    """What the segmentation reads of each company's newest row, for windows of a period.

    Running columns are totals there, and states those of the whole history. So no
    row is made for a snapshot without transactions: such snapshots are counted,
    and enter sums and maxima not at all, and the median as so many zeros.
    """
    tx = with_period(tx, spec)
    rolled = materialized(rollup(tx, counts_only=True))
    snapshots = snapshot_list(rolled)
    firsts = A.with_keys(events, "company").groupBy("company").agg(
        F.min(S.period_index(lifecycle.TS, spec.grain)).alias("_first")
    )
    later = F.filter("_snapshots", lambda s: s >= F.col("_first"))
    shown = firsts.withColumn("_snapshots", snapshots).select("company", "_first", F.size(later).alias("_rows")).filter("_rows > 0")
    owners = materialized(with_party_ids(shown, ids))
    newest = owners.groupBy("company").agg(F.max(KEY).alias(KEY)).withColumn(
        "snapshot", F.get(snapshots, F.size(snapshots) - 1)
    )
    date = S.period_end("snapshot", spec.grain)
    rows = days_since_milestones(newest, companies, churn, date)
    rows = rows.join(_latest_states(tx, rolled, spec), KEY, "left").join(_totals(owners, rolled), "company", "left")
    zero = {"num_receivers": "bigint", "num_senders": "bigint", LIFETIME[SENT]: "double"}
    return rows.select(
        "company", KEY, S.period_label("snapshot", spec.grain).alias("timestamp_ym"), party.recency_columns(date)[0],
        "days_since_alta_basic", "days_since_alta_premium", "days_since_baixa_prem",
        *[F.coalesce(c, F.lit(0).cast(kind)).alias(c) for c, kind in zero.items()], *TOTALS,
    )


def _latest_states(tx: DataFrame, rolled: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Partner counts, last times and the median amount sent, of each party's whole history."""
    listed = "_sender" if spec.senders_only else "_listed"
    last = rolled.groupBy(KEY).agg(
        F.count("period").alias("_active"), F.max(listed).alias("_met"),
        F.max("last_sent").alias("last_sent"), F.max("last_rec").alias("last_rec"),
    ).filter("_active > 0")
    keys = [KEY, "role"]
    sent = A.with_keys(tx.select(F.col("sender_xin_value").alias(KEY), F.lit(SENT).alias("role"), party.cents().alias("cents")), KEY)
    medians = Q.quantiles(sent, keys, "cents", {"m": 0.5}, spec.hot_rows, hot_parties(rolled, spec.hot_rows))
    met = lambda c, out: F.when(F.col("_met"), F.coalesce(c, F.lit(0))).alias(out)
    return (
        last.join(new_partners(tx), KEY, "left")
        .join(medians.select(KEY, (F.col("m") / 100).alias(LIFETIME[SENT])), KEY, "left")
        .select(
            KEY, "last_sent", "last_rec", LIFETIME[SENT],
            met("new_receivers", "num_receivers"), met("new_senders", "num_senders"),
        )
    )


TOTALS = ["med_trans_sent", "sum_trans_sent", *[f"{name}_acum" for name in specs.CHANNEL_FLAGS]]


def _totals(owners: DataFrame, rolled: DataFrame) -> DataFrame:
    """The running columns of each company's newest row, from the periods with transactions."""
    n, flags = F.col("trans_sum_sent"), list(specs.CHANNEL_FLAGS)
    counts = rolled.select(KEY, "period", n, "channel_sent", "channel_rec")
    active = running.channel_onehot(owners.join(counts, KEY).filter(F.col("period") >= F.col("_first")))
    # A period with transactions has its count once, and takes one zero away.
    line = lambda value, times, *own: F.struct(
        value.cast("bigint").alias("n"), times.cast("bigint").alias("times"), *[c.cast("bigint").alias(f) for f, c in zip(flags, own)]
    )
    none = [F.lit(0) for _ in flags]
    both = F.array(line(n, F.lit(1), *[F.col(f) for f in flags]), line(F.lit(0), F.lit(-1), *none))
    lines = active.select("company", F.inline(both)).unionByName(
        owners.select("company", F.inline(F.array(line(F.lit(0), F.col("_rows"), *none))))
    )
    counted = lines.groupBy("company", "n").agg(F.sum("times").alias("times"), *[F.sum(f).alias(f) for f in flags])
    return counted.groupBy("company").agg(
        F.percentile(F.col("n").cast("double"), F.lit(0.5), F.col("times")).alias("med_trans_sent"),
        F.sum(F.col("n") * F.col("times")).alias("sum_trans_sent"), *[F.sum(f).alias(f"{f}_acum") for f in flags],
    )


def fill_panel(panel: DataFrame) -> DataFrame:
    """Missing counts, amounts and channels become 0, missing last plans -1;
    recency and days since a milestone stay missing."""
    keep = {
        "company", KEY, "snapshot", "timestamp_ym", "actual_plan", "days_from_last_transaction",
        "days_from_last_transaction_rec", "days_since_alta_basic", "days_since_alta_premium",
        "days_since_baixa_prem",
    }
    fills = {c: -1 if c.startswith("last_trans_plan") else 0 for c in panel.columns if c not in keep}
    return panel.select(
        *[
            F.coalesce(F.col(c), F.lit(fills[c]).cast(panel.schema[c].dataType)).alias(c)
            if c in fills else F.col(c)
            for c in panel.columns
        ]
    )
