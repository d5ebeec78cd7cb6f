"""Running accumulations over a company's snapshots."""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions.quantiles import checked, hot_groups
from cohortry.functions.scale import materialized
from cohortry.operators import sliced

PANEL_ORDER = ("timestamp_ym", "xin_value")


def running(order: tuple[str, ...] = PANEL_ORDER):
    """First snapshot of the company up to the current row."""
    return W.partitionBy("company").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def running_median(value: str, out: str, order=PANEL_ORDER) -> Column:
    return F.percentile(F.col(value).cast("double"), F.lit(0.5)).over(running(order)).alias(out)


def running_sum(value: str, out: str, order=PANEL_ORDER) -> Column:
    return F.sum(value).over(running(order)).alias(out)


def running_max(value: str, out: str, order=PANEL_ORDER) -> Column:
    return F.max(value).over(running(order)).alias(out)


MEDIANS = {
    "med_trans_sent": "trans_sum_sent", "med_trans_received": "trans_sum_received",
    "med_import_sent": "import_sum_sent", "med_import_rec": "import_sum_rec",
}
TRAILING_MEDIANS = {
    "med_trans_sent_m": "trans_med_sent", "med_trans_received_m": "trans_med_received",
}
SUMS = {
    "sum_trans_sent": "trans_sum_sent", "sum_trans_received": "trans_sum_received",
    "acum_0": "plan_0", "acum_1": "plan_1", "acum_2": "plan_2",
    "acum_success_true": "success_true", "acum_success_false": "success_false",
    "sum_import_sent": "import_sum_sent", "sum_import_rec": "import_sum_rec",
}
MAXES = {
    "max_trans_sent": "trans_sum_sent", "max_trans_received": "trans_sum_received",
    "max_import_sent": "import_max_sent", "max_import_received": "import_max_rec",
}
# What lifetime accumulations are beside a trailing panel: sums of the rows' own periods.
LIFETIME_SUMS = {
    "acum_0": "own_plan_0", "acum_1": "own_plan_1", "acum_2": "own_plan_2", "sum_trans_sent": "own_trans_sum_sent",
}
TRAILING_MAXES = {
    "max_trans_sent": "trans_max_sent", "max_trans_received": "trans_max_received",
    "max_import_sent": "import_max_sent", "max_import_received": "import_max_rec",
}


def channel_onehot(panel: DataFrame) -> DataFrame:
    """One flag per channel group: 1 for the sent plus 1 for the received
    modal channel. Channels outside the groups have no flag."""
    flag = lambda side, group: F.coalesce((F.col(side) == group).cast("int"), F.lit(0))
    return panel.select(
        "*",
        *[
            (flag("channel_sent", group) + flag("channel_rec", group)).alias(name)
            for name, group in specs.CHANNEL_FLAGS.items()
        ],
    ).drop("channel_sent", "channel_rec")


def growing_medians(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Median of each column over a company's rows so far, in place of the column; missing values are skipped.

    Rows come by company and in order. A company's values stay sorted, so a row costs a search
    in them, and not the sorting of all before it. NaN counts as the largest value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        company, kept = object(), {c: ([], 0) for c in columns}
        for batch in batches:
            companies = batch.column("company").to_pylist()
            fresh = [own != before for own, before in zip(companies, [company, *companies])]
            company = companies[-1] if companies else company
            for c in columns:
                grown, nans = kept[c]
                found = []
                for first, v in zip(fresh, batch.column(c).to_pylist()):
                    if first:
                        grown, nans = [], 0
                    if v is not None:
                        if math.isnan(v):
                            nans += 1
                        else:
                            bisect.insort(grown, v)
                    n, sound = len(grown) + nans, len(grown)
                    if not n:
                        found.append(None)
                    elif n // 2 >= sound:
                        found.append(math.nan)
                    else:
                        found.append(grown[n // 2] if n % 2 else 0.5 * grown[n // 2 - 1] + 0.5 * grown[n // 2])
                kept[c] = grown, nans
                batch = batch.set_column(batch.schema.get_field_index(c), c, pa.array(found, pa.float64()))
            yield batch

    return run


def with_medians(rows: DataFrame, order: tuple[str, ...], medians: dict[str, str], last: list[str]) -> DataFrame:
    """rows, which lie by company, with running medians (out -> value) before the columns `last`."""
    if not medians:
        return rows
    first = [c for c in rows.columns if c not in last]
    values = rows.select(*first, *[F.col(c).cast("double").alias(out) for out, c in medians.items()], *last)
    fields = [T.StructField(f.name, f.dataType) for f in values.schema.fields]
    # The rows' windows have sorted them so, and no sort is planned again.
    return values.sortWithinPartitions("company", *order).mapInArrow(growing_medians(list(medians)), T.StructType(fields))


def accumulated(
    rows: DataFrame, order: tuple[str, ...], medians: dict[str, str], sums: dict[str, str], maxes: dict[str, str],
    running_rows: int | None = specs.RUNNING_ROWS,
) -> DataFrame:
    """rows with running columns (out -> value) of each company.

    Sums and maxima share one window specification, and medians come from the rows in its order,
    so rows are shuffled and sorted by company a single time. With running_rows the rows are stored and counted,
    and companies above that number are cut into slices; `order` must not repeat
    within them. Sums of fractions may then differ in the last digits, as they
    are added up in another order.
    """
    added = [*sums, *maxes]

    def plain(df: DataFrame) -> DataFrame:
        if not added:
            return with_medians(df.repartition("company"), order, medians, [])
        summed = df.select(
            "*",
            *[running_sum(c, out, order) for out, c in sums.items()],
            *[running_max(c, out, order) for out, c in maxes.items()],
        )
        return with_medians(summed, order, medians, added)

    if running_rows is None:
        return plain(rows)
    rows = materialized(rows)
    hot = checked(hot_groups(rows.where("company IS NOT NULL"), ["company"], running_rows))
    if hot is None:
        return plain(rows)
    cut = sliced.slices(hot.rows(rows, ["company"]), order, running_rows)
    found = sliced.medians(sliced.scanned(cut, sums, maxes), medians, running_rows).drop("_slice", "_k")
    cold = plain(hot.rest(rows, ["company"]))
    return cold.unionByName(found.select(*[F.col(f.name).cast(f.dataType) for f in cold.schema]))


#: More snapshots than a panel has; a company has one row for each and party id.
MOST_SNAPSHOTS = 600


def may_be_hot(ids: DataFrame, running_rows: int, snapshots: int = MOST_SNAPSHOTS) -> bool:
    """Whether any company has so many party ids that its panel rows could exceed the bound."""
    return not hot_groups(ids, ["company_id"], running_rows // max(snapshots, 1)).isEmpty()


def panel_accumulate(
    panel: DataFrame, spec: specs.SnapshotSpec = specs.SnapshotSpec(), order=PANEL_ORDER, ids: DataFrame | None = None,
    snapshots: int = MOST_SNAPSHOTS,
) -> DataFrame:
    """All running columns of the panel at once. With ids (company_id, xin_value)
    companies that own very many of them are looked for, and cut into slices; the panel
    has at most so many snapshots. Own
    columns of a trailing panel become lifetime sums."""
    medians, sums, maxes = accumulations(spec)
    own = {out: c for out, c in LIFETIME_SUMS.items() if c in panel.columns}
    sums.update(own)
    sized = spec.running_rows if ids is not None and may_be_hot(ids, spec.running_rows, snapshots) else None
    return accumulated(channel_onehot(panel), order, medians, sums, maxes, sized).drop(*own.values())


def accumulations(spec: specs.SnapshotSpec) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Running medians, sums and maxima (out -> value) of a panel."""
    medians = {**MEDIANS, **(TRAILING_MEDIANS if spec.trailing else {})}
    sums = {} if spec.trailing else dict(SUMS)
    sums.update({f"{name}_acum": name for name in specs.CHANNEL_FLAGS})
    return medians, sums, TRAILING_MAXES if spec.trailing else MAXES


def last_accumulated(panel: DataFrame, spec: specs.SnapshotSpec, order=PANEL_ORDER) -> DataFrame:
    """Newest snapshot of each company with its running columns, which are totals
    there: one aggregate, where panel_accumulate() works them out for every row."""
    rows = channel_onehot(panel)
    medians, sums, maxes = accumulations(spec)
    rest = [c for c in rows.columns if c != "company" and c not in PER_PERIOD]
    return rows.groupBy("company").agg(
        F.max_by(F.struct(*rest), A.ordering(*order)).alias("_row"),
        *[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(out) for out, c in medians.items()],
        *[F.sum(c).alias(out) for out, c in sums.items()],
        *[F.max(c).alias(out) for out, c in maxes.items()],
    ).select("company", *[F.col("_row")[c].alias(c) for c in rest], *medians, *sums, *maxes)


PER_PERIOD = [
    "plan_0", "plan_1", "plan_2", "success_true", "success_false", "trans_sum_received",
    "trans_sum_sent", "import_med_rec", "import_max_rec", "import_sum_rec", "import_med_sent",
    "import_max_sent", "import_sum_sent",
]


def last_row_per_company(panel: DataFrame, order=PANEL_ORDER) -> DataFrame:
    """Newest snapshot of each company without the per-period columns."""
    return A.newest(panel.drop(*PER_PERIOD), ["company"], list(order))
