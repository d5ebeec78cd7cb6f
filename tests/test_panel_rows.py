"""How the period panel comes by its rows: what is shuffled, medians, last plans, channels."""

from __future__ import annotations

import random
from statistics import median

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import panels as P
from cohortry.operators import panel
from tests.test_edges import dt, tx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_rows_are_made_after_the_last_shuffle(spark, sf_dir):
    text = plan(P.raw_panel(spark, sf_dir, specs.RFM_SNAPSHOTS))
    shuffles = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert shuffles and not any("snapshot" in line for line in shuffles)
    assert "percentile(" not in text and "mode(" not in text


def test_rollup_aggregates_without_sorting(spark, sf_dir):
    data = panel.with_period(P.C.transactions(spark, sf_dir), specs.RFM_SNAPSHOTS)
    text = plan(panel.rollup(data, plans=False))
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_states_grow_as_by_brute_force(size):
    draw = random.Random(size)
    rows = sorted(
        ((draw.choice("ABC"), draw.choice((0, panel.SIDE)) + draw.randint(-2, 9), draw.choice((None, *range(40))), draw.choice((None, 0, 1, 2)))
         for _ in range(700)),
        key=lambda r: (r[0], r[1], r[3] is not None),
    )
    names, types = ("party", "at", "cents", "plan"), (pa.string(), pa.int64(), pa.int64(), pa.int32())
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), types)], names=names)
        for i in range(0, len(rows), size)
    ]
    got = [tuple(r.values()) for b in panel.growing_states()(iter(batches)) for r in b.to_pylist()]
    side = lambda at: (at + panel.SIDE // 2) // panel.SIDE
    want = []
    for who, at in sorted({r[:2] for r in rows}):
        own = [r for r in rows if r[:2] == (who, at)]
        cents = [r[2] for r in own if r[2] is not None]
        upto = [r[2] for r in rows if r[0] == who and side(r[1]) == side(at) and r[1] <= at and r[2] is not None]
        want.append((who, at, median(upto) if cents else None, median(cents) if cents else None, own[-1][3]))
    assert got == want
    assert list(panel.growing_states()(iter([]))) == []


def test_channels_of_no_group_are_counted_with_the_listed(spark):
    def modal(*channels):
        lines = [{"timestamp": dt(2020, 1, 5), "channel": c} for c in channels]
        data = panel.with_period(tx(spark, *lines), specs.RFM_SNAPSHOTS)
        return panel.rollup(data).filter("xin_value = 'A'").first().channel_sent

    assert modal("Peppol", "Mail", "Mail") == "Mail"
    assert modal("Peppol", "Mail") == "Mail"
    assert modal("fax", "Peppol", "fax") == "fax"
    assert modal("fax", "Peppol", "Peppol") == "Peppol"
    assert modal("fax", "Peppol") == "Peppol" and modal("Aerial", "B2G") == "Aerial"
    assert modal("fax") == "fax" and modal(None) is None


def test_company_without_party_and_parties_of_two_companies(spark):
    """Snapshots before a party's first transaction and those of companies without one are empty."""
    day = lambda m: dt(2020, m, 5)
    data = tx(spark, *[{"timestamp": day(m), "kind": "issue"} for m in (1, 3, 4)])
    events = spark.createDataFrame(
        [(1, day(1), "alta", 0, 1), (2, day(2), "alta", 1, 2), (2, day(4), "upgrade", 2, 3), (3, day(3), "alta", 0, 4), (4, day(9), "alta", 0, 5)],
        "company bigint, `@timestamp` timestamp, action string, plan int, event_id bigint",
    ).withColumn("date_last_updated", F.col("@timestamp"))
    ids = spark.createDataFrame([(1, "A"), (2, "A"), (2, "Z"), (4, "A")], "company_id bigint, xin_value string")
    companies = spark.createDataFrame([(1, day(1), None)], "company bigint, data_alta_basic timestamp, data_alta_premium timestamp")
    churn = spark.createDataFrame([], "company bigint, data_baixa_prem timestamp")
    out = panel.feature_panel(data, events, ids, companies, churn, specs.RFM_SNAPSHOTS)
    got = sorted(
        (r.company, r.xin_value or "", r.timestamp_ym, r.actual_plan, r.trans_sum_sent, r.num_receivers) for r in out.collect()
    )
    assert got == [
        (1, "A", "202001", 0, 1, 1), (1, "A", "202003", 0, 1, 1), (1, "A", "202004", 0, 1, 1),
        (2, "A", "202003", 1, 1, 1), (2, "A", "202004", 2, 1, 1), (2, "Z", "202003", 1, 0, 0), (2, "Z", "202004", 2, 0, 0),
        (3, "", "202003", 0, 0, 0), (3, "", "202004", 0, 0, 0),
    ]
