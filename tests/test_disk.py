"""What steps leave on disk: shuffle files go with what was stored from them, panels shuffle states and not rows."""

from __future__ import annotations

import math
import os
import random
from statistics import median

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import modelling
from cohortry.catalog import panels as P
from cohortry.functions import scale
from cohortry.operators import panel, running
from tests.test_edges import dt, tx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for top in manager.localDirsString() for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffled(spark)
    rows = spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    stored = scale.materialized(rows)
    left = shuffled(spark) - before
    assert stored.count() == 7 and not left
    assert spark.conf.get(scale.SWEPT, None) in (None, "false", "true") and not scale._sweeping


def test_tables_stored_inside_are_noted(spark):
    with scale.noted() as made:
        one = scale.materialized(spark.range(2))
    scale.materialized(spark.range(2))
    assert made == [one]


def test_training_sets_leave_their_rows_and_not_the_panels(spark, sf_dir, monkeypatch):
    gone = []
    monkeypatch.setattr(modelling, "discard", lambda *tables, _own=scale.discard: gone.extend(t._stored_at for t in tables) or _own(*tables))
    sets = modelling.training_sets(spark, sf_dir)
    assert len(gone) >= 5 and all(df.count() > 0 for df in sets.values())
    assert not any(os.path.exists(path.removeprefix("file:")) for path in gone)


def test_discarded_tables_are_gone_and_others_stay(spark):
    one, two = scale.materialized(spark.range(3)), scale.materialized(spark.range(4))
    path = one.inputFiles()[0]
    scale.discard(one, spark.range(2))
    assert not os.path.exists(path.removeprefix("file:").replace("///", "/")) and two.count() == 4


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_window_medians_as_by_brute_force(size):
    draw, n = random.Random(size), 3
    rows = sorted(
        ((draw.choice("ABC"), draw.choice((0, panel.SIDE)) + draw.choice((-2, 0, 1, 2, 5, 9, 10)), draw.choice((None, *range(40))), draw.choice((None, 0, 1)))
         for _ in range(60)),
        key=lambda r: (r[0], r[1], r[3] is not None),
    )
    names, types = ("party", "at", "cents", "plan"), (pa.string(), pa.int64(), pa.int64(), pa.int32())
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + size]), types)], names=names)
        for i in range(0, len(rows), size)
    ]
    got = {(r["party"], r["at"]): r["window"] for b in panel.growing_states(n)(iter(batches)) for r in b.to_pylist()}
    side = lambda at: (at + panel.SIDE // 2) // panel.SIDE
    want = {}
    for who, at in {(r[0], r[1] + k) for r in rows for k in range(n)}:
        inside = [r[2] for r in rows if r[0] == who and side(r[1]) == side(at) and at - n < r[1] <= at and r[2] is not None]
        want[who, at] = median(inside) if inside else None
    assert got == want


@pytest.mark.parametrize("size", [1, 3, 100])
def test_growing_medians_as_by_brute_force(size):
    draw = random.Random(size)
    lines = [(k // 20, draw.choice((None, 0.0, 1.5, 2.0, 7.0))) for k in range(60)] + [(None, 1.0), (None, 2.0), (9, math.nan), (9, 1.0), (9, 0.0)]
    batches = [pa.record_batch({"company": [x[0] for x in lines[i:i + size]], "m": pa.array([x[1] for x in lines[i:i + size]], pa.float64())}) for i in range(0, len(lines), size)]
    got = [v for b in running.growing_medians(["m"])(iter(batches)) for v in b.column("m").to_pylist()]
    for k, (company, _) in enumerate(lines[:-3]):
        own = [v for c, v in lines[:k + 1] if c == company and v is not None]
        assert got[k] == (median(own) if own else None)
    assert math.isnan(got[-3]) and math.isnan(got[-2]) and got[-1] == 1.0


def test_trailing_panel_shuffles_states_and_not_rows(spark, sf_dir):
    text = plan(P.raw_panel(spark, sf_dir, P.TRAILING))
    shuffles = [line for line in text.splitlines() if "hashpartitioning" in line]
    assert shuffles and not any("snapshot" in line for line in shuffles) and "percentile(" not in text


@pytest.mark.parametrize("spec", [specs.RFM_SNAPSHOTS, P.TRAILING], ids=["month", "trailing"])
def test_running_columns_take_gathered_rows_as_they_lie(spark, sf_dir, spec):
    """The last shuffle is by company, before rows are made; none follows, and no panel is stored to count its rows."""
    text = plan(P.accumulated_panel(spark, sf_dir, spec))
    top = text[:text.index("hashpartitioning")]
    assert "posexplode" in top and "Window" in top and "hashpartitioning(company" in text[len(top):].splitlines()[0]


def test_trailing_windows_of_gaps_and_of_channels_without_group(spark):
    """Windows end between transactions, months without any stay away, and every channel counts."""
    day = lambda y, m: dt(y, m, 5)
    lines = [(2020, 1, "fax", 10.0), (2020, 1, "fax", 30.0), (2020, 2, "Mail", 50.0), (2020, 7, "Mail", 70.0), (2021, 1, None, 1.0)]
    data = tx(spark, *[{"timestamp": day(y, m), "channel": c, "amount": v, "kind": "issue"} for y, m, c, v in lines])
    data = data.unionByName(tx(spark, *[{"timestamp": day(2020, m), "sender": "Q", "receiver": "R"} for m in (3, 4, 5)]))
    events = spark.createDataFrame(
        [(1, day(2019, 1), "alta", 0, 1)], "company bigint, `@timestamp` timestamp, action string, plan int, event_id bigint",
    ).withColumn("date_last_updated", F.col("@timestamp"))
    ids = spark.createDataFrame([(1, "A")], "company_id bigint, xin_value string")
    companies = spark.createDataFrame([(1, day(2020, 1), None)], "company bigint, data_alta_basic timestamp, data_alta_premium timestamp")
    churn = spark.createDataFrame([], "company bigint, data_baixa_prem timestamp")
    out = panel.feature_panel(data, events, ids, companies, churn, P.TRAILING, own=True)
    got = sorted(
        (r.timestamp_ym, r.trans_sum_sent, r.trans_med_sent, r.trans_max_sent, r.import_med_sent, r.own_trans_sum_sent, r.channel_sent)
        for r in out.collect()
    )
    assert got == [
        ("202001", 2, 2.0, 2, 20.0, 2, "fax"), ("202002", 3, 1.5, 2, 30.0, 1, "fax"), ("202003", 3, 1.5, 2, 30.0, 0, "fax"),
        ("202004", 1, 1.0, 1, 50.0, 0, "Mail"), ("202005", 0, 0.0, 0, 0.0, 0, "0"), ("202007", 1, 1.0, 1, 70.0, 1, "Mail"),
        ("202101", 1, 1.0, 1, 1.0, 1, "0"),
    ]


def test_fewer_snapshots_let_a_company_own_more_ids(spark):
    ids = spark.createDataFrame([(1, f"x{k}") for k in range(50)], "company_id bigint, xin_value string")
    assert running.may_be_hot(ids, 20_000) and not running.may_be_hot(ids, 20_000, 84)
