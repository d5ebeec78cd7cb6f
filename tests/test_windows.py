"""Windows and carried states by look-up: the snapshots a comparison with all of them finds, without the comparison."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import QUERIES
from cohortry.catalog import panels as P
from cohortry.operators import lifecycle, panel

PERIODS = [23_990, 23_991, 23_993, 23_999, 24_000, 24_001, 24_012]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("spec", [P.TRAILING, specs.SnapshotSpec(window="trailing", yyyymm_arithmetic=True)], ids=["months", "yyyymm"])
def test_window_is_looked_up(spark, spec):
    rows = spark.createDataFrame([(p,) for p in (*PERIODS, None)], "period int")
    snapshots = panel.snapshot_list(rows)
    out = panel.into_windows(rows.withColumn("p", F.col("period")), snapshots, spec)
    inside = lambda s, p: spark.range(1).select(panel.in_window(spec, F.lit(s), F.lit(p))).first()[0]
    assert sorted(map(tuple, out.select("p", "snapshot").collect())) == [(p, s) for p in PERIODS for s in PERIODS if inside(s, p)]
    # Nothing is compared for each row: the lambda runs in the subquery alone.
    assert "filter(" not in plan(out).split("Subquery")[0].split("scalar-subquery")[0]


def test_states_are_carried_to_the_next_one(spark):
    rows = [("a", 23_980), ("a", 23_992), ("a", 24_000), ("a", 24_100), ("b", 24_012), ("c", None), ("d", 24_013)]
    calendar = spark.createDataFrame([(p,) for p in PERIODS], "period int")
    states = spark.createDataFrame(rows, "k string, period int")
    got = lifecycle.carry_forward(states, ["k"], "period", panel.snapshot_list(calendar))
    want = []
    for k, p in rows:
        later = [q for other, q in rows if other == k and p is not None and q > p]
        want += [(k, p, s) for s in PERIODS if p is not None and s >= p and s < min([*later, 10**6])]
    assert sorted(map(tuple, got.select("k", "period", "snapshot").collect())) == sorted(want)
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert lifecycle.carry_forward(states, ["k"], "period", panel.snapshot_list(calendar.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["trailing_window_join", "trailing_window_yyyymm"])
def test_periods_are_summed_before_they_are_spread(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Aggregate [xin_value" in text[text.index("Generate explode(scalar-subquery") if "Generate explode(scalar-subquery" in text else text.index("Generate explode("):]
