"""Steps whose figures grew too fast: fewer copies, fewer passes, bounded frames."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import bindings as B
from cohortry.catalog import panels as P
from cohortry.catalog import tables as C
from cohortry.functions import scalars as S
from cohortry.operators import lifecycle, models, neighbours, outliers, panel, party, running, stats
from cohortry.plans import features


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_are_grouped_before_they_are_turned_round(spark, sf_dir):
    text = plan(party.partner_pairs(C.transactions(spark, sf_dir)))
    assert text.index("Generate explode") < text.index("Aggregate [sender_xin_value")


def test_amounts_are_counted_and_summed_in_one_pass(spark, sf_dir, monkeypatch):
    passes = []
    monkeypatch.setattr(party, "party_rows", lambda *a, _own=party.party_rows: passes.append(1) or _own(*a))
    monkeypatch.setattr("cohortry.functions.quantiles.hot_groups", None)
    assert party.amount_stats(C.transactions(spark, sf_dir)).count() > 0 and len(passes) == 1


def test_visits_are_handed_on_in_bounded_frames():
    rng = np.random.default_rng(1)
    x = np.empty(50, object)
    x[:] = [list(map(float, v)) for v in rng.normal(size=(50, 2))]
    d, radius, reach = rng.random((50, 7)), rng.random(7) * 0.1, np.full(50, 0.9)
    frames = list(neighbours.visits_of(np.arange(50), x, d, radius, reach, most=30))
    assert len(frames) > 1 and max(map(len, frames)) <= 30
    got = {(i, c) for f in frames for i, c in zip(f["id"], f["cell"])}
    assert got == {(i, c) for i in range(50) for c in range(7) if d[i, c] - radius[c] <= 0.9}


def test_last_rows_have_the_running_columns_of_the_whole_panel(spark, sf_dir):
    rows = P.raw_panel(spark, sf_dir, P.QUARTERS)
    last = running.last_accumulated(rows, P.QUARTERS)
    want = running.last_row_per_company(running.panel_accumulate(rows, P.QUARTERS))
    columns = sorted(want.columns)
    frame = lambda df: B.presented(df.select(*columns)).toPandas().sort_values("company").reset_index(drop=True)
    assert "Window [" not in plan(last).split("Aggregate [company")[0] and frame(last).equals(frame(want))


def test_rounding_and_labels_are_the_slow_ones(spark):
    rng = np.random.default_rng(2)
    values = [0.0, -0.0, 0.5, 0.005, 1e-7, 123456.789, 1e9 + 0.125, 999999999.123456, float("nan"), float("inf"), None]
    values += [float(v) for v in rng.normal(size=500) * 1e4] + [float(round(v, 3)) for v in rng.normal(size=500) * 1e5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.filter(~B.rounded(F.col("v")).eqNullSafe(F.round("v", 6))).count() == 0
    months = spark.range(-5, 130_000, 7).selectExpr("CAST(id AS INT) AS m")
    slow = lambda grain: F.date_format(F.date_sub(S.period_end("m", grain), 1), "yyyyMM")
    for grain in ("month", "quarter"):
        inside = months.filter(F.col("m").between(12, 119_000 if grain == "month" else 39_000))
        assert inside.filter(S.period_label("m", grain) != slow(grain)).count() == 0
    assert "WHEN" in plan(months.select(S.period_label("m")))


def test_tree_samples_are_picked_by_keys_alone(spark):
    df = spark.range(0, 3000).selectExpr("id % 2900 AS k", "CAST(id AS DOUBLE) AS x")
    share = (2 * outliers.SAMPLE + 64) / 3000
    h = lambda t: F.pmod(F.xxhash64("k", t, F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    want = df.withColumn("tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(4)), lambda t: h(t) < F.lit(share))))
    got = outliers.tree_samples(df, ["k"], 5, 1)
    assert "lambdafunction" not in plan(got) and "Join" in plan(got)
    sizes = dict(got.groupBy("tree").count().collect())
    assert sizes == {t: min(n, outliers.SAMPLE) for t, n in want.groupBy("tree").count().collect()}
    assert got.join(want, ["k", "x", "tree"], "left_anti").count() == 0 and got.distinct().count() == got.count()


def test_moments_come_from_aggregates_of_few_columns(spark, monkeypatch):
    columns = [f"c{k}" for k in range(20)]
    df = spark.range(50).select(*[(F.col("id") * k % 7).cast("double").alias(c) for k, c in enumerate(columns)])
    sizes, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *cols: sizes.append(agg(self, *cols)) or sizes[-1])
    found, x = stats.fit_moments(df, columns), df.toPandas()
    assert found == {c: (pytest.approx(x[c].mean()), pytest.approx(x[c].std(ddof=0))) for c in columns}
    assert all(plan(part).count("avg(") <= stats.TOGETHER for part in sizes) and stats.fit_moments(df, []) == {}


def test_a_round_of_halving_is_fitted_at_once(spark, monkeypatch):
    """Four parameter sets on three folds."""
    assert models.FITS >= 12


@pytest.mark.parametrize("spec", [specs.RFM_SNAPSHOTS, P.QUARTERS, specs.SnapshotSpec(senders_only=True, hot_rows=20)])
def test_newest_rows_without_a_panel_are_those_of_the_panel(spark, sf_dir, monkeypatch, spec):
    p = C.prepared(spark, sf_dir)
    companies, churn = lifecycle.company_master(p.events, p.registry), lifecycle.churn_premium(p.events)
    whole = panel.feature_panel(p.tx, p.events, p.ids, companies, churn, spec).drop("snapshot")
    want = running.last_row_per_company(running.panel_accumulate(whole, spec))
    monkeypatch.setattr(panel, "feature_panel", None)
    last = features.build_latest_tables(p, spec).behaviour
    frame = lambda df: B.presented(df.select(*sorted(last.columns))).toPandas().sort_values("company").reset_index(drop=True)
    got = frame(last)
    assert len(got) > 0 and got.equals(frame(want))
