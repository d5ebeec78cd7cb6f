"""Plans and the paths that only very large groups take."""

from __future__ import annotations

import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import bindings as B
from cohortry.catalog import panels as P
from cohortry.catalog import tables as C
from cohortry.functions.quantiles import quantiles
from cohortry.functions.scale import lowest, numbered
from cohortry.operators import party, running
from cohortry.sources import readers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def frame(df, *keys):
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


@pytest.mark.parametrize("spec", [specs.RFM_SNAPSHOTS, P.TRAILING], ids=["period", "trailing"])
def test_panel_is_the_same_with_hot_parties(spark, sf_dir, spec):
    keys = ("company", "xin_value", "timestamp_ym")
    usual = frame(B.presented(P.raw_panel(spark, sf_dir, spec)), *keys)
    hot = frame(B.presented(P.raw_panel(spark, sf_dir, replace(spec, hot_rows=40))), *keys)
    assert len(usual) > 0 and usual.equals(hot[usual.columns])


def test_amounts_are_the_same_with_hot_parties(spark, sf_dir):
    tx = C.transactions(spark, sf_dir)
    usual, hot = frame(party.amount_stats(tx), "xin_value"), frame(party.amount_stats(tx, 20), "xin_value")
    assert usual.equals(hot)


def test_quantiles_with_one_value_holding_a_third(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(400, 7.25), rng.lognormal(3, 2, 800), [1e9, -1e9]])
    df = spark.createDataFrame([(1, float(v)) for v in values], "k int, v double")
    got = quantiles(df, ["k"], "v", {"a": 0.1, "b": 0.5, "c": 0.99}, hot_rows=100).first()
    assert [got.a, got.b, got.c] == pytest.approx(np.quantile(values, [0.1, 0.5, 0.99]))


def test_two_thousand_hot_groups_are_joined_by_shares(spark, monkeypatch):
    """More hot groups than are broadcast: the same quantiles, and no join of rows on the group alone."""
    from cohortry.functions import quantiles as Q

    df = spark.range(60_000).selectExpr("CAST(id % 2500 AS INT) AS k", "CAST((id * 7919) % 1013 AS DOUBLE) AS v", "id").where("k < 2000 OR id < 10000")
    probs = {"a": 0.25, "b": 0.5}
    stored, plans = Q.materialized, []
    monkeypatch.setattr(Q, "materialized", lambda x: plans.append(plan(x)) or stored(x))
    hot = frame(quantiles(df, ["k"], "v", probs, hot_rows=20), "k")
    assert hot.equals(frame(quantiles(df, ["k"], "v", probs), "k")[hot.columns])
    assert not Q.checked(Q.hot_groups(df, ["k"], 20)).few
    joins = [line for text in plans for line in text.splitlines() if "Join " in line]
    assert sum("_salt" in line for line in joins) >= 3
    # Only the asked ranks and the buckets' counts, not rows, meet on the group alone.
    assert not [line for line in joins if re.search(r"Join \[k#\w+\], \[k#\w+\]", line) and "rank#" not in line]


def test_nested_outliers_leave_no_large_bucket(spark, monkeypatch):
    """Ordinary values beside two that are far out, in the order of both: all narrowed below the bound."""
    from cohortry.functions import quantiles as Q

    rng = np.random.default_rng(5)
    values = np.concatenate([rng.random(20_000) * 100, [1e8, 1e15, -1e12]])
    df = spark.createDataFrame([(1, float(v)) for v in values], "k int, v double")
    stored, kept = Q.materialized, []
    monkeypatch.setattr(Q, "materialized", lambda x: kept.append(stored(x)) or kept[-1])
    got = quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.999}, hot_rows=200).first()
    assert [got.a, got.b, got.c] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.999]), rel=1e-12)
    last = [x for x in kept if "_v" in x.columns][-1]
    assert last.groupBy("_node").count().filter("count > 200").isEmpty()


def test_narrowing_reads_stored_levels(spark, sf_dir):
    df = B.table(spark, sf_dir, "lineitem")
    text = plan(quantiles(df, ["l_returnflag"], "l_extendedprice", {"q": 0.5}, hot_rows=100))
    assert text.count("FileScan") <= 6


def test_period_bounds_reach_the_scan(spark, sf_dir, tmp_path):
    from cohortry.operators import cleaning

    raw = B.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("timestamp").alias("timestamp"), "o_orderkey")
    raw.write.parquet(str(tmp_path / "flat"))
    bounded = cleaning.in_period(readers.scan_transactions(spark.read.parquet(str(tmp_path / "flat"))), start="199607", before="199803", at="timestamp")
    text = plan(bounded)
    assert "GreaterThanOrEqual(timestamp,1996-07-01" in text and "LessThan(timestamp,19" in text
    readers.scan_transactions(raw).write.partitionBy("timestamp_ym").parquet(str(tmp_path / "months"))
    monthly = readers.scan_transactions(spark.read.parquet(str(tmp_path / "months")))
    parts = cleaning.in_period(monthly, start="199607", before="199803", at="timestamp")
    assert parts.count() == bounded.count() > 0
    assert "PartitionFilters: [isnotnull(timestamp_ym" in plan(parts)


def test_numbering_follows_the_hash(spark):
    df = spark.range(500).withColumn("t", F.col("id") % 2)
    got = numbered(df, ["id"], 5, by=["t"], digits=2).toPandas().sort_values(["t", "rank"])
    import hashlib

    for t, part in got.groupby("t"):
        want = sorted(part.id, key=lambda i: hashlib.md5(f"{i}|5".encode()).hexdigest())
        assert list(part.id) == want and list(part["rank"]) == list(range(1, 251))


def test_lowest_are_the_first_numbered(spark):
    df = spark.range(700)
    ranks = {r.id: r["rank"] for r in numbered(df, ["id"], 5, digits=1).collect()}
    for n in (0, 1, 333, 700, 900):
        got = {r.id for r in lowest(df, ["id"], 5, n, digits=1).collect()}
        assert got == {i for i, k in ranks.items() if k <= n}


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = B.table(spark, sf_dir, "orders").filter(F.col("o_custkey") > 10).select("o_orderkey")
    text = plan(df)
    assert "GreaterThan(o_custkey,10)" in text and "o_totalprice" not in text
    text = plan(readers.scan_lifecycle(B.lifecycle(spark, sf_dir)).select("company"))
    assert "GreaterThan(o_custkey,10)" in text and "o_totalprice" not in text


def test_accumulation_is_one_window(spark, sf_dir):
    stored = P.raw_panel(spark, sf_dir, specs.RFM_SNAPSHOTS)
    extra = plan(running.panel_accumulate(stored)).count("Window [") - plan(stored).count("Window [")
    assert extra == 1


def test_panel_stays_in_the_jvm(spark, sf_dir):
    text = plan(P.panel_accumulate(spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
