"""Labelled sets from one panel, and fits in few tasks."""

from __future__ import annotations

import pytest

from cohortry import specs
from cohortry.catalog import QUERIES, modelling
from cohortry.catalog import panels as P
from cohortry.catalog import tables as C
from cohortry.operators import models, panel
from cohortry.plans import features


@pytest.mark.parametrize("name", ["churn_training_set", "upsell_training_set"])
def test_one_panel_without_amounts_is_built(spark, sf_dir, monkeypatch, name):
    panels, medians = [], []
    monkeypatch.setattr(panel, "rollup", lambda *a, _own=panel.rollup, **k: panels.append(1) or _own(*a, **k))
    monkeypatch.setattr(panel, "period_medians", lambda *a, _own=panel.period_medians: medians.append(1) or _own(*a))
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert len(panels) == 1 and not medians


def test_lifetime_sums_are_those_of_the_plain_panel(spark, sf_dir):
    prepared = C.prepared(spark, sf_dir)
    columns = ["company", "xin_value", "timestamp_ym", "acum_0", "acum_1", "acum_2", "sum_trans_sent"]
    own, plain = (
        t.behaviour.select(*columns).toPandas().sort_values(columns).reset_index(drop=True)
        for t in (features.build_training_tables(prepared, P.TRAILING), features.build_tables(prepared, specs.RFM_SNAPSHOTS))
    )
    assert len(own) > 0 and own.equals(plain)


def test_both_models_share_one_panel(spark, sf_dir, monkeypatch):
    built = []
    monkeypatch.setattr(modelling.C, "prepared", lambda *a, _own=C.prepared: built.append(1) or _own(*a))
    assert set(modelling.training_sets(spark, sf_dir)) == {"churn", "upsell"} and len(built) == 1


def test_a_fit_reads_few_partitions(spark, monkeypatch):
    rows = spark.range(0, 400, numPartitions=16).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 2 AS INT) AS target")
    spec, seen, fits = specs.BoostedTrees(n_estimators=2), [], []
    fit = models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df: fits.append(1) or seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    models.fit_boosted(rows, ["x"], spec)
    found = models.search_trees(rows, ["x"], spec, {"max_depth": [1, 2]}, folds=2)
    # Two specs on two folds, and no further fit of the best one.
    assert seen == [1] * 5 and len(fits) == 5 and [trees.max_depth for trees, _ in found] == [1, 2]
