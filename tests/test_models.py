"""Invariants of sampling, outlier removal and models."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.operators import evaluate, models, neighbours, outliers, sampling

TREES = specs.BoostedTrees(n_estimators=3, learning_rate=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    data = [
        (i, float(x), float(y), int(x + 0.3 * rng.normal() > 1))
        for i, (x, y) in enumerate(rng.normal(size=(400, 2)))
    ]
    return spark.createDataFrame(data, "id bigint, x double, y double, target int").cache()


def test_upsample_balances_and_repeats(rows):
    one, two = (sampling.upsample_minority(rows, ["id"]) for _ in range(2))
    sizes = sampling.class_sizes(one)
    assert sizes[0] == sizes[1]
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(one) == ids(two)


@pytest.mark.parametrize("n,spec,want", [
    (10, specs.CHURN_SPLIT, (7, 21, 6)), (10, specs.UPSELL_SPLIT, (7, 22, 7)),
    (4, specs.CHURN_SPLIT, (3, 9, 3)), (0, specs.UPSELL_SPLIT, (0, 0, 0)),
])
def test_split_sizes(n, spec, want):
    sizes = sampling.split_sizes(n, spec)
    assert (sizes["train_ones"], sizes["train_zeros"], sizes["test_zeros"]) == want


def test_split_parts_are_disjoint(rows):
    parts = sampling.ratio_split(rows.filter("y < 1.5"), rows, ["id"]).toPandas()
    assert parts.id.is_unique
    n_ones = rows.filter("y < 1.5 AND target = 1").count()
    counts = parts.groupby(["part", "target"]).size()
    assert counts["train", 1] + counts["test", 1] == n_ones
    assert counts["train", 0] == 3 * counts["train", 1]


def test_isolation_drops_the_stated_share_of_class_0(rows):
    kept = outliers.isolation_outliers(rows, ["id"], ["x", "y"], trees=20).toPandas()
    zeros = rows.filter("target = 0").count()
    assert (kept.target == 1).sum() == rows.filter("target = 1").count()
    assert abs((kept.target == 0).sum() - 0.85 * zeros) <= 0.02 * zeros
    radius = lambda pdf: np.hypot(pdf.x, pdf.y)[pdf.target == 0].max()
    assert radius(kept) <= radius(rows.toPandas())


def test_forest_walks_all_trees_as_one_by_one():
    """Depths from the arrays equal a walk through each tree's nodes, for batches of any size."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    rows = pd.concat([outliers._grow(x[rng.integers(0, 300, 64)], tree, 1) for tree in range(9)])
    want = np.zeros(len(x))
    for _, nodes in rows.groupby("tree"):
        node = nodes.set_index("node")
        for k, point in enumerate(x):
            at = 0
            while node.feature[at] >= 0:
                at = node.left[at] if point[node.feature[at]] < node.cut[at] else node.right[at]
            want[k] += node.depth[at] / 9
    forest = outliers.Forest.of(rows)
    assert forest.mean_depths(x) == pytest.approx(want) and forest.mean_depths(x, 7) == pytest.approx(want)
    assert len(forest.mean_depths(x[:0])) == 0 and list(outliers.Forest.of(rows[:0]).mean_depths(x[:2])) == [0, 0]


def test_isolation_ranks_a_far_point_first(spark, rows):
    far = rows.select("id", "x", "y").union(spark.createDataFrame([(9999, 40.0, -40.0)], "id bigint, x double, y double"))
    scored = outliers.isolation_scores(far, ["id"], ["x", "y"], trees=20)
    assert scored.orderBy(F.desc("anomaly_score")).first().id == 9999


def test_every_row_is_scored_once_and_learns(rows):
    scores = models.out_of_fold_scores(rows, ["x", "y"], ["id"], TREES, folds=3)
    assert scores.count() == 400 and scores.select("id").distinct().count() == 400
    summary = models.summarize_folds(scores).first()
    assert summary.folds == 3 and 0.8 < summary["min"] <= summary["mean"] <= summary["max"] <= 1


def test_fold_auc_equals_roc_auc(rows):
    scores = rows.select("id", "target", (F.round(F.col("x"), 1) / 10 + 0.5).alias("probability"))
    one = models.fold_auc(scores.withColumn("fold", F.lit(0))).first().auc
    assert one == pytest.approx(evaluate.roc_auc(scores).first().auc)


def test_importance_is_paired_by_position(rows):
    model = models.fit_boosted(rows, ["y", "x"], TREES)
    ranked = evaluate.rank_importance(models.feature_importance(model, ["y", "x"], rows)).collect()
    assert [r.feature for r in ranked] == ["x", "y"] and ranked[0].sign == "positive"


def test_probe_is_reproducible_and_in_range(rows):
    one = sampling.random_probe(rows, ["id"]).toPandas().sort_values("id")
    two = sampling.random_probe(rows.repartition(3), ["id"]).toPandas().sort_values("id")
    assert list(one.random) == list(two.random) and one.random.between(0, 999).all()


def brute(points: dict, k: int):
    for i, a in points.items():
        near = sorted((np.hypot(a[0] - b[0], a[1] - b[1]), j) for j, b in points.items() if j != i)
        yield i, [j for _, j in near[:k]]


def test_neighbours_are_exact_with_a_third_of_copies(spark):
    rng = np.random.default_rng(2)
    points = {i: (1.0, 1.0) if i % 3 == 0 else tuple(map(float, rng.normal(size=2))) for i in range(150)}
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id bigint, x double, y double")
    got = neighbours.nearest_neighbours(df, "id", ["x", "y"], 4, block=10).toPandas()
    found = {i: list(g.sort_values("nth").neighbour) for i, g in got.groupby("id")}
    assert found == dict(brute(points, 4))


def test_visits_are_few_where_rows_are_clustered(spark):
    """Clusters apart from each other: a row visits few cells besides its own, out of many pivots."""
    r = np.random.default_rng(6)
    centres = r.normal(size=(30, 8)) * 20
    points = np.repeat(centres, 60, 0) + r.normal(size=(1800, 8)) * 0.5
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(points)], "id bigint, x array<double>")
    _, visits, _, pivots = neighbours.cells_and_visits(df, 1800, 5, 1, 2048)
    per_row = visits.count() / 1800
    assert pivots == 42 and per_row < 5 and visits.select("id").distinct().count() == 1800


def test_smote_balances_on_lines_between_neighbours(rows):
    out = neighbours.smote(rows, "id", ["x", "y"], 3).toPandas()
    assert (out.target == 0).sum() == (out.target == 1).sum()
    ones = {r.id: (r.x, r.y) for r in rows.filter("target = 1").collect()}
    lines = [(np.array(ones[i]), np.array(ones[j])) for i, near in brute(ones, 3) for j in near]
    for made in out[out.id.isna()][["x", "y"]].to_numpy():
        off = min(
            abs(np.linalg.norm(made - a) + np.linalg.norm(made - b) - np.linalg.norm(a - b)) for a, b in lines
        )
        assert off < 1e-9


def test_evaluation_holds_together(spark, sf_dir):
    """All parts of one evaluation come from the same scores; synthetic rows are in none of them."""
    from dataclasses import replace

    from cohortry import specs
    from cohortry.catalog.modelling import vectors
    from cohortry.plans import propensity as P

    columns = [f"e{i}" for i in range(6)]
    rows = vectors(spark, sf_dir).selectExpr("CAST(vec_id AS STRING) AS company_new", *columns, "target")
    ready = P.Prepared(rows, rows, columns)
    few = replace(P.CHURN_MODEL, trees=specs.BoostedTrees(n_estimators=3, learning_rate=0.3))
    got = P.evaluate_model(ready, few, folds=2, oversample=True)
    n = {(r.target, r.predicted): r.n for r in got.confusion.collect()}
    report = {r.label: r for r in got.report.collect()}
    assert sum(n.values()) == report["accuracy"].support == got.distribution.agg({"n": "sum"}).first()[0]
    right = sum(v for (a, b), v in n.items() if a == b) / sum(n.values())
    rates = {r.part: r.accuracy for r in got.accuracy.collect()}
    assert rates["test"] == pytest.approx(right) == report["accuracy"].precision
    assert got.cross_validation.first().folds == 2
    assert got.importance.count() == len(columns) and got.roc.count() > 0
    keys = {r.company_new for r in rows.filter("target = 0").collect()}
    assert {r.company_new for r in got.false_positives.collect()} <= keys
    assert P.search(ready, few, {"max_depth": [1, 2]}, folds=2).trees.max_depth in (1, 2)


def test_search_names_every_parameter(rows):
    """Weights, column shares and gains can be searched too; each combination has its AUC."""
    grid = {"positive_weight": [1.0, 3.0], "column_share": [0.5, 1.0], "min_gain": [0.0, 1e9]}
    found = models.search_trees(rows, ["x", "y"], TREES, grid, folds=2)
    assert len(found) == 8 and {f.min_gain for f, _ in found} == {0.0, 1e9}
    assert all(auc == pytest.approx(0.5) if f.min_gain else auc > 0.8 for f, auc in found)


@pytest.mark.parametrize("name", ["grid_search", "kfold_auc", "param_sweep", "rank_importance", "full_coverage_scoring"])
def test_model_queries_fit_the_models_own_trees(spark, sf_dir, monkeypatch, name):
    """Full numbers of trees are asked for; the fits themselves are cut short here."""
    from dataclasses import replace

    from cohortry.catalog import QUERIES

    asked, build = set(), models.boosted_classifier

    def short(spec, count=None):
        asked.add(spec.n_estimators)
        return build(replace(spec, n_estimators=1), count)

    monkeypatch.setattr(models, "boosted_classifier", short)
    got = QUERIES[name](spark, sf_dir)
    assert asked == ({100} if name == "full_coverage_scoring" else {100, 110})
    assert name == "full_coverage_scoring" or {r.model for r in got.collect()} == {"churn", "upsell"}


def test_halving_finds_the_winner_of_the_full_grid(spark):
    """Shares grow and hold the earlier ones, the last round sees all rows, and the winner is the full grid's."""
    r = np.random.default_rng(11)
    data = [(k, float(x), float(y), int((x > 0) != (y > 0.3))) for k, (x, y) in enumerate(r.normal(size=(900, 2)))]
    crossed = spark.createDataFrame(data, "id bigint, x double, y double, target int")
    grid = {"max_depth": [1, 5], "min_rows_per_leaf": [1, 120, 400]}
    folded = crossed.withColumn("f", sampling.fold_of(["id"], 3, 2).cast("int"))
    full = models.search_specs(folded, ["x", "y"], models.combinations(TREES, grid), fold_col="f")
    tried = models.halving_search(crossed, ["id"], ["x", "y"], TREES, grid, least_positives=100)
    assert len(full) == 6 and [t[0] for t in tried] == [0] * 6 + [1] * 2
    assert tried[0][1] < tried[-1][1] == 1.0
    assert tried[-1][2] == max(full, key=lambda x: x[1])[0] == models.replace(TREES, max_depth=5, min_rows_per_leaf=1)
