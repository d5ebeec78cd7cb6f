"""Null, tie and boundary rules on hand-made rows."""

from __future__ import annotations

from datetime import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions import scalars as S
from cohortry.operators import cleaning, evaluate, identity, labels, lifecycle, panel, party, running
from cohortry.operators import models, segment, stats
from cohortry.sources import readers, schemas, sinks

TX = (
    "id bigint, timestamp timestamp, company_id bigint, company_plan int, channel string, "
    "channel_original string, success boolean, state string, kind string, `import` decimal(18,2), "
    "international int, sender_xin_value string, receiver_xin_value string"
)


def tx(spark, *rows):
    base = dict(
        id=0, timestamp=dt(2020, 1, 15), company_id=11, company_plan=0, channel=None,
        channel_original=None, success=None, state=None, kind=None, amount=1, international=0,
        sender="A", receiver="B",
    )
    filled = []
    for n, row in enumerate(rows):
        r = {**base, "id": n, **row}
        filled.append(tuple(r[k] for k in base))
    df = spark.createDataFrame(
        [(*r[:9], Decimal(str(r[9])), *r[10:]) for r in filled], TX
    )
    return readers.scan_transactions(df)


EVENTS = "`@timestamp` timestamp, company bigint, action string, plan int, payment_type string, date_last_updated timestamp, event_id bigint"


def events(spark, *rows):
    return spark.createDataFrame(
        [(t, c, a, p, pay, t, n) for n, (t, c, a, p, pay) in enumerate(rows)], EVENTS
    )


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_not_equal_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    kept = [r.x for r in cleaning.exclude_values(df, {"x": ("a",)}).collect()]
    assert kept == ["b", None]


def test_last_value_skips_missing_and_ties_use_the_key(spark):
    t1, t2 = dt(2020, 1, 1), dt(2020, 1, 2)
    ev = events(
        spark, (t1, 1, "alta", 0, "Card"), (t2, 1, None, 1, None), (t2, 1, "baixa", None, None),
        (t1, 2, None, None, None),
    )
    assert rows(lifecycle.last_state(ev, ("action", "plan", "payment_type")), "company", "action", "plan", "payment_type") == [
        (1, "baixa", 1, "Card"), (2, None, None, None),
    ]


def test_mode_prefers_the_smallest_on_ties(spark):
    data = tx(
        spark, {"channel": "b"}, {"channel": "a"}, {"channel": None},
        {"sender": "C", "channel": None}, {"sender": "D", "channel": "z"}, {"sender": "D", "channel": "z"},
        {"sender": "D", "channel": "y"},
    )
    got = {r.xin_value: r.channel_sent for r in party.modal_channel(data).collect()}
    assert (got["A"], got["C"], got["D"]) == ("a", None, "z")


def test_median_interpolates_and_uses_absolute_amounts(spark):
    data = tx(spark, {"amount": -10}, {"amount": 5}, {"amount": 7}, {"amount": 100})
    got = {r.xin_value: r for r in party.amount_stats(data).collect()}
    assert (got["A"].import_med_sent, float(got["A"].import_sum_sent), float(got["A"].import_max_sent)) == (8.5, 122.0, 100.0)
    assert (got["A"].import_med_rec, float(got["A"].import_sum_rec)) == (0.0, 0.0)


def test_day_differences(spark):
    df = spark.createDataFrame(
        [(dt(2020, 1, 2, 1), dt(2020, 1, 1, 23)), (dt(2020, 1, 1, 23), dt(2020, 1, 2, 1)),
         (dt(2020, 1, 3), dt(2020, 1, 1))], "e timestamp, s timestamp",
    ).select(S.calendar_days("e", "s").alias("c"), S.elapsed_days("e", "s").alias("d"))
    assert [tuple(r) for r in df.collect()] == [(1, 0), (-1, -1), (2, 2)]


def test_date_shift_clamps_to_the_month_end(spark):
    df = spark.createDataFrame([(dt(2020, 3, 31, 12, 30),)], "t timestamp").select(
        S.minus_months("t", 1).alias("m"), S.minus_days("t", 31).alias("d")
    )
    assert tuple(df.first()) == (dt(2020, 2, 29, 12, 30), dt(2020, 2, 29, 12, 30))


@pytest.mark.parametrize("success", [True, False, None])
@pytest.mark.parametrize("state", ["sent", "paid", None, *specs.FAILED_STATES])
def test_success_matrix(spark, success, state):
    data = tx(spark, {"success": success, "state": state})
    got = party.tx_success(data).filter("xin_value = 'A'").first()
    failed = state in specs.FAILED_STATES
    ok = success is True or (success is None and not failed)
    bad = success is False or (success is None and state == "refused") or (failed and state != "refused")
    assert (got.success_true, got.success_false) == (int(ok), int(bad))


def test_partner_in_both_halves_counts_twice(spark):
    data = tx(
        spark, {"state": "sent"}, {"state": "received"}, {"state": "sent"},
        {"state": "sent", "receiver": "A"}, {"state": "sent", "receiver": None},
    )
    got = {r.xin_value: (r.num_receivers, r.num_senders) for r in party.distinct_counterparties(data).collect()}
    # A met B sent and received, and itself; as a receiver A met itself.
    assert got == {"A": (3, 1), "B": (0, 2)}


def test_trailing_window_over_a_year_end(spark):
    data = tx(spark, *[{"timestamp": dt(y, m, 5)} for y, m in ((2019, 11), (2019, 12), (2020, 1), (2020, 2))])
    count = lambda spec: {
        r.snapshot % 12 + 1: r["count"]
        for r in panel.trailing_rows(data, spec).groupBy("snapshot").count().collect()
    }
    assert count(specs.SnapshotSpec(window="trailing")) == {11: 1, 12: 2, 1: 3, 2: 3}
    literal = specs.SnapshotSpec(window="trailing", yyyymm_arithmetic=True)
    assert count(literal) == {11: 1, 12: 2, 1: 1, 2: 2}


def test_identity_many_to_many(spark):
    registry = spark.createDataFrame([(11, "R1"), (12, None), (13, None)], "company_id bigint, xin_value string")
    data = tx(
        spark, {"company_id": 11, "state": "sent", "sender": "R1"},
        {"company_id": 12, "state": "sent", "sender": "S"}, {"company_id": 13, "state": "sent", "sender": "S"},
        {"company_id": 13, "kind": "issue", "state": "paid", "sender": "T", "receiver": "U"},
        {"company_id": 13, "state": "sent", "sender": "V", "channel_original": "peppol_x"},
    )
    assert rows(identity.resolve_party_ids(data, registry, ()), "company_id", "xin_value") == [
        (11, "R1"), (13, "S"), (13, "T"), (13, "U"),
    ]


def test_latest_version_breaks_ties_by_key(spark):
    t = dt(2020, 1, 1)
    versions = spark.createDataFrame(
        [(1, t, "a", 1), (1, t, "b", 2), (2, t, "c", 1)],
        "company_id bigint, date_last_updated timestamp, plan string, version int",
    )
    assert rows(cleaning.latest_version(versions, "version"), "company_id", "plan") == [(1, "b"), (2, "c")]


def test_correction_delete_and_swap(spark):
    a, b = dt(2020, 1, 1), dt(2020, 2, 1)
    ev = events(spark, (a, 1, "alta", 0, None), (b, 1, "alta", 1, None), (a, 2, "renovacio", 1, None))
    fixed = cleaning.apply_corrections(ev, [
        specs.Correction("delete", {"company": 2, "action": "renovacio"}),
        specs.Correction("swap", {"company": 1, "plan": 0}, {"company": 1, "plan": 1}),
        specs.Correction("swap", {"company": 9}, {"company": 1}),
    ])
    assert rows(fixed, "company", "plan", "@timestamp") == [(1, 0, b), (1, 1, a)]


def test_tenure_edges(spark):
    df = spark.createDataFrame([(d,) for d in (-5, 179, 180, 365, 366, None)], "d bigint")
    assert [r[0] for r in df.select(S.tenure_years("d")).collect()] == [0, 0, 1, 1, 2, None]


def test_surrogate_is_stable(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "X")], "c bigint, x string")
    ids = [r[0] for r in df.select(S.surrogate_party_id("x", "c")).collect()]
    assert ids[0] == ids[1] and ids[0].startswith("IN") and len(ids[0]) == 11 and ids[2] == "X"


def test_rfm_edges(spark):
    cases = [  # plan, import, transactions, days, tenure -> r, f, m
        ("business", 200.0, 0.0, 30, 1, 4, 1, 1), ("business", 200.01, 1.0, 31, 1, 3, 2, 2),
        ("business", 1100.0, 4.0, 95, 1, 3, 3, 2), ("business", 5000.0, 4.5, 96, 1, 2, 4, 3),
        ("business", 5000.01, 0.5, 365, 1, 2, 2, 4), ("basic", 0.0, -1.0, 366, 1, 1, None, 1),
        ("basic", 5000.0, 2.0, None, 30, 4, 3, 2), ("basic", 50000.0, 2.5, None, 96, 2, 4, 3),
        ("basic", None, None, None, 400, 1, None, None), ("basic", 1.0, 1.0, None, None, None, 2, 2),
    ]
    df = spark.createDataFrame(
        [c[:5] for c in cases],
        "plan string, `import` double, num_transactions double, days_until_last_transaction bigint, days_since_alta_basic bigint",
    )
    assert [(r.r, r.f, r.m) for r in segment.rfm_scores(df).collect()] == [c[5:] for c in cases]


def test_segment_rules(spark):
    # plan, days since last tx, days since premium end, r, f, m, transactions, receivers -> segment
    cases = [
        ("basic", 5, 10, 4, 2, 1, 3, 2, "Downgrades"), ("basic", 5, None, 4, 1, 1, 0, 0, "Recent clients"),
        ("basic", 5, None, 1, 2, 1, 3, 2, "Lost"), ("basic", 5, None, 2, 1, 1, 0, 0, "Inactive"),
        ("basic", 5, None, 4, 2, 1, 3, 1, "Low engagement"), ("basic", 5, None, 2, 3, 1, 3, 2, "Normal"),
        ("basic", 5, None, 3, 2, 3, 3, 2, "Normal"), ("basic", 5, None, 3, 2, 4, 3, 2, "Bullies"),
        ("basic", 5, None, 4, 3, 3, 3, 2, "Normal"), ("basic", 5, None, 2, 2, 1, 3, 2, "Sporadic"),
        ("basic", 5, None, 2, 1, 1, 3, 2, "Sporadic"), ("basic", 5, None, 2, None, 1, 3, 2, ""),
        ("business", 5, 10, 4, 2, 1, 3, 2, "Downgrades"), ("business", 5, None, 3, 1, 1, 0, 0, "Recent clients"),
        ("business", 5, None, 2, 1, 1, 3, 2, "Almost lost"), ("business", 5, None, 3, 1, 1, 3, 1, "Low engagement"),
        ("business", 5, None, 3, 2, 4, 3, 2, "Big companies"), ("business", 5, None, 3, 3, 3, 3, 2, "Loyals"),
        ("business", 5, None, 3, 2, 3, 3, 2, "Normal"), ("business", 5, None, 3, 1, 3, 3, 2, "Sporadic"),
    ]
    df = spark.createDataFrame(
        [c[:8] for c in cases],
        "plan string, days_until_last_transaction int, days_since_baixa_prem int, r int, f int, m int, sum_transactions int, receivers int",
    )
    assert [r.segment for r in segment.assign_segments(df).collect()] == [c[8] for c in cases]


def test_label_only_snapshots_before_the_event(spark):
    df = spark.createDataFrame(
        [(1, "X", m, d) for m, d in (("202001", -60), ("202002", -30), ("202003", 1))]
        + [(2, "Y", "202001", None)],
        "company bigint, xin_value string, timestamp_ym string, days bigint",
    )
    out = labels.label_last_snapshot(df.filter(labels.before_event("days")))
    assert rows(out, "company", "timestamp_ym", "target") == [
        (1, "202001", 0), (1, "202002", 1), (2, "202001", 1),
    ]


def test_dominant_channel_ties_and_none(spark):
    flags = [f"{c}_acum" for c in specs.CHANNEL_FLAGS]
    df = spark.createDataFrame([(0,) * 6, (0, 2, 0, 2, 0, 0), (0, 0, 0, 0, 0, 1)], flags)
    got = [r[0] for r in df.select(S.dominant_channel()).collect()]
    assert got == ["no channel", "mail_acum", "b2brouter_acum"]


def test_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    train, _ = stats.standardize(df, df, ["a", "b"])
    assert [r.b for r in train.collect()] == [0.0, 0.0, 0.0]
    assert round(train.agg(F.stddev_pop("a")).first()[0], 9) == 1.0
    r = {(x.i, x.j): x.r for x in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert r["a", "b"] is None and r["a", "a"] == pytest.approx(1.0)


def test_score_ties(spark):
    df = spark.createDataFrame([(i % 2, 0.5) for i in range(10)], "target int, probability double")
    assert evaluate.roc_auc(df).first()[0] == 0.5
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.9)], "target int, probability double")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(0.875)
    hard = evaluate.threshold_predict(df, 0.4).agg(evaluate.hard_auc()).first()[0]
    assert hard == pytest.approx(0.75)


def test_running_columns_carry_through_months(spark):
    df = spark.createDataFrame(
        [(1, "X", f"20200{m}", n) for m, n in ((1, 4), (2, 0), (3, 9))],
        "company bigint, xin_value string, timestamp_ym string, n bigint",
    ).select(
        "timestamp_ym", running.running_median("n", "med"), running.running_sum("n", "s"),
        running.running_max("n", "top"),
    )
    assert rows(df, "timestamp_ym", "med", "s", "top") == [
        ("202001", 4.0, 4, 4), ("202002", 2.0, 4, 4), ("202003", 4.0, 13, 9),
    ]


def test_first_window_bound(spark):
    data = panel.with_period(tx(spark, {"timestamp": dt(2020, 1, 5)}, {"timestamp": dt(2020, 2, 5)}), specs.RFM_SNAPSHOTS)
    rolled = panel.rollup(data)
    count = lambda spec: rows(
        panel.party_features(data, rolled, panel.snapshot_list(rolled), spec).filter("xin_value = 'A'")
        .na.fill(0), "snapshot", "trans_sum_sent",
    )
    assert [n for _, n in count(specs.SnapshotSpec())] == [1, 1]
    assert [n for _, n in count(specs.SnapshotSpec(first_after="202006"))] == [0, 1]


def test_csv_with_row_numbers_and_partitioned_table(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    head = ",".join(["Unnamed: 0", *schemas.TRANSACTIONS.names])
    line = "0,7,2020-01-05 10:00:00,11,basic,email,True,sent,n,ES,t,10.50,False,issue,d,r,A,B"
    (folder / "transs.csv").write_text(f"{head}\n{line}\n")
    df = readers.scan_transactions(readers.read_exported_csv(spark, str(folder), schemas.TRANSACTIONS))
    row = df.first()
    assert (row.id, row.success, float(row["import"]), row.timestamp_ym) == (7, True, 10.5, "202001")
    path = sinks.write_table(df, str(tmp_path / "out"), partition_by="timestamp_ym")
    back = cleaning.in_period(readers.read_table(spark, path), start="202001", before="202002")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 1 and "timestamp_ym" in plan.split("PartitionFilters")[1][:80]


def test_unknown_plan_names_are_an_error(spark):
    df = spark.createDataFrame([("basic",), ("2",), (None,)], "p string")
    assert [r[0] for r in df.select(S.plan_ordinal("p")).collect()] == [0, 2, -1]
    with pytest.raises(Exception, match="unknown plan name: gold"):
        spark.createDataFrame([("gold",)], "p string").select(S.plan_ordinal("p")).collect()


def test_curve_of_no_scores(spark):
    none = spark.createDataFrame([], "target int, probability double, fold int")
    assert evaluate.roc_points(none).count() == 0 and evaluate.roc_auc(none).first().auc is None
    assert models.fold_auc(none).count() == 0
    same = spark.createDataFrame([(1, 0.5, 0), (0, 0.5, 0)], "target int, probability double, fold int")
    assert evaluate.roc_auc(same).first().auc == 0.5 and models.fold_auc(same).first().auc == 0.5


def test_correlation_uses_pairs_that_are_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 1.0), (3.0, 4.0, 2.0), (4.0, 3.0, 9.0), (None, 7.0, 1.0)]
    got = {(r.i, r.j): r.r for r in stats.correlation_matrix(spark.createDataFrame([(*r, 5.0) for r in rows], "a double, b double, c double, d double"), ["a", "b", "c", "d"]).collect()}
    assert got["a", "b"] == pytest.approx(0.6) and got["b", "a"] == got["a", "b"] and got["a", "a"] == pytest.approx(1)
    assert got["a", "d"] is None and got["d", "d"] is None


def test_stored_tables_lie_in_the_runs_folder(spark):
    from cohortry.functions import scale

    stored = scale.materialized(spark.range(3))
    path = stored.inputFiles()[0]
    assert spark.sparkContext.applicationId in path
