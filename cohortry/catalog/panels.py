"""Queries: snapshot panel, accumulations, segmentation.

The oracles rebuild every snapshot by brute force: all history up to the
snapshot is joined to it and aggregated again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import bindings as B
from cohortry.catalog import tables as C
from cohortry.catalog.bindings import day_diff, roles, stamp, with_
from cohortry.catalog.registry import query
from cohortry.functions import scalars as S
from cohortry.functions.scale import fresh_folder
from cohortry.operators import labels, lifecycle, panel, party, running, segment
from cohortry.plans import features
from cohortry.plans.segmentation import segment_customers
from cohortry.sources import readers, sinks

TRAILING = specs.SnapshotSpec(window="trailing")
QUARTERS = specs.SnapshotSpec(grain="quarter")

# Bounds that spread the test data over the segments.
BASIC = specs.RfmBounds((45_000, 50_000, 55_000), (0, 1, 2))
PREMIUM = specs.RfmBounds((45_000, 50_000, 55_000), (0, 1, 4))


# -- oracle pieces -----------------------------------------------------------------

def grained(sql: str, grain: str) -> str:
    """The period number of the inputs at another grain."""
    if grain == "month":
        return sql
    for ts in ("l_shipdate", "o_orderdate"):
        sql = sql.replace(
            f"year({ts}) * 12 + month({ts}) - 1", f"year({ts}) * 4 + quarter({ts}) - 1"
        )
    return sql


def panel_ctes(grain: str = "month", trailing: bool = False) -> list[str]:
    inside = "r.p <= m.m AND r.p > m.m - 3" if trailing else "r.p = m.m"
    months = "((s.m + 1) * 3)" if grain == "quarter" else "(s.m + 1)"
    at = f"CAST(make_date(({months} // 12)::INT, ({months} % 12 + 1)::INT, 1) AS TIMESTAMP)"
    monthly = """
monthly AS (SELECT party, role, p, count(*) AS n FROM roles GROUP BY ALL),
mstats AS (
  SELECT party, m, median(n) FILTER (role = 'sent') AS trans_med_sent, max(n) FILTER (role = 'sent') AS trans_max_sent,
    median(n) FILTER (role = 'rec') AS trans_med_received, max(n) FILTER (role = 'rec') AS trans_max_received
  FROM monthly r JOIN months m ON r.p <= m.m AND r.p > m.m - 3 GROUP BY ALL)"""
    extra = """coalesce(trans_med_sent, 0) AS trans_med_sent, coalesce(trans_max_sent, 0) AS trans_max_sent,
    coalesce(trans_med_received, 0) AS trans_med_received, coalesce(trans_max_received, 0) AS trans_max_received,"""
    return [
        grained(B.TX, grain), grained(B.EVENTS, grain), B.REGISTRY, B.PREPARED,
        *C.lifecycle_ctes("ev", "reg"), roles("ctx"),
        f"""
months AS (SELECT DISTINCT p AS m FROM ctx),
plans AS (
  SELECT company, m, arg_max(plan, {C.EV_ORDER})::BIGINT AS actual_plan
  FROM ev JOIN months ON ev.p <= m GROUP BY ALL),
spine AS (
  SELECT plans.company, plans.m, actual_plan, ids.xin_value
  FROM plans LEFT JOIN ids ON ids.company_id = plans.company),
win AS (
  SELECT party, m.m, count(*) FILTER (plan = 0) AS plan_0, count(*) FILTER (plan = 1) AS plan_1,
    count(*) FILTER (plan = 2) AS plan_2, count(*) FILTER (ok) AS success_true,
    count(*) FILTER (failed) AS success_false,
    count(*) FILTER (role = 'sent' AND international) AS international_sent,
    count(*) FILTER (role = 'rec' AND international) AS international_rec,
    count(*) FILTER (role = 'sent') AS trans_sum_sent, count(*) FILTER (role = 'rec') AS trans_sum_received,
    {C.AMOUNTS}
  FROM roles r JOIN months m ON {inside} GROUP BY ALL),
chcount AS (
  SELECT party, m.m, role, channel, count(*) AS n FROM roles r JOIN months m ON {inside}
  WHERE channel IS NOT NULL GROUP BY ALL),
chan AS (SELECT * FROM chcount
  QUALIFY row_number() OVER (PARTITION BY party, m, role ORDER BY n DESC, channel) = 1),
hist AS (
  SELECT party, m, arg_max(plan, {C.TX_ORDER}) FILTER (role = 'sent') AS last_trans_plan,
    arg_max(plan, {C.TX_ORDER}) FILTER (role = 'rec') AS last_trans_plan_rec,
    max(ts) FILTER (role = 'sent') AS last_sent, max(ts) FILTER (role = 'rec') AS last_rec,
    median(cents) FILTER (role = 'sent') / 100 AS med_import_sent_t,
    median(cents) FILTER (role = 'rec') / 100 AS med_import_rec_t,
    bool_or((role = 'sent' AND is_sent) OR (role = 'rec' AND is_rec)) AS listed, {C.PARTNERS}
  FROM roles JOIN months ON p <= m GROUP BY ALL)""",
        *([monthly] if trailing else []),
        f"""
panel AS (
  SELECT s.company, s.xin_value, strftime({at} - INTERVAL 1 DAY, '%Y%m') AS timestamp_ym, s.actual_plan,
    CASE WHEN listed THEN num_receivers ELSE 0 END AS num_receivers,
    CASE WHEN listed THEN num_senders ELSE 0 END AS num_senders,
    coalesce(plan_0, 0) AS plan_0, coalesce(plan_1, 0) AS plan_1, coalesce(plan_2, 0) AS plan_2,
    coalesce(last_trans_plan, -1)::BIGINT AS last_trans_plan,
    coalesce(last_trans_plan_rec, -1)::BIGINT AS last_trans_plan_rec,
    coalesce(success_true, 0) AS success_true, coalesce(success_false, 0) AS success_false,
    date_diff('day', last_sent, {at})::BIGINT AS days_from_last_transaction,
    date_diff('day', last_rec, {at})::BIGINT AS days_from_last_transaction_rec,
    coalesce(trans_sum_sent, 0) AS trans_sum_sent, coalesce(trans_sum_received, 0) AS trans_sum_received,
    {extra if trailing else ''}
    coalesce(import_med_sent, 0) AS import_med_sent, coalesce(import_med_rec, 0) AS import_med_rec,
    coalesce(import_max_sent, 0) AS import_max_sent, coalesce(import_max_rec, 0) AS import_max_rec,
    coalesce(import_sum_sent, 0) AS import_sum_sent, coalesce(import_sum_rec, 0) AS import_sum_rec,
    coalesce(med_import_sent_t, 0) AS med_import_sent_t, coalesce(med_import_rec_t, 0) AS med_import_rec_t,
    coalesce(international_sent, 0) AS international_sent, coalesce(international_rec, 0) AS international_rec,
    coalesce(cs.channel, '0') AS channel_sent, coalesce(cr.channel, '0') AS channel_rec,
    {day_diff(at, 'alta_basic')} AS days_since_alta_basic,
    {day_diff(at, 'alta_premium')} AS days_since_alta_premium,
    {day_diff(at, 'ended')} AS days_since_baixa_prem
  FROM (SELECT * FROM spine WHERE company IN (SELECT company FROM cohort)) s
  LEFT JOIN hist h ON h.party = s.xin_value AND h.m = s.m
  LEFT JOIN win w ON w.party = s.xin_value AND w.m = s.m
  LEFT JOIN chan cs ON cs.party = s.xin_value AND cs.m = s.m AND cs.role = 'sent'
  LEFT JOIN chan cr ON cr.party = s.xin_value AND cr.m = s.m AND cr.role = 'rec'
  {'LEFT JOIN mstats ms ON ms.party = s.xin_value AND ms.m = s.m' if trailing else ''}
  LEFT JOIN master ma ON ma.company = s.company LEFT JOIN churn c ON c.company = s.company)""",
    ]


OVER = "OVER (PARTITION BY company ORDER BY timestamp_ym, xin_value ROWS UNBOUNDED PRECEDING)"


def accumulated_cte(trailing: bool = False) -> str:
    flags = ", ".join(
        f"((channel_sent = '{g}')::BIGINT + (channel_rec = '{g}')::BIGINT) AS {f}"
        for f, g in specs.CHANNEL_FLAGS.items()
    )
    medians = {**running.MEDIANS, **(running.TRAILING_MEDIANS if trailing else {})}
    maxes = running.TRAILING_MAXES if trailing else running.MAXES
    sums = {} if trailing else dict(running.SUMS)
    sums.update({f"{f}_acum": f for f in specs.CHANNEL_FLAGS})
    cols = [f"round(median({c}) {OVER}, 6) AS {out}" for out, c in medians.items()]
    cols += [
        f"round(sum({c}) {OVER}, 2) AS {out}" if "import" in c
        else f"(sum({c}) {OVER})::BIGINT AS {out}"
        for out, c in sums.items()
    ]
    cols += [f"max({c}) {OVER} AS {out}" for out, c in maxes.items()]
    return f"""
flagged AS (SELECT * EXCLUDE (channel_sent, channel_rec), {flags} FROM panel),
behaviour AS (SELECT *, {', '.join(cols)} FROM flagged)"""


SEGMENT_CTES = f"""
last_rows AS (
  SELECT * FROM behaviour WHERE company NOT IN (SELECT company FROM churn_basic)
  QUALIFY row_number() OVER (PARTITION BY company ORDER BY timestamp_ym DESC, xin_value DESC NULLS LAST) = 1),
staying AS (
  SELECT l.*, m.alta_basic, m.alta_premium, m.country, m.company_name, m.days_until_premium, m.days_until_invoice,
    greatest(b2g_acum, mail_acum, downloads_acum, other_acum, peppol_acum, b2brouter_acum) AS top
  FROM last_rows l LEFT JOIN master m USING (company)
  WHERE l.company NOT IN (SELECT company FROM churn) OR days_from_last_transaction < days_since_baixa_prem),
inputs AS (
  SELECT s.company, med_import_sent_t AS import, days_since_alta_basic,
    days_from_last_transaction AS days_until_last_transaction, s.company_name, s.country, alta_basic, alta_premium,
    med_trans_sent AS num_transactions, sum_trans_sent AS sum_transactions, num_receivers AS receivers,
    num_senders AS senders, days_since_baixa_prem, days_until_premium, days_until_invoice,
    CASE WHEN top = 0 THEN 'no channel' WHEN b2g_acum = top THEN 'b2g_acum' WHEN mail_acum = top THEN 'mail_acum'
      WHEN downloads_acum = top THEN 'downloads_acum' WHEN other_acum = top THEN 'other_acum'
      WHEN peppol_acum = top THEN 'peppol_acum' ELSE 'b2brouter_acum' END AS channel,
    coalesce(r.plan, 'basic') AS plan, r.postal_code, coalesce(r.plan, 'basic') <> 'basic' AS prem
  FROM staying s JOIN reg_new r ON r.company_id = s.company
  WHERE coalesce(r.plan, 'basic') IN ('basic', 'professional', 'business')),
scored AS (
  SELECT *,
    CASE WHEN d <= 30 THEN 4 WHEN d <= 95 THEN 3 WHEN d <= 365 THEN 2 WHEN d > 365 THEN 1 END AS r,
    CASE WHEN num_transactions = 0 THEN 1 WHEN num_transactions > 0 AND num_transactions <= 1 THEN 2
      WHEN num_transactions > 1 AND num_transactions <= CASE WHEN prem THEN 4 ELSE 2 END THEN 3
      WHEN num_transactions > CASE WHEN prem THEN 4 ELSE 2 END THEN 4 END AS f,
    CASE WHEN import <= 45000 THEN 1 WHEN import <= 50000 THEN 2 WHEN import <= 55000 THEN 3
      WHEN import > 55000 THEN 4 END AS m
  FROM (SELECT *, coalesce(days_until_last_transaction, days_since_alta_basic) AS d FROM inputs)),
segmented AS (
  SELECT *, coalesce(CASE
    WHEN days_until_last_transaction < days_since_baixa_prem THEN 'Downgrades'
    WHEN r >= 3 AND sum_transactions = 0 THEN 'Recent clients'
    WHEN NOT prem AND r = 1 AND sum_transactions > 0 THEN 'Lost'
    WHEN NOT prem AND r < 3 AND sum_transactions = 0 THEN 'Inactive'
    WHEN prem AND r <= 2 THEN 'Almost lost'
    WHEN receivers = 1 THEN 'Low engagement'
    WHEN NOT prem AND r >= 2 AND f >= 3 THEN 'Normal'
    WHEN NOT prem AND r >= 3 AND f = 2 AND m <> 4 THEN 'Normal'
    WHEN NOT prem AND r >= 3 AND f >= 2 AND m = 4 THEN 'Bullies'
    WHEN NOT prem AND ((r = 2 AND f = 2) OR (r >= 2 AND f = 1)) THEN 'Sporadic'
    WHEN prem AND r >= 3 AND f >= 2 AND m = 4 THEN 'Big companies'
    WHEN prem AND r >= 3 AND f >= 3 AND m < 4 THEN 'Loyals'
    WHEN prem AND r >= 3 AND f = 2 AND m < 4 THEN 'Normal'
    WHEN prem AND r >= 3 AND f = 1 THEN 'Sporadic' END, '') AS segment FROM scored),
finished AS (
  SELECT company, import, days_since_alta_basic, d AS days_until_last_transaction, company_name, country,
    alta_basic AS data_alta_basic,
    CASE WHEN prem THEN coalesce(alta_premium, TIMESTAMP '1900-12-02 10:59:33') END AS subscription_date,
    num_transactions, sum_transactions, receivers, senders,
    CASE WHEN prem THEN days_until_premium ELSE coalesce(days_until_premium, days_since_alta_basic) END AS days_until_premium,
    coalesce(days_until_invoice, days_since_alta_basic) AS days_until_invoice, channel, plan, postal_code,
    r, f, m, company AS company_id, segment
  FROM segmented)"""

SEGMENT_OUT = f"""
SELECT company, import, days_since_alta_basic, days_until_last_transaction, company_name, country,
  {stamp('data_alta_basic')} AS data_alta_basic, {stamp('subscription_date')} AS subscription_date,
  num_transactions, sum_transactions, receivers, senders, days_until_premium, days_until_invoice, channel, plan,
  postal_code, r::BIGINT AS r, f::BIGINT AS f, m::BIGINT AS m, company_id, segment
FROM finished WHERE import IS NOT NULL AND days_since_alta_basic IS NOT NULL AND days_until_last_transaction IS NOT NULL
  AND company_name IS NOT NULL AND country IS NOT NULL AND data_alta_basic IS NOT NULL
  AND days_until_premium IS NOT NULL AND days_until_invoice IS NOT NULL AND postal_code IS NOT NULL"""


def panel_sql(grain: str = "month", trailing: bool = False) -> str:
    return with_(*panel_ctes(grain, trailing))


def behaviour_sql(grain: str = "month", trailing: bool = False) -> str:
    return with_(*panel_ctes(grain, trailing), accumulated_cte(trailing))


def segment_sql(grain: str = "month") -> str:
    return with_(*panel_ctes(grain), accumulated_cte(), SEGMENT_CTES)


MISSING = (
    "days_from_last_transaction", "days_from_last_transaction_rec", "days_since_alta_basic",
    "days_since_alta_premium", "days_since_baixa_prem",
)


# -- shared builders --------------------------------------------------------------------

def build(spark, sf_dir, spec=specs.RFM_SNAPSHOTS):
    return features.build_tables(C.prepared(spark, sf_dir), spec)


def raw_panel(spark, sf_dir, spec, p=None, gathered=False):
    p = p or C.prepared(spark, sf_dir)
    companies = lifecycle.company_master(p.events, p.registry)
    churn = lifecycle.churn_premium(p.events)
    return panel.feature_panel(p.tx, p.events, p.ids, companies, churn, spec, gathered=gathered).drop("snapshot")


# -- panel ---------------------------------------------------------------------------------

@query("snapshot_date", """
SELECT strftime(l_shipdate, '%Y%m') AS timestamp_ym, strftime(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS snapshot,
  count(*) AS n FROM lineitem GROUP BY ALL""")
def snapshot_date(spark, sf_dir):
    months = B.table(spark, sf_dir, "lineitem").groupBy(S.year_month("l_shipdate").alias("timestamp_ym"))
    return months.agg(F.count("*").alias("n")).select(
        "timestamp_ym", S.snapshot_date("timestamp_ym").alias("snapshot"), "n"
    )


@query("asof_lifecycle", with_(B.TX, B.EVENTS) + f"""
SELECT company, m AS snapshot, arg_max(plan, {C.EV_ORDER})::BIGINT AS actual_plan
FROM ev_all JOIN (SELECT DISTINCT p AS m FROM tx) ON p <= m GROUP BY ALL""")
def asof_lifecycle(spark, sf_dir):
    tx = panel.with_period(C.transactions(spark, sf_dir), specs.RFM_SNAPSHOTS)
    snapshots = panel.snapshot_list(tx)
    return lifecycle.plan_asof(C.events(spark, sf_dir), snapshots)


def trailing_totals(tx, spec):
    """Number and amount of each party's transactions in each window, from its sums per period:
    one row for each period is spread over the windows, not each transaction."""
    tx = panel.with_period(tx, spec)
    sides = F.explode(F.array("sender_xin_value", "receiver_xin_value")).alias("xin_value")
    each = tx.select("period", sides, party.amount().alias("a")).groupBy("xin_value", "period").agg(
        F.count("*").alias("n"), F.sum("a").alias("amount")
    )
    # A party has one row for each period here, so its rows may meet in one task.
    spread = panel.into_windows(each.repartition("xin_value"), panel.snapshot_list(tx), spec)
    return spread.groupBy("snapshot", "xin_value").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))


@query("trailing_window_join", C.ROLES + """
SELECT m AS snapshot, party AS xin_value, count(*) AS n, sum(cents) / 100.0 AS amount
FROM roles JOIN (SELECT DISTINCT p AS m FROM tx) ON p <= m AND p > m - 3 GROUP BY ALL""")
def trailing_window_join(spark, sf_dir):
    return trailing_totals(C.transactions(spark, sf_dir), TRAILING)


@query("trailing_window_yyyymm", C.ROLES + """
SELECT m AS snapshot, party AS xin_value, count(*) AS n, sum(cents) / 100.0 AS amount
FROM roles JOIN (SELECT DISTINCT p AS m FROM tx) ON p <= m
  AND (p // 12) * 100 + p % 12 + 1 > (m // 12) * 100 + m % 12 + 1 - 3 GROUP BY ALL""")
def trailing_window_yyyymm(spark, sf_dir):
    """The literal window, which never reaches back over a year end."""
    spec = specs.SnapshotSpec(window="trailing", yyyymm_arithmetic=True)
    return trailing_totals(C.transactions(spark, sf_dir), spec)


@query("days_since_milestones", panel_sql() + """
SELECT DISTINCT company, timestamp_ym, days_since_alta_basic, days_since_alta_premium, days_since_baixa_prem FROM panel""",
    ("days_since_alta_basic", "days_since_alta_premium", "days_since_baixa_prem"))
def days_since_milestones(spark, sf_dir):
    p = C.prepared(spark, sf_dir)
    tx = panel.with_period(p.tx, specs.RFM_SNAPSHOTS)
    rows = lifecycle.plan_asof(p.events, panel.snapshot_list(tx))
    out = panel.days_since_milestones(
        rows, lifecycle.company_master(p.events, p.registry), lifecycle.churn_premium(p.events),
        S.period_end("snapshot"),
    )
    return out.withColumn("timestamp_ym", S.period_label("snapshot")).drop("snapshot", "actual_plan")


@query("feature_panel", panel_sql() + "SELECT * FROM panel", MISSING)
def feature_panel(spark, sf_dir):
    return raw_panel(spark, sf_dir, specs.RFM_SNAPSHOTS)


@query("feature_panel_trailing", panel_sql(trailing=True) + "SELECT * FROM panel", MISSING)
def feature_panel_trailing(spark, sf_dir):
    return raw_panel(spark, sf_dir, TRAILING)


# -- accumulations ---------------------------------------------------------------------------

MONTHLY = C.ROLES + """,
monthly AS (
  SELECT sender AS company, ym AS timestamp_ym, count(*) AS n, max(cents) AS top, sum(cents)::BIGINT AS total
  FROM tx GROUP BY ALL)
"""
SIMPLE_OVER = "OVER (PARTITION BY company ORDER BY timestamp_ym ROWS UNBOUNDED PRECEDING)"


def monthly_totals(spark, sf_dir):
    tx = C.transactions(spark, sf_dir)
    return tx.groupBy(F.col("sender_xin_value").alias("company"), "timestamp_ym").agg(
        F.count("*").alias("n"), F.max(party.cents()).alias("top"), F.sum(party.cents()).alias("total")
    )


@query("expanding_median", MONTHLY + f"""
SELECT company, timestamp_ym, median(n) {SIMPLE_OVER} AS med_n, median(total) {SIMPLE_OVER} AS med_total FROM monthly""")
def expanding_median(spark, sf_dir):
    medians = {"med_n": "n", "med_total": "total"}
    rows = running.accumulated(monthly_totals(spark, sf_dir), ("timestamp_ym",), medians, {}, {})
    return rows.select("company", "timestamp_ym", *medians)


@query("running_sums", MONTHLY + f"""
SELECT company, timestamp_ym, (sum(n) {SIMPLE_OVER})::BIGINT AS sum_n, (sum(total) {SIMPLE_OVER})::BIGINT AS sum_total FROM monthly""")
def running_sums(spark, sf_dir):
    sums = {"sum_n": "n", "sum_total": "total"}
    rows = running.accumulated(monthly_totals(spark, sf_dir), ("timestamp_ym",), {}, sums, {})
    return rows.select("company", "timestamp_ym", *sums)


@query("running_maxes", MONTHLY + f"""
SELECT company, timestamp_ym, max(n) {SIMPLE_OVER} AS max_n, max(top) {SIMPLE_OVER} AS max_top FROM monthly""")
def running_maxes(spark, sf_dir):
    maxes = {"max_n": "n", "max_top": "top"}
    rows = running.accumulated(monthly_totals(spark, sf_dir), ("timestamp_ym",), {}, {}, maxes)
    return rows.select("company", "timestamp_ym", *maxes)


@query("channel_onehot", panel_sql() + """
SELECT company, xin_value, timestamp_ym, """ + ", ".join(
    f"((channel_sent = '{g}')::BIGINT + (channel_rec = '{g}')::BIGINT) AS {f}"
    for f, g in specs.CHANNEL_FLAGS.items()) + " FROM panel")
def channel_onehot(spark, sf_dir):
    p = C.prepared(spark, sf_dir)
    tx = panel.with_period(p.tx, specs.RFM_SNAPSHOTS)
    snapshots = panel.snapshot_list(tx)
    rows = panel.spine(p.events, p.ids, snapshots, specs.RFM_SNAPSHOTS)
    channels = panel.window_channels(tx, snapshots, specs.RFM_SNAPSHOTS)
    joined = rows.join(channels, ["xin_value", "snapshot"], "left").withColumn(
        "timestamp_ym", S.period_label("snapshot")
    )
    return running.channel_onehot(joined).drop("snapshot", "actual_plan")


def accumulated_panel(spark, sf_dir, spec):
    p = C.prepared(spark, sf_dir)
    rows = raw_panel(spark, sf_dir, spec, p, gathered=True)
    return running.panel_accumulate(rows, spec, ids=p.ids, snapshots=panel.snapshot_count(p.tx, spec))


@query("panel_accumulate", behaviour_sql() + "SELECT * FROM behaviour", MISSING)
def panel_accumulate(spark, sf_dir):
    return accumulated_panel(spark, sf_dir, specs.RFM_SNAPSHOTS)


@query("panel_accumulate_trailing", behaviour_sql(trailing=True) + "SELECT * FROM behaviour", MISSING)
def panel_accumulate_trailing(spark, sf_dir):
    return accumulated_panel(spark, sf_dir, TRAILING)


@query("last_row_per_company", MONTHLY + """
SELECT company, timestamp_ym, n FROM monthly
QUALIFY row_number() OVER (PARTITION BY company ORDER BY timestamp_ym DESC) = 1""")
def last_row_per_company(spark, sf_dir):
    rows = monthly_totals(spark, sf_dir).select("company", "timestamp_ym", "n")
    return running.last_row_per_company(rows, ("timestamp_ym",))


@query("label_last_snapshot", with_(B.EVENTS, *C.lifecycle_ctes("ev_all", "(SELECT 1 AS company_id, 'x' AS country, NULL AS date_first_client, NULL AS date_first_invoice, 1 AS number_clients, 'x' AS postal_code, 'x' AS company_name, 'x' AS xin_value)")[3:4]) + """,
months AS (SELECT e.company, strftime(ts, '%Y%m') AS timestamp_ym, 'X' || e.company AS xin_value
  FROM ev_all e JOIN churn c ON c.company = e.company WHERE e.ts < c.ended GROUP BY ALL)
SELECT company, timestamp_ym, xin_value,
  (row_number() OVER (PARTITION BY company ORDER BY timestamp_ym DESC) = 1)::BIGINT AS target FROM months""")
def label_last_snapshot(spark, sf_dir):
    ev = C.events(spark, sf_dir)
    ended = lifecycle.churn_premium(ev).select("company", "data_baixa_prem")
    rows = (
        ev.join(ended, "company")
        .filter(F.col("@timestamp") < F.col("data_baixa_prem"))
        .select("company", "timestamp_ym", F.concat(F.lit("X"), "company").alias("xin_value"))
        .distinct()
    )
    return labels.label_last_snapshot(rows)


@query("order_events", with_(B.EVENTS) + f"SELECT {stamp('ts')} AS event_ts, company, event_id, action FROM ev_all ORDER BY ts, event_id")
def order_events(spark, sf_dir):
    return C.events(spark, sf_dir).select(
        F.col("@timestamp").alias("event_ts"), "company", "event_id", "action"
    ).orderBy("event_ts", "event_id")


# -- segmentation ------------------------------------------------------------------------------

def segments(spark, sf_dir, spec):
    registry = C.newest_registry(spark, sf_dir)
    tables = features.build_latest_tables(C.prepared(spark, sf_dir), spec)
    return segment_customers(tables, registry, PREMIUM, BASIC)


def scored_input(spark, sf_dir, spec=specs.RFM_SNAPSHOTS):
    t = features.build_latest_tables(C.prepared(spark, sf_dir), spec)
    return segment.segment_input(
        t.behaviour, t.companies, t.churn, t.churn_basic, C.newest_registry(spark, sf_dir)
    )


@query("dominant_channel", segment_sql() + "SELECT company, channel FROM inputs")
def dominant_channel(spark, sf_dir):
    return scored_input(spark, sf_dir).select("company", "channel")


@query("rfm_scores", segment_sql() + """
SELECT company, plan, import, num_transactions, r::BIGINT AS r, f::BIGINT AS f, m::BIGINT AS m FROM scored""")
def rfm_scores(spark, sf_dir):
    return segment.rfm_scores(scored_input(spark, sf_dir), PREMIUM, BASIC).select(
        "company", "plan", "import", "num_transactions", "r", "f", "m"
    )


@query("segment_basic", segment_sql() + "SELECT company, segment FROM segmented WHERE NOT prem")
def segment_basic(spark, sf_dir):
    rows = segment.rfm_scores(scored_input(spark, sf_dir), PREMIUM, BASIC)
    return segment.assign_segments(rows.filter(~segment.is_premium())).select("company", "segment")


@query("segment_premium", segment_sql() + "SELECT company, segment FROM segmented WHERE prem")
def segment_premium(spark, sf_dir):
    rows = segment.rfm_scores(scored_input(spark, sf_dir), PREMIUM, BASIC)
    return segment.assign_segments(rows.filter(segment.is_premium())).select("company", "segment")


@query("segmentation", segment_sql() + SEGMENT_OUT)
def segmentation(spark, sf_dir):
    return segment.combined(*segments(spark, sf_dir, specs.RFM_SNAPSHOTS))


@query("segment_slice", segment_sql("quarter") + SEGMENT_OUT)
def segment_slice(spark, sf_dir):
    return segment.combined(*segments(spark, sf_dir, QUARTERS))


@query("sink_segments", segment_sql("quarter") + f""",
shown AS ({SEGMENT_OUT})
SELECT 'rfm_premium' AS name, segment, count(*) AS n FROM shown WHERE plan <> 'basic' GROUP BY ALL
UNION ALL SELECT 'rfm_basic', segment, count(*) FROM shown WHERE plan = 'basic' GROUP BY ALL
UNION ALL SELECT 'segmentation_model', segment, count(*) FROM shown GROUP BY ALL""")
def sink_segments(spark, sf_dir):
    """Writes the three segment tables and counts what is read back."""
    paths = sinks.write_segments(*segments(spark, sf_dir, QUARTERS), fresh_folder(spark))
    parts = [
        readers.read_table(spark, path).groupBy(F.lit(name).alias("name"), "segment").agg(F.count("*").alias("n"))
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- prepared tables -----------------------------------------------------------------------

@query("sink_tables", behaviour_sql("quarter") + """
SELECT 'companies' AS name, count(*) AS n, sum(company)::BIGINT AS keys, 0::BIGINT AS sent FROM master
UNION ALL SELECT 'churn', count(*), sum(company)::BIGINT, 0 FROM churn
UNION ALL SELECT 'churn_basic', count(*), sum(company)::BIGINT, 0 FROM churn_basic
UNION ALL SELECT 'behaviour', count(*), sum(company)::BIGINT, sum(sum_trans_sent)::BIGINT FROM behaviour
UNION ALL SELECT 'party_ids', count(*), sum(company_id)::BIGINT, 0 FROM ids""")
def sink_tables(spark, sf_dir):
    """Writes the prepared tables, the panel partitioned by month, and sums up
    what is read back."""
    paths = sinks.write_prepared(build(spark, sf_dir, QUARTERS).as_dict(), fresh_folder(spark))

    def summed(name, path):
        df = readers.read_table(spark, path)
        company = F.col("company_id" if name == "party_ids" else "company")
        sent = F.sum("sum_trans_sent") if name == "behaviour" else F.lit(0)
        return df.agg(
            F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(company).cast("bigint").alias("keys"),
            sent.cast("bigint").alias("sent"),
        )

    return reduce(DataFrame.unionByName, [summed(name, path) for name, path in paths.items()])


LIMITED = specs.SnapshotSpec(
    window="trailing", lifecycle_from="199601", lifecycle_before="199901", transactions_before="199807",
    registry_before="2001-01-01",
)


@query("date_limited_inputs", with_(B.TX, B.EVENTS, B.REGISTRY) + """,
started AS (SELECT *, strftime(ts, '%Y%m') AS month FROM ev_all WHERE strftime(ts, '%Y%m') >= '199601'),
cohort AS (SELECT DISTINCT company FROM started WHERE action = 'alta' AND plan_name = 'basic')
SELECT 'events' AS name, count(*) AS n, sum(event_id)::BIGINT AS keys FROM started
WHERE month < '199901' AND company IN (SELECT company FROM cohort)
UNION ALL SELECT 'transactions', count(*), sum(cents)::BIGINT FROM tx
WHERE ym < '199807' AND company_id IN (SELECT company FROM cohort)
UNION ALL SELECT 'registry', count(*), coalesce(sum(company_id), 0)::BIGINT FROM reg_new
WHERE date_last_updated < TIMESTAMP '2001-01-01' AND company_id IN (SELECT company FROM cohort)""")
def date_limited_inputs(spark, sf_dir):
    """The inputs of the product that all four date bounds limit."""
    p = features.prepare(B.raw(spark, sf_dir), LIMITED, tie="version")
    line = lambda name, df, key: df.agg(
        F.lit(name).alias("name"), F.count("*").alias("n"), F.coalesce(F.sum(key).cast("bigint"), F.lit(0)).alias("keys")
    )
    return line("events", p.events, "event_id").unionByName(
        line("transactions", p.tx, party.cents())
    ).unionByName(line("registry", p.registry, "company_id"))


def limited_panel_ctes() -> list[str]:
    """The trailing panel's, over inputs that all four date bounds limit."""
    started = f"""
ev_from AS (SELECT * FROM ev_all WHERE strftime(ts, '%Y%m') >= '{LIMITED.lifecycle_from}')"""
    bounds = {
        "ev_all WHERE action": "ev_from WHERE action",
        "ev_all WHERE company": f"ev_from WHERE strftime(ts, '%Y%m') < '{LIMITED.lifecycle_before}' AND company",
        "tx WHERE": f"tx WHERE ym < '{LIMITED.transactions_before}' AND",
        "reg_new WHERE": f"reg_new WHERE date_last_updated < TIMESTAMP '{LIMITED.registry_before}' AND",
    }
    prepared = reduce(lambda sql, x: sql.replace(f"FROM {x[0]}", f"FROM {x[1]}"), bounds.items(), B.PREPARED)
    return [prepared if part is B.PREPARED else part for part in panel_ctes(trailing=True)[:3] + [started] + panel_ctes(trailing=True)[3:]]


@query("date_limited_panel", with_(*limited_panel_ctes()) + "SELECT * FROM panel", MISSING)
def date_limited_panel(spark, sf_dir):
    """The panel of the product that all four date bounds limit."""
    return raw_panel(spark, sf_dir, LIMITED, features.prepare(B.raw(spark, sf_dir), LIMITED, tie="version"))
