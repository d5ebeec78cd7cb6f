"""Queries: lifecycle tables, joins, set operations, party features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry.catalog import bindings as B
from cohortry.catalog.bindings import day_diff, roles, stamp, with_
from cohortry.catalog.registry import query
from cohortry.functions import scalars as S
from cohortry.functions.scale import fresh_folder
from cohortry.operators import cleaning, identity, lifecycle, party, segment
from cohortry.plans import features
from cohortry.sources import readers, schemas, sinks

EV_ORDER = "epoch(ts)::BIGINT * 10000000 + event_id"


def events(spark, sf_dir):
    """Scanned lifecycle events with ordinal plans."""
    scanned = readers.scan_lifecycle(B.lifecycle(spark, sf_dir))
    return scanned.withColumn("plan", S.plan_ordinal("plan"))


def newest_registry(spark, sf_dir):
    return cleaning.latest_version(
        readers.scan_registry(B.registry(spark, sf_dir), extra=["version"]), "version"
    )


def transactions(spark, sf_dir):
    """Transactions with ordinal plans, channel groups and months."""
    return (
        readers.scan_transactions(B.transactions(spark, sf_dir))
        .withColumn("company_plan", S.plan_ordinal("company_plan"))
        .withColumn("channel_original", F.col("channel"))
        .withColumn("channel", S.channel_group("channel"))
        .withColumn("international", F.col("international").cast("int"))
    )


def prepared(spark, sf_dir):
    return features.prepare(B.raw(spark, sf_dir), tie="version")


# -- lifecycle tables ----------------------------------------------------------------

FIRST_SIGNUP = """
first_signup AS (
  SELECT company, min(ts) FILTER (action = 'alta') AS alta_basic,
    min(ts) FILTER (plan IN (1, 2) AND action IN ('alta', 'upgrade')) AS alta_premium
  FROM {ev} WHERE action = 'alta' OR (plan IN (1, 2) AND action = 'upgrade') GROUP BY company)"""

ACTIVE = f"""
active AS (
  SELECT company FROM (
    SELECT company, arg_max(action, {EV_ORDER}) AS action, arg_max(plan, {EV_ORDER}) AS plan,
      arg_max(payment_type, {EV_ORDER}) AS payment_type FROM {{ev}} GROUP BY company)
  WHERE action IN ('alta', 'upgrade', 'renovacio', 'reactivacio') AND plan IN (1, 2)
    AND payment_type IS DISTINCT FROM 'FreeDemo')"""

MASTER = f"""
master AS (
  SELECT s.company, alta_basic, alta_premium, r.country, r.date_first_client, r.date_first_invoice,
    r.number_clients, r.postal_code, r.company_name, r.xin_value,
    {day_diff('alta_premium', 'alta_basic')} AS days_until_premium,
    {day_diff('r.date_first_invoice', 'alta_basic')} AS days_until_invoice,
    {day_diff('r.date_first_client', 'alta_basic')} AS days_until_client,
    CASE WHEN s.company IN (SELECT company FROM active) THEN 1 END::BIGINT AS active_prem
  FROM first_signup s LEFT JOIN {{reg}} r ON r.company_id = s.company)"""

CHURN = f"""
churn AS (
  SELECT c.company, c.ended, c.churn_plan, {day_diff('c.ended', 'a.alta')} AS days_active_prem
  FROM (SELECT company, max(ts) AS ended, arg_max(action, {EV_ORDER}) AS action,
          arg_max(plan, {EV_ORDER})::BIGINT AS churn_plan
        FROM {{ev}} WHERE payment_type IS DISTINCT FROM 'FreeDemo' AND plan IN (1, 2) GROUP BY company) c
  LEFT JOIN (SELECT company, min(ts) AS alta FROM {{ev}} WHERE action = 'alta' AND plan IN (1, 2)
             GROUP BY company) a ON a.company = c.company
  WHERE c.action IN ('baixa', 'downgrade', 'devolucio'))"""

CHURN_BASIC = f"""
churn_basic AS (
  SELECT company, ts, action FROM (
    SELECT company, max(ts) AS ts, arg_max(action, {EV_ORDER}) AS action FROM {{ev}} WHERE plan = 0 GROUP BY company)
  WHERE action = 'baixa')"""


def lifecycle_ctes(ev: str, reg: str) -> list[str]:
    return [
        FIRST_SIGNUP.format(ev=ev), ACTIVE.format(ev=ev), MASTER.format(reg=reg),
        CHURN.format(ev=ev), CHURN_BASIC.format(ev=ev),
    ]


LIFE = with_(B.EVENTS, B.REGISTRY, *lifecycle_ctes("ev_all", "reg_new"))

MASTER_COLUMNS = f"""company, {stamp('alta_basic')} AS data_alta_basic, {stamp('alta_premium')} AS data_alta_premium,
  country, {stamp('date_first_client')} AS date_first_client, {stamp('date_first_invoice')} AS date_first_invoice,
  number_clients, postal_code, company_name, xin_value, days_until_premium, days_until_invoice,
  days_until_client, active_prem"""


@query("first_signup", LIFE + f"""
SELECT company, {stamp('alta_basic')} AS data_alta_basic, {stamp('alta_premium')} AS data_alta_premium FROM first_signup""")
def first_signup(spark, sf_dir):
    return lifecycle.first_signup(events(spark, sf_dir))


@query("company_master", LIFE + f"SELECT {MASTER_COLUMNS} FROM master",
    ('number_clients', 'days_until_premium', 'days_until_invoice', 'days_until_client', 'active_prem'))
def company_master(spark, sf_dir):
    return lifecycle.company_master(events(spark, sf_dir), newest_registry(spark, sf_dir))


@query("churn_premium", LIFE + f"""
SELECT company, {stamp('ended')} AS data_baixa_prem, days_active_prem, churn_plan, 1::BIGINT AS churn FROM churn""",
    ('days_active_prem',))
def churn_premium(spark, sf_dir):
    return lifecycle.churn_premium(events(spark, sf_dir))


@query("churn_basic", LIFE + f"SELECT company, {stamp('ts')} AS ended, action, 0::BIGINT AS plan FROM churn_basic")
def churn_basic(spark, sf_dir):
    return lifecycle.churn_basic(events(spark, sf_dir)).withColumnRenamed("@timestamp", "ended")


@query("active_premium", LIFE + "SELECT company, 1::BIGINT AS active_prem FROM active")
def active_premium(spark, sf_dir):
    return lifecycle.active_premium(events(spark, sf_dir))


@query("last_plan", LIFE + f"""
SELECT company, arg_max(plan, {EV_ORDER})::BIGINT AS actual_plan FROM ev_all GROUP BY 1""")
def last_plan(spark, sf_dir):
    return lifecycle.last_plan(events(spark, sf_dir))


@query("last_state", LIFE + f"""
SELECT company, arg_max(action, {EV_ORDER}) AS action, arg_max(plan, {EV_ORDER})::BIGINT AS plan FROM ev_all GROUP BY 1""")
def last_state(spark, sf_dir):
    return lifecycle.last_state(events(spark, sf_dir))


# -- joins -----------------------------------------------------------------------------

@query("outer_align", with_(B.TX) + """
SELECT coalesce(s.party, r.party) AS xin_value, s.n AS n_sent, r.n AS n_received
FROM (SELECT sender AS party, count(*) AS n FROM tx WHERE is_sent GROUP BY 1) s
FULL JOIN (SELECT receiver AS party, count(*) AS n FROM tx WHERE is_rec GROUP BY 1) r ON s.party = r.party""",
    ('n_sent', 'n_received'))
def outer_align(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    counted = lambda rows, key, name: rows.groupBy(F.col(key).alias("xin_value")).agg(
        F.count("*").alias(name)
    )
    sent = counted(tx.filter(S.is_sent()), "sender_xin_value", "n_sent")
    received = counted(tx.filter(S.is_received()), "receiver_xin_value", "n_received")
    return sent.join(received, "xin_value", "full")


@query("left_enrich", LIFE + f"""
SELECT c.company, c.days_active_prem, m.country, m.days_until_premium, r.plan, r.postal_code
FROM churn c LEFT JOIN master m USING (company) LEFT JOIN reg_new r ON r.company_id = c.company""",
    ('days_active_prem', 'days_until_premium'))
def left_enrich(spark, sf_dir):
    ev, registry = events(spark, sf_dir), newest_registry(spark, sf_dir)
    churn = lifecycle.churn_premium(ev).select("company", "days_active_prem")
    master = lifecycle.company_master(ev, registry).select("company", "country", "days_until_premium")
    plans = registry.select(F.col("company_id").alias("company"), "plan", "postal_code")
    return churn.join(master, "company", "left").join(plans, "company", "left")


@query("semi_members", LIFE + f"""
SELECT company, event_id, action FROM ev_all WHERE company IN (SELECT company FROM active)""")
def semi_members(spark, sf_dir):
    ev = events(spark, sf_dir)
    return cleaning.members(ev, lifecycle.active_premium(ev), "company").select(
        "company", "event_id", "action"
    )


@query("anti_members", LIFE + """
SELECT company_id, xin_value, plan FROM reg_new
WHERE xin_value IS NULL OR NOT EXISTS (SELECT 1 FROM supplier WHERE 'X' || s_suppkey = xin_value)""")
def anti_members(spark, sf_dir):
    suppliers = B.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("X"), "s_suppkey").alias("xin_value")
    )
    rows = newest_registry(spark, sf_dir).select("company_id", "xin_value", "plan")
    return cleaning.non_members(rows, suppliers, "xin_value").select("company_id", "xin_value", "plan")


@query("conditional_membership", LIFE + """,
lasts AS (SELECT company, max(ts) AS last_ts FROM ev_all GROUP BY company)
SELECT l.company, date_diff('day', last_ts, TIMESTAMP '2001-12-01')::BIGINT AS days_from_last_transaction,
  date_diff('day', ended, TIMESTAMP '2001-12-01')::BIGINT AS days_since_baixa_prem
FROM lasts l LEFT JOIN churn c USING (company)
WHERE c.company IS NULL OR date_diff('day', last_ts, TIMESTAMP '2001-12-01') < date_diff('day', ended, TIMESTAMP '2001-12-01')""",
    ('days_since_baixa_prem',))
def conditional_membership(spark, sf_dir):
    ev = events(spark, sf_dir)
    churn = lifecycle.churn_premium(ev)
    at = F.lit("2001-12-01").cast("date")
    lasts = ev.groupBy("company").agg(F.max("@timestamp").alias("last_ts"))
    rows = lasts.join(churn.select("company", "data_baixa_prem"), "company", "left").select(
        "company", S.calendar_days(at, "last_ts").alias("days_from_last_transaction"),
        S.calendar_days(at, "data_baixa_prem").alias("days_since_baixa_prem"),
    )
    return segment.still_customers(rows, churn)


IDENTITY = with_(B.TX, B.EVENTS, B.REGISTRY, B.PREPARED)


@query("resolve_party_ids", IDENTITY + "SELECT company_id, xin_value FROM ids")
def resolve_party_ids(spark, sf_dir):
    return prepared(spark, sf_dir).ids


@query("id_set", IDENTITY + "SELECT DISTINCT xin_value, company_id FROM claims")
def id_set(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return identity.id_set(identity.unregistered(p.tx, p.registry))


@query("max_company_per_id", IDENTITY + "SELECT xin_value, max(company_id) AS company_id FROM claims GROUP BY 1")
def max_company_per_id(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return identity.max_company_per_id(identity.unregistered(p.tx, p.registry))


# -- set operations ------------------------------------------------------------------------

@query("union_by_name", LIFE + """
SELECT company, days_active_prem, NULL AS action FROM churn
UNION ALL SELECT company, NULL, action FROM churn_basic""",
    ('days_active_prem',))
def union_by_name(spark, sf_dir):
    ev = events(spark, sf_dir)
    premium = lifecycle.churn_premium(ev).select("company", "days_active_prem")
    basic = lifecycle.churn_basic(ev).select("company", "action")
    return premium.unionByName(basic, allowMissingColumns=True)


@query("key_union_distinct", LIFE + "SELECT company FROM churn UNION SELECT company FROM active")
def key_union_distinct(spark, sf_dir):
    ev = events(spark, sf_dir)
    ended, active = lifecycle.churn_premium(ev), lifecycle.active_premium(ev)
    return ended.select("company").union(active.select("company")).distinct()


@query("key_difference", LIFE + "SELECT company FROM master EXCEPT SELECT company FROM churn")
def key_difference(spark, sf_dir):
    ev = events(spark, sf_dir)
    everyone = lifecycle.first_signup(ev).select("company")
    return cleaning.non_members(everyone, lifecycle.churn_premium(ev), "company").distinct()


# -- party features ---------------------------------------------------------------------------

ROLES = with_(B.TX, roles())
TX_ORDER = "strftime(ts, '%Y%m%d') || id"


@query("tx_by_plan", ROLES + """
SELECT party AS xin_value, count(*) FILTER (plan = 0) AS plan_0, count(*) FILTER (plan = 1) AS plan_1,
  count(*) FILTER (plan = 2) AS plan_2 FROM roles GROUP BY 1""")
def tx_by_plan(spark, sf_dir):
    return party.tx_by_plan(transactions(spark, sf_dir))


@query("last_tx_plan", ROLES + f"""
SELECT party AS xin_value,
  coalesce(arg_max(plan, {TX_ORDER}) FILTER (role = 'sent'), -1)::BIGINT AS last_trans_plan,
  (arg_max(plan, {TX_ORDER}) FILTER (role = 'rec'))::BIGINT AS last_trans_plan_rec FROM roles GROUP BY 1""",
    ('last_trans_plan_rec',))
def last_tx_plan(spark, sf_dir):
    return party.last_tx_plan(transactions(spark, sf_dir))


PARTNERS = """count(DISTINCT partner) FILTER (role = 'sent' AND is_sent)
    + count(DISTINCT partner) FILTER (role = 'sent' AND is_rec) AS num_receivers,
  count(DISTINCT partner) FILTER (role = 'rec' AND is_sent)
    + count(DISTINCT partner) FILTER (role = 'rec' AND is_rec) AS num_senders"""


@query("distinct_counterparties", ROLES + f"""
SELECT party AS xin_value, {PARTNERS} FROM roles WHERE is_sent OR is_rec GROUP BY 1
HAVING bool_or((role = 'sent' AND is_sent) OR (role = 'rec' AND is_rec))""")
def distinct_counterparties(spark, sf_dir):
    return party.distinct_counterparties(transactions(spark, sf_dir))


@query("distinct_counterparties_senders", ROLES + f"""
SELECT party AS xin_value, {PARTNERS} FROM roles WHERE is_sent OR is_rec GROUP BY 1
HAVING bool_or(role = 'sent' AND is_sent)""")
def distinct_counterparties_senders(spark, sf_dir):
    return party.distinct_counterparties(transactions(spark, sf_dir), senders_only=True)


@query("success_counts", ROLES + """
SELECT party AS xin_value, count(*) FILTER (ok) AS success_true, count(*) FILTER (failed) AS success_false
FROM roles GROUP BY 1""")
def success_counts(spark, sf_dir):
    return party.tx_success(transactions(spark, sf_dir))


@query("international_counts", ROLES + """
SELECT party AS xin_value, count(*) FILTER (role = 'sent' AND international) AS international_sent,
  count(*) FILTER (role = 'rec' AND international) AS international_rec FROM roles GROUP BY 1""")
def international_counts(spark, sf_dir):
    return party.international(transactions(spark, sf_dir))


@query("modal_channel", ROLES + """,
counted AS (SELECT party, role, channel, count(*) AS n FROM roles WHERE channel IS NOT NULL GROUP BY ALL),
ranked AS (SELECT * FROM counted
  QUALIFY row_number() OVER (PARTITION BY party, role ORDER BY n DESC, channel) = 1)
SELECT p.party AS xin_value, s.channel AS channel_sent, r.channel AS channel_rec
FROM (SELECT DISTINCT party FROM roles) p LEFT JOIN ranked s ON s.party = p.party AND s.role = 'sent'
LEFT JOIN ranked r ON r.party = p.party AND r.role = 'rec'""")
def modal_channel(spark, sf_dir):
    return party.modal_channel(transactions(spark, sf_dir))


@query("tx_counts", ROLES + """
SELECT party AS xin_value, count(*) FILTER (role = 'sent') AS trans_sum_sent,
  count(*) FILTER (role = 'rec') AS trans_sum_received FROM roles GROUP BY 1""")
def tx_counts(spark, sf_dir):
    return party.frequency(transactions(spark, sf_dir))


@query("monthly_count_stats", ROLES + """,
n AS (SELECT party, role, ym, count(*) AS n FROM roles GROUP BY ALL)
SELECT party AS xin_value, coalesce(median(n) FILTER (role = 'sent'), 0) AS trans_med_sent,
  coalesce(max(n) FILTER (role = 'sent'), 0) AS trans_max_sent,
  coalesce(median(n) FILTER (role = 'rec'), 0) AS trans_med_received,
  coalesce(max(n) FILTER (role = 'rec'), 0) AS trans_max_received FROM n GROUP BY 1""")
def monthly_count_stats(spark, sf_dir):
    return party.monthly_count_stats(transactions(spark, sf_dir))


AMOUNTS = """
  coalesce(median(cents) FILTER (role = 'sent') / 100, 0) AS import_med_sent,
  coalesce(median(cents) FILTER (role = 'rec') / 100, 0) AS import_med_rec,
  coalesce(max(cents) FILTER (role = 'sent') / 100.0, 0) AS import_max_sent,
  coalesce(max(cents) FILTER (role = 'rec') / 100.0, 0) AS import_max_rec,
  coalesce(sum(cents) FILTER (role = 'sent') / 100.0, 0) AS import_sum_sent,
  coalesce(sum(cents) FILTER (role = 'rec') / 100.0, 0) AS import_sum_rec"""


@query("amount_stats", ROLES + f"SELECT party AS xin_value, {AMOUNTS} FROM roles GROUP BY 1")
def amount_stats(spark, sf_dir):
    return party.amount_stats(transactions(spark, sf_dir))


@query("lifetime_median_amount", ROLES + """
SELECT party AS xin_value, median(cents) FILTER (role = 'sent') / 100 AS med_import_sent_t,
  median(cents) FILTER (role = 'rec') / 100 AS med_import_rec_t FROM roles GROUP BY 1""")
def lifetime_median_amount(spark, sf_dir):
    return party.lifetime_median_amount(transactions(spark, sf_dir))


@query("recency_days", ROLES + """
SELECT party AS xin_value,
  date_diff('day', max(ts) FILTER (role = 'sent'), TIMESTAMP '2001-12-01')::BIGINT AS days_from_last_transaction,
  date_diff('day', max(ts) FILTER (role = 'rec'), TIMESTAMP '2001-12-01')::BIGINT AS days_from_last_transaction_rec
FROM roles GROUP BY 1""",
    ('days_from_last_transaction', 'days_from_last_transaction_rec'))
def recency_days(spark, sf_dir):
    return party.recency_days(transactions(spark, sf_dir), S.snapshot_date(F.lit("200111")))


# -- sinks and prepared tables -----------------------------------------------------------------

@query("scan_prepared", LIFE + f"SELECT {MASTER_COLUMNS} FROM master",
    ('number_clients', 'days_until_premium', 'days_until_invoice', 'days_until_client', 'active_prem'))
def scan_prepared(spark, sf_dir):
    """The company table written as CSV and read with its explicit schema."""
    companies = lifecycle.company_master(events(spark, sf_dir), newest_registry(spark, sf_dir))
    names = schemas.COMPANIES.names
    path = sinks.write_table(companies.select(*names), f"{fresh_folder(spark)}/companies", "csv")
    return readers.read_table(spark, path, schemas.COMPANIES, "csv")
