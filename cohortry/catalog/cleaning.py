"""Queries: sources, projections, filters, cleaning, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortry import specs
from cohortry.catalog import bindings as B
from cohortry.catalog.bindings import stamp, with_
from cohortry.catalog.registry import query
from cohortry.functions import aggregates as A
from cohortry.functions import scalars as S
from cohortry.operators import cleaning, stats
from cohortry.sources import readers, sinks

RAW_CODES = [code for codes in specs.CHANNEL_GROUPS.values() for code in codes]

TX_COLUMNS = f"""id, {stamp('ts')} AS timestamp, ym AS timestamp_ym, company_id, plan_name AS company_plan,
  channel_original AS channel, success, state, kind, cents / 100.0 AS amount, international,
  sender AS sender_xin_value, receiver AS receiver_xin_value"""


def _tx_columns(tx):
    return tx.select(
        "id", "timestamp", "timestamp_ym", "company_id", "company_plan", "channel", "success",
        "state", "kind", F.col("import").alias("amount"), "international", "sender_xin_value",
        "receiver_xin_value",
    )


def _events(spark, sf_dir):
    return readers.scan_lifecycle(B.lifecycle(spark, sf_dir))


EVENT_COLUMNS = f"""{stamp('ts')} AS event_ts, company, action, plan_name AS plan, payment_type,
  company_name, event_id"""


def _event_columns(df):
    return df.select(
        F.col("@timestamp").alias("event_ts"), "company", "action", "plan", "payment_type",
        "company_name", "event_id",
    )


# -- sources -------------------------------------------------------------------

@query("scan_transactions", with_(B.TX) + f"SELECT {TX_COLUMNS} FROM tx")
def scan_transactions(spark, sf_dir):
    return _tx_columns(readers.scan_transactions(B.transactions(spark, sf_dir)))


@query("scan_registry", with_(B.REGISTRY) + f"""
SELECT company_id, country, {stamp('data_alta')} AS data_alta, {stamp('data_alta')} AS data_subscripcio, plan,
  {stamp('date_first_client')} AS date_first_client, {stamp('date_first_invoice')} AS date_first_invoice,
  number_clients, postal_code, {stamp('date_last_updated')} AS date_last_updated, company_name, xin_value,
  strftime(date_last_updated, '%Y%m') AS date_last_updated_ym FROM reg_scan""")
def scan_registry(spark, sf_dir):
    return readers.scan_registry(B.registry(spark, sf_dir))


@query("scan_registry_short", with_(B.REGISTRY) + f"""
SELECT plan, postal_code, {stamp('date_last_updated')} AS date_last_updated, company_id,
  strftime(date_last_updated, '%Y%m') AS date_last_updated_ym FROM reg_scan""")
def scan_registry_short(spark, sf_dir):
    return readers.scan_registry(B.registry(spark, sf_dir), readers.REGISTRY_SHORT)


@query("scan_lifecycle", with_(B.EVENTS) + f"""
SELECT {EVENT_COLUMNS}, strftime(ts, '%Y%m') AS timestamp_ym FROM ev_all""")
def scan_lifecycle(spark, sf_dir):
    events = _events(spark, sf_dir)
    return events.select(
        F.col("@timestamp").alias("event_ts"), "company", "action", "plan", "payment_type",
        "company_name", "event_id", "timestamp_ym",
    )


@query("scan_id_ranges", """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
SELECT CAST((o_orderkey - lo) // ((hi - lo) // 200 + 1) AS BIGINT) AS id_range, count(*) AS n,
  min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
FROM orders, b GROUP BY 1""")
def scan_id_ranges(spark, sf_dir):
    rows = readers.scan_id_ranges(B.table(spark, sf_dir, "orders"), "o_orderkey")
    return rows.groupBy("id_range").agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("first_id"),
        F.max("o_orderkey").alias("last_id"),
    )


# -- cleaning --------------------------------------------------------------------

@query("filter_excluded_values", with_(B.TX) + f"""
SELECT {TX_COLUMNS} FROM tx WHERE company_id > 10 AND state IS DISTINCT FROM 'refused'
  AND channel_original IS DISTINCT FROM 'web_form'""")
def filter_excluded_values(spark, sf_dir):
    tx = readers.keep_transactions(readers.scan_transactions(B.transactions(spark, sf_dir)))
    return _tx_columns(cleaning.exclude_values(tx, {"state": ("refused",), "channel": ("web_form",)}))


@query("latest_version", with_(B.REGISTRY) + f"""
SELECT company_id, country, plan, number_clients, {stamp('date_last_updated')} AS date_last_updated,
  {stamp('date_first_client')} AS date_first_client, version FROM reg_new""")
def latest_version(spark, sf_dir):
    versions = readers.scan_registry(B.registry(spark, sf_dir), extra=["version"])
    return cleaning.latest_version(versions, "version").select(
        "company_id", "country", "plan", "number_clients", "date_last_updated",
        "date_first_client", "version",
    )


@query("dedupe_rows", with_(B.TX) + """
SELECT DISTINCT company_id, ym AS timestamp_ym, plan_name AS company_plan, state, kind FROM tx""")
def dedupe_rows(spark, sf_dir):
    tx = readers.scan_transactions(B.transactions(spark, sf_dir))
    return tx.select("company_id", "timestamp_ym", "company_plan", "state", "kind").dropDuplicates()


# Deletes every demo renewal of business plans; sets the first basic sign-up of
# a company to its first professional sign-up and the other way round.
FIX_SQL = with_(B.EVENTS) + f""",
firsts AS (
  SELECT company, plan_name, min(event_id) AS event_id FROM ev_all
  WHERE action = 'alta' AND plan_name IN ('basic', 'professional') GROUP BY ALL),
pairs AS (
  SELECT a.event_id, e.ts AS new_ts FROM firsts a JOIN firsts b
    ON a.company = b.company AND a.plan_name <> b.plan_name JOIN ev_all e ON e.event_id = b.event_id)
SELECT strftime(coalesce(new_ts, ts), '%Y-%m-%d %H:%M:%S') AS event_ts, company, action, plan_name AS plan,
  ev_all.event_id FROM ev_all LEFT JOIN pairs USING (event_id)
WHERE NOT coalesce(action = 'renovacio' AND plan_name = 'business' AND payment_type = 'FreeDemo', false)"""


@query("apply_corrections", FIX_SQL)
def apply_corrections(spark, sf_dir):
    events = _events(spark, sf_dir)
    deleted = specs.Correction(
        "delete", {"action": "renovacio", "plan": "business", "payment_type": "FreeDemo"}
    )
    firsts = (
        events.filter((F.col("action") == "alta") & F.col("plan").isin("basic", "professional"))
        .groupBy("company", "plan")
        .agg(F.min_by(F.struct("event_id", "@timestamp"), "event_id").alias("e"))
        .groupBy("company")
        .agg(
            F.max(F.when(F.col("plan") == "basic", F.col("e"))).alias("a"),
            F.max(F.when(F.col("plan") == "professional", F.col("e"))).alias("b"),
        )
        .filter("a IS NOT NULL AND b IS NOT NULL")
    )
    swap = lambda one, other: F.struct(
        F.col(one)["event_id"].alias("event_id"), F.col(other)["@timestamp"].alias("new_timestamp")
    )
    fixes = firsts.select(F.explode(F.array(swap("a", "b"), swap("b", "a"))).alias("f")).select(
        "f.*", F.lit("set").alias("op")
    )
    fixed = cleaning.corrections_join(
        cleaning.apply_corrections(events, [deleted]), fixes, ["event_id"]
    )
    return fixed.select(
        F.col("@timestamp").alias("event_ts"), "company", "action", "plan", "event_id"
    )


@query("exclude_by_last_state", with_(B.EVENTS) + f""",
gone AS (SELECT company FROM ev_all GROUP BY company
  HAVING arg_max(plan_name, epoch(ts)::BIGINT * 10000000 + event_id) = 'business')
SELECT {EVENT_COLUMNS} FROM ev_all WHERE company NOT IN (SELECT company FROM gone)""")
def exclude_by_last_state(spark, sf_dir):
    return _event_columns(cleaning.exclude_by_last_state(_events(spark, sf_dir), ("business",)))


@query("plan_ordinal", with_(B.REGISTRY) + """
SELECT plan, CASE plan WHEN 'basic' THEN 0 WHEN 'professional' THEN 1 WHEN 'business' THEN 2
  WHEN 'enterprise' THEN 3 ELSE -1 END::BIGINT AS ordinal, count(*) AS n FROM reg_all GROUP BY ALL""")
def plan_ordinal(spark, sf_dir):
    return (
        B.registry(spark, sf_dir)
        .groupBy("plan", S.plan_ordinal("plan").alias("ordinal"))
        .agg(F.count("*").alias("n"))
    )


_GROUP_ARMS = " ".join(
    f"WHEN raw IN ({', '.join(repr(c) for c in codes)}) THEN '{group}'"
    for group, codes in specs.CHANNEL_GROUPS.items()
)


@query("channel_group", f"""
WITH codes AS (SELECT l_linestatus, [{', '.join(repr(c) for c in RAW_CODES)}, 'unlisted', NULL]
    [CAST(l_partkey % {len(RAW_CODES) + 2} AS BIGINT) + 1] AS raw FROM lineitem)
SELECT raw, CASE {_GROUP_ARMS} ELSE raw END AS channel, count(*) AS n FROM codes GROUP BY ALL""")
def channel_group(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in [*RAW_CODES, "unlisted", None]])
    raw = F.element_at(codes, (F.col("l_partkey") % (len(RAW_CODES) + 2) + 1).cast("int"))
    rows = B.table(spark, sf_dir, "lineitem").select(raw.alias("raw"))
    return rows.groupBy("raw", S.channel_group("raw").alias("channel")).agg(F.count("*").alias("n"))


@query("bool_to_int", with_(B.TX) + """
SELECT company_id, sum(international::INT)::BIGINT AS n_international, count(*) AS n FROM tx GROUP BY 1""")
def bool_to_int(spark, sf_dir):
    tx = B.transactions(spark, sf_dir).withColumn("international", F.col("international").cast("int"))
    return tx.groupBy("company_id").agg(
        F.sum("international").alias("n_international"), F.count("*").alias("n")
    )


@query("cohort_semi", with_(B.TX, B.EVENTS, B.REGISTRY, B.PREPARED) + """
SELECT 'events' AS source, company, count(*) AS n FROM ev GROUP BY ALL
UNION ALL SELECT 'transactions', company_id, count(*) FROM ctx GROUP BY ALL
UNION ALL SELECT 'registry', company_id, count(*) FROM reg GROUP BY ALL""")
def cohort_semi(spark, sf_dir):
    events = _events(spark, sf_dir)
    cohort = cleaning.signup_cohort(events)
    registry = cleaning.latest_version(
        readers.scan_registry(B.registry(spark, sf_dir), extra=["version"]), "version"
    )
    sources = {
        "events": (events, "company"),
        "transactions": (B.transactions(spark, sf_dir), "company_id"),
        "registry": (registry, "company_id"),
    }
    parts = [
        cleaning.members(df, cohort, key, "company")
        .groupBy(F.lit(name).alias("source"), F.col(key).alias("company"))
        .agg(F.count("*").alias("n"))
        for name, (df, key) in sources.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("period_filter", with_(B.TX) + f"""
SELECT {TX_COLUMNS} FROM tx WHERE ym >= '199607' AND ym < '199803'""")
def period_filter(spark, sf_dir):
    tx = readers.scan_transactions(B.transactions(spark, sf_dir))
    return _tx_columns(cleaning.in_period(tx, start="199607", before="199803", at="timestamp"))


@query("year_month", """
SELECT strftime(o_orderdate, '%Y%m') AS timestamp_ym, count(*) AS n FROM orders GROUP BY 1""")
def year_month(spark, sf_dir):
    orders = B.table(spark, sf_dir, "orders")
    return orders.groupBy(S.year_month("o_orderdate").alias("timestamp_ym")).agg(F.count("*").alias("n"))


@query("project_rename", with_(B.EVENTS) + f"""
SELECT company AS client, {stamp('ts')} AS happened_at, plan_name AS plan FROM ev_all""")
def project_rename(spark, sf_dir):
    return cleaning.project_rename(
        _events(spark, sf_dir), {"company": "client", "@timestamp": "happened_at", "plan": "plan"}
    )


@query("drop_keys", with_(B.EVENTS) + f"SELECT {EVENT_COLUMNS} FROM ev_all WHERE company NOT IN (77, 84)")
def drop_keys(spark, sf_dir):
    return _event_columns(cleaning.drop_keys(_events(spark, sf_dir), "company", [77, 84]))


@query("drop_incomplete", with_(B.REGISTRY) + f"""
SELECT company_id, plan, {stamp('date_first_client')} AS date_first_client,
  {stamp('date_first_invoice')} AS date_first_invoice, xin_value, version FROM reg_all
WHERE plan IS NOT NULL AND date_first_client IS NOT NULL AND date_first_invoice IS NOT NULL
  AND xin_value IS NOT NULL""")
def drop_incomplete(spark, sf_dir):
    return cleaning.drop_incomplete(
        B.registry(spark, sf_dir).select(
            "company_id", "plan", "date_first_client", "date_first_invoice", "xin_value", "version"
        )
    )


@query("fill_constants", with_(B.REGISTRY) + f"""
SELECT company_id, version, coalesce(plan, 'basic') AS plan, coalesce(xin_value, '-1') AS xin_value,
  strftime(coalesce(date_first_client, TIMESTAMP '1900-12-02 10:59:33'), '%Y-%m-%d %H:%M:%S') AS date_first_client
FROM reg_all""")
def fill_constants(spark, sf_dir):
    rows = B.registry(spark, sf_dir).select(
        "company_id", "version", "plan", "xin_value", "date_first_client"
    )
    return cleaning.fill_constants(
        rows, {"plan": "basic", "xin_value": "-1", "date_first_client": "1900-12-02 10:59:33"}
    )


_WAIT = B.day_diff("{}", "data_alta").format


@query("fill_from_column", with_(B.REGISTRY) + f"""
SELECT company_id, version, number_clients,
  coalesce({_WAIT('date_first_invoice')}, -number_clients) AS days_until_invoice,
  coalesce({_WAIT('date_first_client')}, number_clients) AS days_until_client FROM reg_all""")
def fill_from_column(spark, sf_dir):
    rows = B.registry(spark, sf_dir).select(
        "company_id", "version", F.col("number_clients").cast("bigint").alias("number_clients"),
        S.elapsed_days("date_first_invoice", "data_alta").alias("days_until_invoice"),
        S.elapsed_days("date_first_client", "data_alta").alias("days_until_client"),
    )
    return cleaning.fill_from(
        rows, {"days_until_invoice": ("number_clients", -1), "days_until_client": ("number_clients", 1)}
    )


@query("surrogate_party_id", with_(B.REGISTRY) + """
SELECT company_id, coalesce(xin_value, 'IN' || upper(substr(sha256(company_id::VARCHAR), 1, 9))) AS xin_value
FROM reg_new""")
def surrogate_party_id(spark, sf_dir):
    newest = cleaning.latest_version(
        readers.scan_registry(B.registry(spark, sf_dir), extra=["version"]), "version"
    )
    return newest.select(
        "company_id", S.surrogate_party_id("xin_value", "company_id").alias("xin_value")
    )


@query("direction_predicates", with_(B.TX) + """
SELECT company_id, count_if(is_sent AND NOT pep)::BIGINT AS outgoing,
  count_if((is_rec OR coalesce(kind = 'issue' AND state IN ('paid', 'accepted'), false)) AND NOT pep)::BIGINT AS incoming,
  count_if(pep)::BIGINT AS peppol
FROM (SELECT *, contains(coalesce(channel_original, ''), 'peppol') AS pep FROM tx) GROUP BY 1""")
def direction_predicates(spark, sf_dir):
    tx = B.transactions(spark, sf_dir)
    return tx.groupBy("company_id").agg(
        A.tally(S.is_outgoing("channel")).alias("outgoing"),
        A.tally(S.is_incoming("channel")).alias("incoming"),
        A.tally(S.has_peppol_channel("channel")).alias("peppol"),
    )


@query("composite_key", with_(B.EVENTS) + """
SELECT company || '-' || strftime(ts, '%Y%m') AS company_new, count(*) AS n FROM ev_all GROUP BY 1""")
def composite_key(spark, sf_dir):
    key = S.composite_key("company", "timestamp_ym").alias("company_new")
    return _events(spark, sf_dir).groupBy(key).agg(F.count("*").alias("n"))


@query("tenure_bucket", """
WITH d AS (SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2001-12-01') AS days FROM orders)
SELECT o_orderkey, days, CASE WHEN days < 180 THEN 0 ELSE ceil(days / 365.0) END::BIGINT AS ant FROM d""")
def tenure_bucket(spark, sf_dir):
    at = F.lit("2001-12-01").cast("timestamp")
    rows = B.table(spark, sf_dir, "orders").select(
        "o_orderkey", S.calendar_days(at, "o_orderdate").alias("days")
    )
    return rows.withColumn("ant", S.tenure_years("days"))


@query("derive_arith", with_(B.TX) + """
SELECT company_id, ym AS timestamp_ym, sum(cents) / 100.0 AS amount,
  (count_if(plan = 1) + count_if(plan = 2))::BIGINT AS premium FROM tx GROUP BY ALL""")
def derive_arith(spark, sf_dir):
    tx = readers.scan_transactions(B.transactions(spark, sf_dir))
    plan = S.plan_ordinal("company_plan")
    counts = tx.groupBy("company_id", "timestamp_ym").agg(
        F.sum(F.abs("import")).alias("amount"),
        A.tally(plan == 1).alias("plan_1"), A.tally(plan == 2).alias("plan_2"),
    )
    return counts.select(
        "company_id", "timestamp_ym", "amount", (F.col("plan_1") + F.col("plan_2")).alias("premium")
    )


@query("audit_columns", with_(B.EVENTS) + f"""
SELECT company, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS subscription_date,
  coalesce(sum(plan), 0)::BIGINT AS plans, count(*) FILTER (payment_type = 'Card') AS r,
  '2002-01-01 00:00:00' AS ingest_date FROM ev_all GROUP BY 1""")
def audit_columns(spark, sf_dir):
    rows = _events(spark, sf_dir).groupBy("company").agg(
        F.max("@timestamp").alias("subscription_date"),
        F.sum(S.plan_ordinal("plan")).alias("plans"),
        A.tally(F.col("payment_type") == "Card").cast("double").alias("r"),
    )
    return sinks.with_audit_columns(rows, "2002-01-01 00:00:00")


# -- scalar functions --------------------------------------------------------------

@query("date_difference", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  date_diff('day', o_orderdate, l_shipdate)::BIGINT AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_difference(spark, sf_dir):
    lines, orders = B.table(spark, sf_dir, "lineitem"), B.table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        S.calendar_days("l_shipdate", "o_orderdate").alias("days"),
    )


@query("date_shift", f"""
SELECT event_id, {stamp('ts - INTERVAL 40 DAY')} AS days_before,
  {stamp('ts - INTERVAL 5 MONTH')} AS months_before FROM events""")
def date_shift(spark, sf_dir):
    return B.table(spark, sf_dir, "events").select(
        "event_id", S.minus_days("ts", 40).alias("days_before"),
        S.minus_months("ts", 5).alias("months_before"),
    )


@query("parse_timestamp", f"""
SELECT event_id, {stamp('ts')} AS parsed, extract('hour' FROM ts)::BIGINT AS hour FROM events""")
def parse_timestamp(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")
    rows = B.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    parsed = S.utc_timestamp(text)
    return rows.select("event_id", parsed.alias("parsed"), F.hour(parsed).alias("hour"))


@query("string_contains", """
SELECT doc_id, contains(text, 'http') AS has_link, contains(text, 'HTTP') AS has_upper FROM documents""")
def string_contains(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select(
        "doc_id", F.contains("text", F.lit("http")).alias("has_link"),
        F.contains("text", F.lit("HTTP")).alias("has_upper"),
    )


@query("range_filter_pair", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_extendedprice
FROM lineitem WHERE l_quantity < 20 AND l_discount < 20 AND l_extendedprice > 1000 AND l_extendedprice < 50000""")
def range_filter_pair(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_extendedprice",
    )
    both = stats.both_below(lines, "l_quantity", "l_discount", 20)
    return stats.strictly_between(both, "l_extendedprice", 1000, 50000)


# Events as logged, with the values that cleaning is about: switch actions, left and test companies, repeated rows.
LOGGED = f"""
logged AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 13 = 0 THEN 'autorenovacio on' WHEN event_id % 17 = 0 THEN 'autorenovacio off' ELSE action END AS action,
    CASE WHEN event_id % 19 = 0 THEN 'aplicateca2' WHEN event_id % 11 = 0 THEN 'enterprise' ELSE plan_name END AS plan_name,
    CASE WHEN company % 23 = 0 THEN '{specs.TEST_COMPANY_NAMES[0]}' ELSE company_name END AS company_name) FROM ev_all),
left_for AS (
  SELECT company FROM (SELECT company, arg_max(plan_name, (ts, ts, event_id)) FILTER (plan_name IS NOT NULL) AS last_plan
    FROM logged WHERE action IS NULL OR action NOT LIKE 'autorenovacio%' GROUP BY 1)
  WHERE last_plan IN ('enterprise', 'aplicateca2', 'aplicateca5'))"""


@query("clean_lifecycle", with_(B.EVENTS, LOGGED) + f"""
SELECT {EVENT_COLUMNS} FROM logged
WHERE (action IS NULL OR action NOT LIKE 'autorenovacio%') AND company NOT IN (SELECT company FROM left_for)
  AND company_name <> '{specs.TEST_COMPANY_NAMES[0]}' AND (plan_name IS NULL OR plan_name NOT IN ('aplicateca2', 'aplicateca5'))""")
def clean_lifecycle(spark, sf_dir):
    rows, event = _events(spark, sf_dir), F.col("event_id")
    logged = rows.withColumns({
        "action": F.when(event % 13 == 0, "autorenovacio on").when(event % 17 == 0, "autorenovacio off").otherwise(F.col("action")),
        "plan": F.when(event % 19 == 0, "aplicateca2").when(event % 11 == 0, "enterprise").otherwise(F.col("plan")),
        "company_name": F.when(F.col("company") % 23 == 0, specs.TEST_COMPANY_NAMES[0]).otherwise(F.col("company_name")),
    })
    repeated = logged.unionByName(logged.filter(event % 5 == 0))
    return _event_columns(cleaning.clean_lifecycle(repeated))
