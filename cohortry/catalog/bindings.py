"""The test tables seen as the pipeline's three raw inputs, in Spark and in
SQL. Queries and oracles both start from here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.plans.features import Raw
from cohortry.sources.readers import read_table

PLANS = {"O": "basic", "P": "professional", "F": "business"}
# One raw code of each listed channel group, by return flag and line status.
CHANNELS = {"RF": "peppol", "RO": "web_form", "NF": "pdf_by_mail", "NO": "facturae_32_face", "AO": "download_pdf"}
STATES = {"R": "received", "A": "sent", "N": "refused"}
KINDS = {"O": "issue", "F": "reception"}
ACTIONS = {"1-URGENT": "alta", "2-HIGH": "upgrade", "3-MEDIUM": "renovacio", "4-NOT SPECIFIED": "downgrade", "5-LOW": "baixa"}
SEGMENTS = {"BUILDING": "basic", "MACHINERY": "professional", "AUTOMOBILE": "business", "HOUSEHOLD": "enterprise"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _case(col, mapping: dict):
    chain = F
    for key, value in mapping.items():
        chain = chain.when(col == key, F.lit(value))
    return chain


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    discount = F.col("l_discount")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("o_custkey").alias("company_id"),
        _case(F.col("o_orderstatus"), PLANS).alias("company_plan"),
        _case(F.concat("l_returnflag", "l_linestatus"), CHANNELS).alias("channel"),
        F.when(discount < 0.03, F.lit(False)).when(discount <= 0.07, F.lit(True)).alias("success"),
        _case(F.col("l_returnflag"), STATES).alias("state"),
        _case(F.col("l_linestatus"), KINDS).alias("kind"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("import"),
        (F.col("l_tax") > 0.04).alias("international"),
        F.concat(F.lit("X"), F.col("o_custkey")).alias("sender_xin_value"),
        F.concat(F.lit("X"), F.col("l_suppkey")).alias("receiver_xin_value"),
    )


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("@timestamp"),
        F.col("o_custkey").alias("company"),
        _case(F.col("o_orderpriority"), ACTIONS).alias("action"),
        _case(F.col("o_orderstatus"), PLANS).alias("plan"),
        F.when(key % 7 == 0, F.lit("FreeDemo")).when(key % 7 != 1, F.lit("Card")).alias("payment_type"),
        F.concat(F.lit("Company "), F.col("o_custkey")).alias("company_name"),
        F.col("o_orderdate").alias("date_last_updated"),
        key.alias("event_id"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version per order of the company."""
    companies = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    versions = table(spark, sf_dir, "orders")
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    shifted = lambda days: at + F.make_dt_interval(days.cast("int"))
    return (
        versions.join(companies, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("company_id"),
            F.col("n_name").alias("country"),
            at.alias("data_alta"),
            at.alias("data_subscripcio"),
            _case(F.col("c_mktsegment"), SEGMENTS).alias("plan"),
            F.when(key % 4 != 0, shifted(key % 90)).alias("date_first_client"),
            F.when(key % 5 != 0, shifted(key % 400 - 100)).alias("date_first_invoice"),
            (key % 50).cast("int").alias("number_clients"),
            F.concat(F.lit("P"), F.col("c_custkey") % 97).alias("postal_code"),
            at.alias("date_last_updated"),
            F.col("c_name").alias("company_name"),
            F.when(F.col("c_custkey") % 11 != 0, F.concat(F.lit("X"), F.col("c_custkey"))).alias("xin_value"),
            key.alias("version"),
        )
    )


def raw(spark: SparkSession, sf_dir: str) -> Raw:
    return Raw(transactions(spark, sf_dir), registry(spark, sf_dir), lifecycle(spark, sf_dir))


# -- the same in SQL -----------------------------------------------------------

def sql_case(expr: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {arms} END"


TX = f"""
tx_raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         l_shipdate AS ts, strftime(l_shipdate, '%Y%m') AS ym,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS BIGINT) AS p,
         o_custkey AS company_id,
         {sql_case('o_orderstatus', PLANS)} AS plan_name,
         {sql_case("l_returnflag || l_linestatus", CHANNELS)} AS channel_original,
         CASE WHEN l_discount < 0.03 THEN false WHEN l_discount <= 0.07 THEN true END AS success,
         {sql_case('l_returnflag', STATES)} AS state,
         {sql_case('l_linestatus', KINDS)} AS kind,
         CAST(round(abs(l_extendedprice) * 100) AS BIGINT) AS cents,
         l_tax > 0.04 AS international,
         'X' || o_custkey AS sender, 'X' || l_suppkey AS receiver
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
tx AS (
  SELECT *, CASE plan_name WHEN 'basic' THEN 0 WHEN 'professional' THEN 1 WHEN 'business' THEN 2 ELSE -1 END AS plan,
         CASE channel_original WHEN 'peppol' THEN 'Peppol' WHEN 'web_form' THEN 'Other'
              WHEN 'pdf_by_mail' THEN 'Mail' WHEN 'facturae_32_face' THEN 'B2G'
              WHEN 'download_pdf' THEN 'Downloads' END AS channel,
         coalesce(state = 'sent', false) OR coalesce(kind = 'issue', false) AS is_sent,
         coalesce(state = 'received', false) OR coalesce(kind = 'reception', false) AS is_rec,
         coalesce(success, state IS NULL OR state NOT IN ('refused', 'error', 'discarded', 'cancelled',
           'ocr_failed', 'quote_expired', 'quote_error', 'quote_refused')) AS ok,
         coalesce(NOT success, false) OR (success IS NULL AND coalesce(state = 'refused', false))
           OR coalesce(state IN ('error', 'discarded', 'cancelled', 'ocr_failed', 'quote_expired',
           'quote_error', 'quote_refused'), false) AS failed
  FROM tx_raw)"""

EVENTS = f"""
ev_raw AS (
  SELECT o_orderdate AS ts, o_custkey AS company,
         {sql_case('o_orderpriority', ACTIONS)} AS action,
         {sql_case('o_orderstatus', PLANS)} AS plan_name,
         CASE WHEN o_orderkey % 7 = 0 THEN 'FreeDemo' WHEN o_orderkey % 7 <> 1 THEN 'Card' END AS payment_type,
         'Company ' || o_custkey AS company_name, o_orderkey AS event_id,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS BIGINT) AS p
  FROM orders),
ev_all AS (
  SELECT *, CASE plan_name WHEN 'basic' THEN 0 WHEN 'professional' THEN 1 WHEN 'business' THEN 2 ELSE -1 END AS plan
  FROM ev_raw WHERE company > 10 AND company <> 504)"""

REGISTRY = f"""
reg_all AS (
  SELECT c_custkey AS company_id, n_name AS country, o_orderdate AS data_alta,
         {sql_case('c_mktsegment', SEGMENTS)} AS plan,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 90 AS INTEGER)) END AS date_first_client,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 400 - 100 AS INTEGER)) END AS date_first_invoice,
         CAST(o_orderkey % 50 AS BIGINT) AS number_clients, 'P' || (c_custkey % 97) AS postal_code,
         o_orderdate AS date_last_updated, c_name AS company_name,
         CASE WHEN c_custkey % 11 <> 0 THEN 'X' || c_custkey END AS xin_value, o_orderkey AS version
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
reg_scan AS (SELECT * FROM reg_all WHERE plan IS DISTINCT FROM 'enterprise' AND company_id > 10),
reg_new AS (
  SELECT * FROM reg_scan
  QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY date_last_updated DESC, version DESC) = 1)"""


# Cohort-restricted inputs, as the pipeline prepares them.
PREPARED = """
cohort AS (SELECT DISTINCT company FROM ev_all WHERE action = 'alta' AND plan_name = 'basic'),
ev AS (SELECT * FROM ev_all WHERE company IN (SELECT company FROM cohort)),
ctx AS (SELECT * FROM tx WHERE company_id IN (SELECT company FROM cohort)),
reg AS (SELECT * FROM reg_new WHERE company_id IN (SELECT company FROM cohort)),
reg_ids AS (SELECT company_id, xin_value FROM reg WHERE xin_value IS NOT NULL),
unreg AS (
  SELECT * FROM ctx WHERE company_id NOT IN (SELECT company_id FROM reg_ids)
    AND NOT contains(coalesce(channel_original, ''), 'peppol')),
claims AS (
  SELECT sender AS xin_value, company_id FROM unreg WHERE is_sent
  UNION ALL
  SELECT receiver, company_id FROM unreg
  WHERE is_rec OR coalesce(kind = 'issue' AND state IN ('paid', 'accepted'), false)),
ids AS (
  SELECT max(company_id) AS company_id, xin_value FROM claims GROUP BY xin_value
  UNION ALL VALUES (105288, '#personal xin'), (151379, '#personal xin')
  UNION ALL SELECT company_id, xin_value FROM reg_ids)"""

# Each transaction twice: once for the sender, once for the receiver.
ROLES = """
roles AS (
  SELECT sender AS party, receiver AS partner, 'sent' AS role, * FROM {tx}
  UNION ALL
  SELECT receiver, sender, 'rec', * FROM {tx})"""


def roles(tx: str = "tx") -> str:
    return ROLES.format(tx=tx)


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def day_diff(end: str, start: str) -> str:
    """Whole elapsed days, rounded down."""
    return f"CAST(floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0) AS BIGINT)"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def rounded(c):
    """c to six digits; a number that has no more is left as it is, which is far quicker than rounding it."""
    short = (F.abs(c) < 1e9) & (F.rint(c * 1e6) / 1e6 == c)
    return F.when(short, c).otherwise(F.round(c, 6))


def presented(df: DataFrame) -> DataFrame:
    """Query output: timestamps as text, integers as bigint, numbers rounded
    the way the oracles round them."""
    def shown(field):
        c, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif kind == "decimal":
            c = c.cast("double")
        elif kind in ("double", "float"):
            c = rounded(c.cast("double")) + F.lit(0.0)
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])
