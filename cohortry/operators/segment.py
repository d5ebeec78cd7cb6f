"""Recency, frequency and amount scores and the segments built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions import scalars as S
from cohortry.functions.scale import materialized
from cohortry.operators import cleaning, running


def _ladder(value: Column, bounds: tuple, scores: tuple) -> Column:
    """scores[i] for the first bound the value does not exceed."""
    chain = F
    for bound, score in zip(bounds, scores):
        chain = chain.when(value <= F.lit(bound), F.lit(score))
    return chain.when(value > F.lit(bounds[-1]), F.lit(scores[-1]))


def amount_score(bounds: specs.RfmBounds, value: str = "import") -> Column:
    return _ladder(F.col(value), bounds.amount, (1, 2, 3, 4))


def frequency_score(bounds: specs.RfmBounds, value: str = "num_transactions") -> Column:
    """1 only for exactly the first bound; below it there is no score."""
    n = F.col(value)
    return F.when(n == F.lit(bounds.frequency[0]), F.lit(1)).when(
        n > F.lit(bounds.frequency[0]), _ladder(n, bounds.frequency[1:], (2, 3, 4))
    )


def recency_score(
    days: str = "days_until_last_transaction", tenure: str = "days_since_alta_basic",
    bounds: tuple = specs.RECENCY_BOUNDS,
) -> Column:
    """From the days since the last transaction; without one, from tenure."""
    return _ladder(F.coalesce(F.col(days), F.col(tenure)), bounds, (4, 3, 2, 1))


def is_premium(plan: str = "plan") -> Column:
    return F.col(plan).isin("professional", "business")


def rfm_scores(
    df: DataFrame, premium: specs.RfmBounds = specs.PREMIUM_BOUNDS,
    basic: specs.RfmBounds = specs.BASIC_BOUNDS,
) -> DataFrame:
    """Scores r, f, m; the bounds depend on the plan group, in one pass."""
    pick = lambda score: F.when(is_premium(), score(premium)).otherwise(score(basic))
    return df.select(
        "*", recency_score().alias("r"), pick(frequency_score).alias("f"),
        pick(amount_score).alias("m"),
    )


def rule_chain(rules: tuple[specs.SegmentRule, ...]) -> Column:
    """First rule that holds; empty if none does."""
    chain = F
    for rule in rules:
        chain = chain.when(F.expr(rule.when), F.lit(rule.name))
    return chain.otherwise(F.lit(""))


def assign_segments(
    df: DataFrame, premium: tuple[specs.SegmentRule, ...] = specs.PREMIUM_RULES,
    basic: tuple[specs.SegmentRule, ...] = specs.BASIC_RULES,
) -> DataFrame:
    return df.withColumn(
        "segment", F.when(is_premium(), rule_chain(premium)).otherwise(rule_chain(basic))
    )


def still_customers(last_rows: DataFrame, churn: DataFrame) -> DataFrame:
    """Non-churners, and churners that were active after their churn date."""
    flags = churn.select("company", F.lit(True).alias("_churned"))
    active_after = F.col("days_from_last_transaction") < F.col("days_since_baixa_prem")
    return (
        last_rows.join(flags, "company", "left")
        .filter(F.col("_churned").isNull() | active_after)
        .drop("_churned")
    )


# New name of each column the segmentation works on.
SEGMENT_COLUMNS = {
    "company": "company",
    "med_import_sent_t": "import",
    "days_since_alta_basic": "days_since_alta_basic",
    "days_from_last_transaction": "days_until_last_transaction",
    "company_name": "company_name",
    "country": "country",
    "data_alta_basic": "data_alta_basic",
    "data_alta_premium": "subscription_date",
    "med_trans_sent": "num_transactions",
    "sum_trans_sent": "sum_transactions",
    "num_receivers": "receivers",
    "num_senders": "senders",
    "days_since_baixa_prem": "days_since_baixa_prem",
    "days_until_premium": "days_until_premium",
    "days_until_invoice": "days_until_invoice",
    "channel": "channel",
}

NO_SUBSCRIPTION = "1900-12-02 10:59:33"


def segment_input(
    behaviour: DataFrame, companies: DataFrame, churn: DataFrame, churn_basic: DataFrame,
    registry: DataFrame, order: tuple[str, ...] = running.PANEL_ORDER,
) -> DataFrame:
    """One row per analysed company, ready to be scored."""
    kept = cleaning.non_members(behaviour, churn_basic, "company")
    last_rows = running.last_row_per_company(kept, order)
    about = companies.drop("xin_value", "postal_code")
    rows = still_customers(last_rows.join(about, "company", "left"), churn)
    rows = rows.withColumn(
        "days_between_altas", F.col("days_since_alta_basic") - F.col("days_since_alta_premium")
    ).withColumn("channel", S.dominant_channel())
    plans = registry.select(F.col("company_id").alias("company"), "plan", "postal_code")
    return (
        cleaning.project_rename(rows, SEGMENT_COLUMNS)
        .join(plans, "company")
        .withColumn("plan", F.coalesce("plan", F.lit("basic")))
        .filter(is_premium() | (F.col("plan") == "basic"))
    )


def _complete(df: DataFrame) -> DataFrame:
    """Drop rows missing anything but a score."""
    needed = [c for c in df.columns if c not in ("r", "f", "m", "segment")]
    return df.na.drop("any", subset=needed)


def finish_premium(df: DataFrame) -> DataFrame:
    df = cleaning.fill_from(
        df.drop("days_since_baixa_prem"),
        {c: ("days_since_alta_basic", 1) for c in ("days_until_last_transaction", "days_until_invoice")},
    )
    return _complete(cleaning.fill_constants(df, {"subscription_date": NO_SUBSCRIPTION}))


def finish_basic(df: DataFrame) -> DataFrame:
    waits = ("days_until_last_transaction", "days_until_invoice", "days_until_premium")
    df = cleaning.fill_from(
        df.drop("days_since_baixa_prem", "subscription_date"),
        {c: ("days_since_alta_basic", 1) for c in waits},
    )
    return _complete(df)


def segmentation(
    scored_input: DataFrame, premium_bounds: specs.RfmBounds = specs.PREMIUM_BOUNDS,
    basic_bounds: specs.RfmBounds = specs.BASIC_BOUNDS,
) -> tuple[DataFrame, DataFrame]:
    """(basic, premium) segment tables, from the scored companies stored once."""
    done = assign_segments(rfm_scores(scored_input, premium_bounds, basic_bounds))
    done = materialized(done.withColumn("company_id", F.col("company")))
    return finish_basic(done.filter(~is_premium())), finish_premium(done.filter(is_premium()))


def combined(basic: DataFrame, premium: DataFrame) -> DataFrame:
    return premium.unionByName(basic, allowMissingColumns=True)
