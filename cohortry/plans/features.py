"""From raw tables to the prepared tables: feature panel, accumulations,
company master, churn tables and party ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions import scalars as S
from cohortry.functions.scale import materialized
from cohortry.operators import cleaning, identity, lifecycle, panel, running
from cohortry.sources import readers
from cohortry.specs import SnapshotSpec


@dataclass
class Raw:
    """The three raw inputs."""

    transactions: DataFrame
    registry: DataFrame
    lifecycle: DataFrame


@dataclass
class Prepared:
    """Cleaned inputs, restricted to the sign-up cohort."""

    tx: DataFrame
    registry: DataFrame
    events: DataFrame
    cohort: DataFrame
    ids: DataFrame


@dataclass
class Tables:
    """The prepared tables."""

    behaviour: DataFrame
    companies: DataFrame
    churn: DataFrame
    churn_basic: DataFrame
    ids: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "behaviour": self.behaviour, "companies": self.companies, "churn": self.churn,
            "churn_basic": self.churn_basic, "party_ids": self.ids,
        }


def prepare_events(raw: DataFrame, spec: SnapshotSpec, corrections: list = ()) -> DataFrame:
    """Events with ordinal plans of companies that signed up for basic."""
    events = cleaning.clean_lifecycle(readers.scan_lifecycle(raw), corrections)
    events = cleaning.in_period(events, start=spec.lifecycle_from, at="@timestamp")
    events = cleaning.members(events, cleaning.signup_cohort(events), "company")
    return events.withColumn("plan", S.plan_ordinal("plan"))


def prepare_transactions(raw: DataFrame, cohort: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """Transactions recorded by cohort companies, with ordinal plans and
    channel groups; the raw channel is kept as channel_original."""
    tx = cleaning.in_period(readers.scan_transactions(raw), before=spec.transactions_before, at="timestamp")
    tx = cleaning.exclude_values(
        tx,
        {
            "company_plan": specs.EXCLUDED_PLANS,
            "sender_xin_value": specs.PLACEHOLDER_PARTIES[1:],
            "receiver_xin_value": specs.PLACEHOLDER_PARTIES[1:],
        },
    )
    tx = cleaning.members(tx, cohort, "company_id", "company")
    return (
        tx.withColumn("company_plan", S.plan_ordinal("company_plan"))
        .withColumn("channel_original", F.col("channel"))
        .withColumn("channel", S.channel_group("channel"))
        .withColumn("international", F.col("international").cast("int"))
    )


def prepare_registry(raw: DataFrame, cohort: DataFrame, spec: SnapshotSpec, tie: str | None = None) -> DataFrame:
    """Newest registry version of each cohort company."""
    registry = cleaning.latest_version(
        readers.scan_registry(raw, extra=[tie] if tie else []), tie
    )
    if spec.registry_before:
        registry = registry.filter(F.col("date_last_updated") < F.lit(spec.registry_before).cast("timestamp"))
    return cleaning.members(registry, cohort, "company_id", "company")


def prepare(raw: Raw, spec: SnapshotSpec = specs.RFM_SNAPSHOTS, corrections: list = (), tie: str | None = None) -> Prepared:
    """Clean the inputs and store them. The transactions are stored as the
    cohort's rows with the few columns that features need, so the raw table is
    read once, however many windows and blocks are derived."""
    events = materialized(prepare_events(raw.lifecycle, spec, corrections))
    cohort = cleaning.signup_cohort(events, basic=0)
    events = cleaning.in_period(events, before=spec.lifecycle_before)
    registry = materialized(prepare_registry(raw.registry, cohort, spec, tie))
    tx = materialized(prepare_transactions(raw.transactions, cohort, spec))
    ids = materialized(identity.resolve_party_ids(tx, registry))
    return Prepared(tx, registry, events, cohort, ids)


def build_tables(prepared: Prepared, spec: SnapshotSpec = specs.RFM_SNAPSHOTS) -> Tables:
    """Everything the segmentation and the models read. The tables are plans
    over stored intermediates: write them once and read them back."""
    companies = lifecycle.company_master(prepared.events, prepared.registry)
    churn = lifecycle.churn_premium(prepared.events)
    features = panel.feature_panel(
        prepared.tx, prepared.events, prepared.ids, companies, churn, spec, gathered=True
    )
    count = panel.snapshot_count(prepared.tx, spec)
    return Tables(
        behaviour=running.panel_accumulate(features.drop("snapshot"), spec, ids=prepared.ids, snapshots=count),
        companies=companies,
        churn=churn,
        churn_basic=lifecycle.churn_basic(prepared.events),
        ids=prepared.ids,
    )


def build_training_tables(prepared: Prepared, spec: SnapshotSpec, medians: bool = True) -> Tables:
    """The tables of labelled sets: one trailing panel, whose rows also carry the
    lifetime sums of their own periods, so that no second panel is built and joined."""
    companies = lifecycle.company_master(prepared.events, prepared.registry)
    churn = lifecycle.churn_premium(prepared.events)
    features = panel.feature_panel(
        prepared.tx, prepared.events, prepared.ids, companies, churn, spec, own=True, medians=medians, gathered=True
    )
    count = panel.snapshot_count(prepared.tx, spec)
    return Tables(
        behaviour=running.panel_accumulate(features.drop("snapshot"), spec, ids=prepared.ids, snapshots=count),
        companies=companies,
        churn=churn,
        churn_basic=lifecycle.churn_basic(prepared.events),
        ids=prepared.ids,
    )


def build_latest_tables(prepared: Prepared, spec: SnapshotSpec = specs.RFM_SNAPSHOTS) -> Tables:
    """The tables of the segmentation, which reads each company's newest snapshot alone."""
    companies = lifecycle.company_master(prepared.events, prepared.registry)
    churn = lifecycle.churn_premium(prepared.events)
    inputs = (prepared.tx, prepared.events, prepared.ids, companies, churn, spec)
    if spec.trailing or spec.first_after:
        behaviour = running.last_accumulated(panel.feature_panel(*inputs).drop("snapshot"), spec)
    else:
        behaviour = panel.latest_rows(*inputs)
    return Tables(
        behaviour=behaviour,
        companies=companies,
        churn=churn,
        churn_basic=lifecycle.churn_basic(prepared.events),
        ids=prepared.ids,
    )
