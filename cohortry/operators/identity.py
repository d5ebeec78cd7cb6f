"""Which party ids belong to which company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions import aggregates as A
from cohortry.functions import scalars as S
from cohortry.operators import cleaning


def registry_ids(registry: DataFrame) -> DataFrame:
    return registry.select("company_id", "xin_value").filter(F.col("xin_value").isNotNull())


def unregistered(tx: DataFrame, registry: DataFrame) -> DataFrame:
    """Transactions of companies that have no registered party id."""
    return cleaning.non_members(tx, registry_ids(registry), "company_id")


def _claims(tx: DataFrame) -> DataFrame:
    """(party id, company) pairs: the sender of an outgoing transaction and
    the receiver of an incoming one belong to the recording company."""
    claim = lambda cond, party: F.when(cond, F.col(party))
    parties = F.array(
        claim(S.is_outgoing(), "sender_xin_value"), claim(S.is_incoming(), "receiver_xin_value")
    )
    return A.with_keys(
        tx.select(F.explode(parties).alias("xin_value"), "company_id"), "xin_value", "company_id"
    )


def id_set(tx: DataFrame) -> DataFrame:
    """Companies seen per party id, one row per member."""
    return _claims(tx).distinct()


def max_company_per_id(tx: DataFrame) -> DataFrame:
    """Largest company id per party id."""
    return _claims(tx).groupBy("xin_value").agg(F.max("company_id").alias("company_id"))


def resolve_party_ids(
    tx: DataFrame, registry: DataFrame,
    constants: tuple[tuple[int, str], ...] = specs.PLACEHOLDER_OWNERS,
) -> DataFrame:
    """Company to party id, many to many: ids inferred from transactions of
    unregistered companies, fixed owners of placeholders, registered ids."""
    spark = tx.sparkSession
    inferred = max_company_per_id(unregistered(tx, registry)).select("company_id", "xin_value")
    fixed = spark.createDataFrame(list(constants), "company_id bigint, xin_value string")
    ids = inferred.unionByName(fixed).unionByName(registry_ids(registry))
    return ids.withColumn("xin_value", S.surrogate_party_id("xin_value", "company_id"))
