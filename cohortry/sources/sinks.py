"""Writing prepared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions import scalars as S


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None
) -> str:
    """Write one table. A partitioned table is first gathered by its partition
    column; adaptive execution cuts a month by its measured size, so a large
    one is written by many tasks and a small one gives one file."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def write_prepared(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """The prepared tables (behaviour, companies, churn, churn_basic, party
    ids); those with a month are partitioned by it."""
    return {
        name: write_table(
            df, f"{folder}/{name}", fmt,
            "timestamp_ym" if fmt == "parquet" and "timestamp_ym" in df.columns else None,
        )
        for name, df in tables.items()
    }


def write_segments(basic: DataFrame, premium: DataFrame, folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Premium, basic and combined segment tables."""
    both = premium.unionByName(basic, allowMissingColumns=True)
    tables = {"rfm_premium": premium, "rfm_basic": basic, "segmentation_model": both}
    return {name: write_table(df, f"{folder}/{name}", fmt) for name, df in tables.items()}


def with_audit_columns(df: DataFrame, run_ts: str) -> DataFrame:
    """Ready for upload: ingest date, UTC subscription date, missing numbers
    0, integer r score."""
    out = df.withColumn("ingest_date", F.to_timestamp(F.lit(run_ts)))
    if "subscription_date" in df.columns:
        out = out.withColumn("subscription_date", S.utc_timestamp("subscription_date"))
    return out.na.fill(0).withColumn("r", F.col("r").cast("int"))
