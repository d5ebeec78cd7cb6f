"""Reading raw and prepared tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry import specs
from cohortry.functions import scalars as S


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def read_exported_csv(
    spark: SparkSession, path: str, schema: T.StructType, row_number: str = "Unnamed: 0"
) -> DataFrame:
    """A CSV exported with a leading row number, which is dropped."""
    full = T.StructType([T.StructField(row_number, T.LongType()), *schema.fields])
    return read_table(spark, path, full, "csv").drop(row_number)


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
    partitions: int = 200, **options: str,
) -> DataFrame:
    """A bulk read split into half-open id ranges, one task each."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=column, lowerBound=lower,
            upperBound=upper, numPartitions=partitions, **options,
        )
        .load()
    )


def scan_transactions(raw: DataFrame) -> DataFrame:
    """Transactions with their month; a stored month, as of a partition, stays."""
    if "timestamp_ym" in raw.columns:
        return raw.withColumn("timestamp_ym", F.col("timestamp_ym").cast("string"))
    return raw.withColumn("timestamp_ym", S.year_month("timestamp"))


def keep_transactions(tx: DataFrame) -> DataFrame:
    """Drop excluded plans, small company ids and placeholder parties."""
    return tx.filter(
        S.not_equal("company_plan", *specs.EXCLUDED_PLANS)
        & (F.col("company_id") > specs.MIN_COMPANY_ID)
        & S.not_equal("sender_xin_value", *specs.PLACEHOLDER_PARTIES)
        & S.not_equal("receiver_xin_value", *specs.PLACEHOLDER_PARTIES)
    )


REGISTRY_FULL = [
    "company_id", "country", "data_alta", "data_subscripcio", "plan", "date_first_client",
    "date_first_invoice", "number_clients", "postal_code", "date_last_updated",
    "company_name", "xin_value",
]
REGISTRY_SHORT = ["plan", "postal_code", "date_last_updated", "company_id"]


def scan_registry(raw: DataFrame, columns: list[str] = REGISTRY_FULL, extra: list[str] = ()) -> DataFrame:
    """Registry versions of analysed companies; `extra` keeps tie columns."""
    return (
        raw.filter(
            S.not_equal("plan", "enterprise") & (F.col("company_id") > specs.MIN_COMPANY_ID)
        )
        .select(*columns, *extra)
        .withColumn("date_last_updated_ym", S.year_month("date_last_updated"))
    )


def scan_lifecycle(raw: DataFrame) -> DataFrame:
    """Lifecycle events of analysed companies, with their month."""
    return raw.filter(
        (F.col("company") > specs.MIN_COMPANY_ID)
        & S.not_equal("company", *specs.EXCLUDED_COMPANIES)
    ).withColumn("timestamp_ym", S.year_month("@timestamp"))


def id_range(id_column: str, lower: int, upper: int, ranges: int = 200) -> Column:
    """Number of the half-open id range a row belongs to, 0 .. ranges-1."""
    width = (upper - lower) // ranges + 1
    return F.floor((F.col(id_column) - lower) / width).cast("bigint")


def scan_id_ranges(df: DataFrame, id_column: str, ranges: int = 200) -> DataFrame:
    """Rows with their id range; every id is in exactly one range."""
    bounds = df.agg(F.min(id_column).alias("lo"), F.max(id_column).alias("hi")).first()
    lower, upper = (bounds.lo or 0), (bounds.hi or 0)
    return df.withColumn("id_range", id_range(id_column, lower, upper, ranges))
