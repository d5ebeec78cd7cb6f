"""Where catalog modules put their queries and oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.catalog.bindings import presented

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, maybe_missing: tuple[str, ...] = ()) -> Callable[[Build], Build]:
    """Register a query; without sql only its rows are checked.

    Whole-number columns listed in maybe_missing are shown as doubles on both
    sides, since not every client has integers with missing values.
    """

    def add(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = presented(build(spark, sf_dir))
            return df.withColumns({c: F.col(c).cast("double") for c in maybe_missing})

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in maybe_missing)
            ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if maybe_missing else sql
        return build

    return add
