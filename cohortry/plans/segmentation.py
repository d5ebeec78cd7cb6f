"""From prepared tables to customer segments."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortry import specs
from cohortry.operators import segment
from cohortry.plans.features import Tables


def segment_customers(
    tables: Tables, registry: DataFrame, premium_bounds: specs.RfmBounds = specs.PREMIUM_BOUNDS,
    basic_bounds: specs.RfmBounds = specs.BASIC_BOUNDS,
) -> tuple[DataFrame, DataFrame]:
    """(basic, premium) segments; `registry` is the newest registry version
    with plan names and postal codes."""
    ready = segment.segment_input(
        tables.behaviour, tables.companies, tables.churn, tables.churn_basic, registry
    )
    return segment.segmentation(ready, premium_bounds, basic_bounds)
