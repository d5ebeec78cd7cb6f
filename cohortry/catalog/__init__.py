"""All queries over the test tables, with an SQL oracle where one exists."""

from cohortry.catalog import cleaning, modelling, panels, tables
from cohortry.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
