"""Connected components of a link table, by contraction in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.functions.scale import materialized

ROWS = 250_000  # of narrow tables, to a file


def compact(df: DataFrame, rows: int) -> DataFrame:
    """Store a narrow table of at most so many rows in as many files as that needs."""
    return materialized(df.coalesce(-(-rows // ROWS) or 1))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b): the smallest id it reaches.

    Each round points every id at its smallest neighbour, follows the pointers
    twice, and replaces the ends of all links by what they point at. Links
    inside one target vanish, so the table shrinks until it is empty. The
    smallest id of a component always points at itself. Every table is stored,
    so a round survives lost executors; nothing is collected. Links with a null
    end, loops and repeated links count for nothing.
    """
    links = materialized(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b").distinct()
    )
    rounds: list[DataFrame] = []
    while (count := links.count()) or not rounds:
        both = links.union(links.select("b", "a"))
        near = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        near = compact(near.select("id", F.least("id", "to").alias("to")), 2 * count)
        far = near.select(F.col("id").alias("to"), F.col("to").alias("next"))
        pointed = compact(near.join(far, "to").select("id", F.col("next").alias("to")), 2 * count)
        rounds.append(pointed)
        a = pointed.select(F.col("id").alias("a"), F.col("to").alias("to_a"))
        b = pointed.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        moved = links.join(a, "a").select("b", "to_a").join(b, "b")
        links = compact(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .where("a <> b").distinct(), count
        )
    found = rounds[-1]
    for pointed in rounds[-2::-1]:
        last = found.select(F.col("id").alias("to"), F.col("to").alias("end"))
        found = pointed.join(last, "to", "left").select("id", F.coalesce("end", "to").alias("to"))
    return found.select("id", F.col("to").alias("component"))
