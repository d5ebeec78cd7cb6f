"""A corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.scale import materialized
from cohortry.llm import quality_classifier, quality_rules
from cohortry.llm.near_duplicates import near_duplicates, text_class
from cohortry.llm.queries import pieces_of


def well_classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores at least the cutoff, learnt from labels that aren't held out.

    A null or empty text has a score like any other. Repeated rows, and rows
    without id, are judged each. All columns stay as they are, whatever their
    names; an empty table stays empty.
    """
    spec = quality_classifier.ClassifierSpec()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~quality_classifier.held_out(F.col("doc_id")))
    model = quality_classifier.fit(docs, labels, spec)
    return docs.where(quality_classifier.score(model, F.col("text")) >= spec.cutoff)


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's fences.

    A null or empty text fails the base rules. Null languages and sources are
    groups like others; repeated rows count and are judged each. All columns
    stay as they are; an empty table stays empty.
    """
    return quality_rules.judged(docs, carry=True).where("kept").select("row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id.

    Rows that repeat an id are one document and keep one row: of those with the
    text that was compared, the set with the smallest hash, the one with the
    smallest text, and of equal texts the one whose row as JSON has the smallest
    MD5. Rows without id stay, as do texts without words. An empty table stays
    empty.
    """
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL")
    kept = materialized(kept.groupBy("doc_id").agg(F.count("*").alias("_rows")))
    of = lambda condition: docs.join(kept.where(condition), "doc_id", "left_semi")
    row = F.struct(*[F.col(c) for c in docs.columns])
    # The texts without words come last: a document with others was compared by those.
    order = F.struct(F.col("kind").isNull(), F.col("kind"), F.col("row.text"), F.md5(F.to_json("row")))
    several = of("_rows > 1").select(F.col("doc_id").alias("_id"), row.alias("row"), text_class(F.col("text")).alias("kind"))
    one = several.groupBy("_id").agg(F.min_by("row", order).alias("row")).select("row.*")
    return of("_rows = 1").select(*docs.columns).union(one.select(*docs.columns)).union(docs.where("doc_id IS NULL"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, as pieces.

    A null or empty text is its end alone; repeated rows, and rows without id,
    are packed each. An empty table gives no pieces.
    """
    return pieces_of(docs)


STAGES = [
    ("quality_classifier", well_classified),
    ("quality_rules", within_rules),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents`, each stored for the next; empty tables give no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialized(docs)
    return docs
