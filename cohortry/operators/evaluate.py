"""Evaluation of scored rows: columns target, probability, predicted."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

TARGET, SCORE, PRED = "target", "probability", "predicted"


def threshold_predict(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    return scores.withColumn(PRED, (F.col(SCORE) >= F.lit(cutoff)).cast("int"))


def score_counts(scores: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score; ties become one row."""
    return scores.groupBy(SCORE).agg(
        F.count(F.when(F.col(TARGET) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(TARGET) == 0, 1)).alias("neg"),
    )


def in_slices(counts: DataFrame, slices: int = 256) -> DataFrame:
    """Distinct scores cut into slices of about equal size ("_slice", rising
    with the score) at approximate quantiles, however the scores cluster."""
    cuts = sorted(
        set(counts.approxQuantile(SCORE, [i / slices for i in range(1, slices)], 0.5 / slices))
    )
    if not cuts:
        return counts.withColumn("_slice", F.lit(0.0))
    splits = [-float("inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=SCORE, outputCol="_slice").transform(counts)


def roc_points(scores: DataFrame, slices: int = 256) -> DataFrame:
    """True and false positive rate at every distinct score, highest first.

    The running sums go over all distinct scores. Sums run inside a slice of
    them and the totals of the slices above are added, so no task sorts all
    scores.
    """
    sliced = in_slices(score_counts(scores), slices)
    above = W.orderBy(F.desc("_slice")).rowsBetween(W.unboundedPreceding, -1)
    totals = sliced.groupBy("_slice").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    everything = W.partitionBy()
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p0"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n0"),
        F.sum("_p").over(everything).alias("_P"),
        F.sum("_n").over(everything).alias("_N"),
    )
    upto = W.partitionBy("_slice").orderBy(F.desc(SCORE)).rowsBetween(W.unboundedPreceding, 0)
    # at most `slices` lines: safe to broadcast
    return sliced.join(F.broadcast(offsets), "_slice").select(
        F.col(SCORE).alias("threshold"),
        "pos",
        "neg",
        (F.sum("pos").over(upto) + F.col("_p0")).alias("tp"),
        (F.sum("neg").over(upto) + F.col("_n0")).alias("fp"),
        F.col("_P").alias("positives"),
        F.col("_N").alias("negatives"),
    ).withColumn("tpr", F.col("tp") / F.nullif("positives", F.lit(0))).withColumn(
        "fpr", F.col("fp") / F.nullif("negatives", F.lit(0))
    )


def roc_auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids, in one row."""
    area = F.col("neg") * (2 * F.col("tp") - F.col("pos"))
    return roc_points(scores).agg(
        (
            F.sum(area.cast("decimal(38,0)")).cast("double")
            / (2.0 * F.max("positives") * F.max("negatives"))
        ).alias("auc")
    )


def hard_auc(target: str = TARGET, predicted: str = PRED) -> Column:
    """Area of the curve through the single point of 0/1 predictions."""
    rate = lambda cls: F.avg(
        F.when(F.col(target) == cls, (F.col(predicted) == cls).cast("double"))
    )
    return (rate(1) + rate(0)) / 2


def confusion_partitions(scored: DataFrame) -> DataFrame:
    """Rows with a column "outcome": TP, FP, TN or FN."""
    actual, guess = F.col(TARGET), F.col(PRED)
    return scored.withColumn(
        "outcome",
        F.when((actual == 1) & (guess == 1), "TP")
        .when((actual == 0) & (guess == 1), "FP")
        .when((actual == 0) & (guess == 0), "TN")
        .when((actual == 1) & (guess == 0), "FN"),
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    return scored.groupBy(TARGET, PRED).agg(F.count("*").alias("n"))


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, their plain and weighted
    means, and the accuracy. Undefined ratios are 0."""
    cell = lambda a, p: F.count(F.when((F.col(TARGET) == a) & (F.col(PRED) == p), 1)).alias(f"n{a}{p}")
    cells = scored.agg(*[cell(a, p) for a in (0, 1) for p in (0, 1)])
    ratio = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))

    def line(label: str, cls: int):
        hit, missed, wrong = F.col(f"n{cls}{cls}"), F.col(f"n{cls}{1 - cls}"), F.col(f"n{1 - cls}{cls}")
        return [
            F.lit(label).alias("label"), ratio(hit, hit + wrong).alias("precision"),
            ratio(hit, hit + missed).alias("recall"),
            ratio(2.0 * hit, 2 * hit + missed + wrong).alias("f1"),
            (hit + missed).alias("support"),
        ]

    total = reduce(lambda a, b: a + b, [F.col(f"n{a}{p}") for a in (0, 1) for p in (0, 1)])
    share = ratio(F.col("n00") + F.col("n11"), total)
    per_class = cells.select(
        F.explode(F.array(F.struct(*line("0", 0)), F.struct(*line("1", 1)))).alias("_l"),
        share.alias("_accuracy"),
    ).select("_l.*", "_accuracy")
    scores = ("precision", "recall", "f1")
    weight = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
    macro = per_class.agg(*[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support"))
    weighted = per_class.agg(*[weight(c) for c in scores], F.sum("support").alias("support"))
    accuracy = per_class.agg(
        *[F.max("_accuracy").alias(c) for c in scores], F.sum("support").alias("support")
    )
    out = per_class.drop("_accuracy")
    for label, df in (("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(df.withColumn("label", F.lit(label)))
    return out


def score_distribution(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Histogram of the probability per predicted class, over its own range."""
    spans = scored.groupBy(PRED).agg(F.min(SCORE).alias("low"), F.max(SCORE).alias("high"))
    at = F.floor((F.col(SCORE) - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    bin_ = F.when(F.col("high") > F.col("low"), F.least(at, F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        scored.join(spans, PRED)
        .groupBy(F.col(PRED).alias("predicted_class"), bin_.cast("bigint").alias("bin"), "low", "high")
        .agg(F.count("*").alias("n"))
    )


def rank_scores(scores: DataFrame, key: list[str], top: int | None = None) -> DataFrame:
    """Rows of current class 0 by falling probability."""
    ranked = scores.filter(F.col(TARGET) == 0).orderBy(F.desc(SCORE), *key)
    return ranked.limit(top) if top is not None else ranked


def rank_importance(importance: DataFrame, value: str = "coefficient") -> DataFrame:
    """Features by falling weight, with their sign."""
    return importance.withColumn(
        "sign", F.when(F.col(value) < 0, F.lit("negative")).otherwise(F.lit("positive"))
    ).orderBy(F.desc(value), "feature")


def positional_merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pair the elements of two one-row arrays by position: left(values),
    right(values) give (position, left_value, right_value)."""
    one = left.select(F.posexplode("values").alias("position", "left_value"))
    two = right.select(F.posexplode("values").alias("position", "right_value"))
    return one.join(two, "position", "left")
