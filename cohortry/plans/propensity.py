"""Churn and upsell models: matrix, cleaning, scaling, split, fit, score."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry import specs
from cohortry.functions.scale import materialized
from cohortry.operators import cleaning, evaluate, models, neighbours, outliers, sampling, stats
from cohortry.operators.labels import ROW_KEY

# Columns that are no features.
NOT_FEATURES = (
    "company", "actual_plan", "timestamp_ym", "data_alta_basic", "data_alta_premium", "country",
    "date_first_client", "date_first_invoice", "postal_code", "company_name", "xin_value",
    "active_prem", "days_since_baixa_prem", "days_since_alta_premium", "last_trans_plan",
)
# Features dropped after scaling, by both models.
DROPPED_FEATURES = (
    "acum_0", "plan_0", "success_true", "trans_max_sent", "last_trans_plan_rec", "b2g_acum",
    "other_acum", "mail_acum", "downloads_acum", "b2brouter_acum", "peppol_acum", "peppol", "mail",
    "b2brouter", "downloads",
)


@dataclass(frozen=True)
class ModelSpec:
    """What differs between the two models. wait_sign is the sign of the
    tenure that replaces a missing wait for the first invoice or client."""

    drop_from_matrix: tuple[str, ...]
    drop_after_scaling: tuple[str, ...]
    wait_sign: int
    trees: specs.BoostedTrees
    split: specs.SplitSpec


CHURN_MODEL = ModelSpec(
    drop_from_matrix=("plan_2", "acum_2"),
    drop_after_scaling=(*DROPPED_FEATURES, "acum_1", "plan_1", "days_since_alta_basic", "number_clients"),
    wait_sign=-1,
    trees=specs.CHURN_TREES,
    split=specs.CHURN_SPLIT,
)
UPSELL_MODEL = ModelSpec(
    drop_from_matrix=("days_until_premium", "number_clients", "acum_1", "plan_1", "plan_2"),
    drop_after_scaling=DROPPED_FEATURES,
    wait_sign=1,
    trees=specs.UPSELL_TREES,
    split=specs.UPSELL_SPLIT,
)

KEY = "company_new"


def row_key(df: DataFrame) -> DataFrame:
    """company-yyyymm, extended by the party id so that it is unique."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (ROW_KEY[0], ROW_KEY[2], ROW_KEY[1])]
    return df.withColumn(KEY, F.concat_ws("-", *parts))


def model_matrix(labelled: DataFrame, spec: ModelSpec) -> DataFrame:
    """Key, numeric features without missing waits and counts, target."""
    tenure = "days_since_alta_basic"
    filled = cleaning.fill_from(
        labelled,
        {
            "days_from_last_transaction": (tenure, 1),
            "days_from_last_transaction_rec": (tenure, 1),
            "days_until_invoice": (tenure, spec.wait_sign),
            "days_until_client": (tenure, spec.wait_sign),
        },
    )
    zeros = ("number_clients", "trans_med_received", "trans_med_sent", "trans_max_received", "trans_max_sent")
    filled = cleaning.fill_constants(filled, {c: 0 for c in zeros if c in filled.columns})
    keyed = row_key(filled)
    left_out = {*NOT_FEATURES, *spec.drop_from_matrix, KEY, "target", "snapshot"}
    features = [c for c in keyed.columns if c not in left_out]
    return keyed.select(KEY, *[F.col(c).cast("double").alias(c) for c in features], "target")


def feature_columns(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in (KEY, "target", "part", "fold")]


@dataclass
class Prepared:
    """Scaled training rows, all scaled rows, and the model's features."""

    train: DataFrame
    everything: DataFrame
    features: list[str]


def prepare(matrix: DataFrame, spec: ModelSpec, trees: int = 100, excluded: tuple[str, ...] = ()) -> Prepared:
    """Rows with an excluded key out, outliers out of the training rows, a
    noise feature in, both scaled by the training rows' moments."""
    matrix = cleaning.drop_keys(matrix, KEY, list(excluded))
    columns = feature_columns(matrix)
    isolated_on = [c for c in columns if c != "days_until_premium"]
    cleaned = outliers.isolation_outliers(matrix, [KEY], isolated_on, trees=trees)
    cleaned = sampling.random_probe(cleaned, [KEY], seed=1)
    everything = sampling.random_probe(matrix, [KEY], seed=1)
    scaled, all_scaled = stats.standardize(cleaned, everything, [*columns, "random"])
    features = [c for c in [*columns, "random"] if c not in spec.drop_after_scaling]
    return Prepared(scaled, all_scaled, features)


def fit_and_score(prepared: Prepared, spec: ModelSpec) -> tuple[DataFrame, DataFrame]:
    """(scores of the test part, feature importances)."""
    parts = materialized(
        sampling.ratio_split(prepared.train, prepared.everything, [KEY], spec.split)
    )
    model = models.fit_boosted(parts.filter("part = 'train'"), prepared.features, spec.trees)
    scored = models.score(model, parts.filter("part = 'test'"), prepared.features, [KEY])
    importance = models.feature_importance(model, prepared.features, prepared.train)
    return evaluate.threshold_predict(scored), importance


@dataclass
class Evaluation:
    """What is known about a fitted model; every part is a table."""

    cross_validation: DataFrame
    accuracy: DataFrame
    report: DataFrame
    confusion: DataFrame
    roc: DataFrame
    distribution: DataFrame
    importance: DataFrame
    false_positives: DataFrame


def evaluate_model(
    prepared: Prepared, spec: ModelSpec, folds: int = 5, oversample: bool = False, cutoff: float = 0.5,
) -> Evaluation:
    """Split, fit, and evaluate on the test part; false positives come from
    scoring all rows out of fold, with their keys.

    With oversample, synthetic rows of class 1 fill the training part; they
    have no key and are in no score. Scores are stored once, all parts of the
    evaluation are plans over them.
    """
    parts = materialized(
        sampling.ratio_split(prepared.train, prepared.everything, [KEY], spec.split)
    )
    columns = prepared.features
    real = parts.filter("part = 'train'")
    train = real.select(KEY, *columns, "target")
    if oversample:
        train = materialized(neighbours.smote(train, KEY, columns))
    model = models.fit_boosted(train, columns, spec.trees)
    scored = {
        name: evaluate.threshold_predict(
            materialized(models.score(model, parts.filter(F.col("part") == name), columns, [KEY])), cutoff
        )
        for name in ("train", "test")
    }
    right = F.avg((F.col("target") == F.col("predicted")).cast("int")).alias("accuracy")
    rates = [df.agg(right).select(F.lit(name).alias("part"), "accuracy") for name, df in scored.items()]
    validation = models.out_of_fold_scores(real, columns, [KEY], spec.trees, folds)
    everywhere = models.out_of_fold_scores(prepared.everything, columns, [KEY], spec.trees, folds)
    outcome = evaluate.confusion_partitions(evaluate.threshold_predict(everywhere, cutoff))
    test = scored["test"]
    return Evaluation(
        cross_validation=models.summarize_folds(materialized(validation)),
        accuracy=rates[0].unionByName(rates[1]),
        report=evaluate.classification_report(test),
        confusion=evaluate.confusion_matrix(test),
        roc=evaluate.roc_points(test),
        distribution=evaluate.score_distribution(test),
        importance=evaluate.rank_importance(models.feature_importance(model, columns, prepared.train)),
        false_positives=outcome.filter("outcome = 'FP'").select(KEY, "probability"),
    )


def search(prepared: Prepared, spec: ModelSpec, grid: dict[str, list], folds: int = 3) -> ModelSpec:
    """The spec with the parameters that a cross-validated search prefers; names are those of BoostedTrees."""
    found = models.search_trees(prepared.train, prepared.features, spec.trees, grid, folds)
    return replace(spec, trees=max(found, key=lambda x: x[1])[0])


def shortlist(prepared: Prepared, spec: ModelSpec, folds: int = 4, top: int | None = None) -> DataFrame:
    """All rows scored out of fold; those of class 0 by falling probability."""
    scores = models.out_of_fold_scores(
        prepared.everything, prepared.features, [KEY], spec.trees, folds
    )
    return evaluate.rank_scores(scores, [KEY], top)
