"""Labelled dataset, temporal split and training statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.operators.quantiles import (
    DECILES,
    PERCENTILES_1_99,
    exact_percentiles,
    long_features,
    moments,
)
from riskmart.schemas import CUSTOMER, FEATURE_COLUMNS, MOB, MONTH

TRAIN_END = "2023-12-01"
TEST_END = "2024-03-01"
MIN_TRAIN_ROWS = 50
MIN_SPLIT_ROWS = 10


def labelled_dataset(features: DataFrame, labels: DataFrame, offset_months: int = MOB) -> DataFrame:
    """Features of month M - offset joined to the labels measured in month M.

    Several labels of one customer and month are combined first: each feature row comes out
    once per label value, with ``weight`` label rows behind it.
    """
    weighted = labels.where(F.col(MONTH).isNotNull()).groupBy(
        CUSTOMER,
        F.add_months(MONTH, -offset_months).alias("feature_snapshot_date"),
        F.col("label").cast("int").alias("label"),
    ).agg(F.count(F.lit(1)).alias("weight"))
    dated = features.withColumn("feature_snapshot_date", F.col(MONTH))
    return dated.join(weighted, [CUSTOMER, "feature_snapshot_date"])


def expand_weights(dataset: DataFrame) -> DataFrame:
    """Repeat every row ``weight`` times, as a plain row join would."""
    return dataset.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("weight")))).drop(
        "_copy", "weight"
    )


def scoring_features(features: DataFrame, offset_months: int = MOB) -> DataFrame:
    """Features of month M - offset stamped with the scoring month M."""
    return features.withColumn(MONTH, F.add_months(MONTH, offset_months))


def split_name(date: Column, train_end: str = TRAIN_END, test_end: str = TEST_END) -> Column:
    """train / test / oot by feature month."""
    return (
        F.when(date <= F.lit(train_end).cast("date"), "train")
        .when(date <= F.lit(test_end).cast("date"), "test")
        .when(date.isNotNull(), "oot")
    )


def split_stats(
    dataset: DataFrame, date: str = "feature_snapshot_date", weight: Column | None = None
) -> DataFrame:
    """First and last month, rows and label prevalence per split."""
    w = weight if weight is not None else F.lit(1)
    return dataset.groupBy("split").agg(
        F.min(date).alias("first_month"),
        F.max(date).alias("last_month"),
        F.sum(w).cast("bigint").alias("n_rows"),
        (F.sum(F.col("label") * w).cast("double") / F.sum(w).cast("double")).alias("prevalence"),
    )


def available_features(columns: Sequence[str], excluded: Sequence[str] = ()) -> list[str]:
    """Model features that are present and not excluded, in model order."""
    return [c for c in FEATURE_COLUMNS if c in columns and c not in excluded]


def class_weights(dataset: DataFrame, label: str = "label") -> DataFrame:
    """One row: class counts, balanced class weights and the negative-to-positive ratio."""
    counts = dataset.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n_neg"),
        F.count(F.when(F.col(label) == 1, 1)).alias("n_pos"),
    )
    n = (F.col("n_neg") + F.col("n_pos")).cast("double")
    return counts.select(
        "n_neg",
        "n_pos",
        F.try_divide(n, 2.0 * F.col("n_neg")).alias("weight_neg"),
        F.try_divide(n, 2.0 * F.col("n_pos")).alias("weight_pos"),
        (F.col("n_neg").cast("double") / F.greatest(F.col("n_pos"), F.lit(1))).alias("scale_pos_weight"),
    )


def feature_baseline(
    dataset: DataFrame, features: Sequence[str], weight: str | None = None
) -> DataFrame:
    """``feature, mean, std, percentiles``: sample deviation and the deciles p0 to p100."""
    values = long_features(dataset, features, [weight] if weight else [])
    spread = moments(values, ["feature"], "value", weight).select(
        "feature", "mean", F.sqrt(F.try_divide(F.col("squares"), F.col("n") - 1)).alias("std")
    )
    deciles = exact_percentiles(values, ["feature"], "value", DECILES, weight=weight)
    return spread.join(deciles.select("feature", "percentiles"), "feature", "left")


def score_distribution(scores: DataFrame, score: str = "score", weight: str | None = None) -> DataFrame:
    """One row ``n, mean, std, percentiles``: population deviation and p1 to p99 of the scores."""
    spread = moments(scores, [], score, weight).select(
        "n", "mean", F.sqrt(F.try_divide(F.col("squares"), F.col("n"))).alias("std")
    )
    percentiles = exact_percentiles(scores, [], score, PERCENTILES_1_99, weight=weight)
    return spread.withColumn("percentiles", percentiles.select("percentiles").scalar())
