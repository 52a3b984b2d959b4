"""Histograms, PSI and CSI on additive bin counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.quantiles import DECILES, exact_percentiles

SHARE_FLOOR = 1e-6
ROLLING_COHORTS = 3


def unit_edges(n_bins: int) -> list[float]:
    """Edges of equal-width bins on [0, 1], as ``i * (1 / n_bins)`` in binary floats."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def unit_bin(score: Column, n_bins: int) -> Column:
    """Index of the equal-width bin of a score in [0, 1]; 1.0 is in the last bin."""
    inner = unit_edges(n_bins)[1:-1]
    return reduce(add, [F.when(score >= F.lit(edge), 1).otherwise(0) for edge in inner])


def bin_names(n_bins: int, prefix: str = "b") -> list[str]:
    return [f"{prefix}{i}" for i in range(n_bins)]


def bin_index(score: Column, n_bins: int, clip: bool = True) -> Column:
    """Equal-width bin of a score, null for a missing score.

    ``clip`` moves values outside [0, 1] to the end bins; otherwise they have no bin.
    """
    usable = score.isNotNull() & ~F.isnan(score)
    if not clip:
        usable = usable & (score >= 0) & (score <= 1)
    return F.when(usable, unit_bin(score, n_bins))


def bin_counts(index: str, n_bins: int) -> list[Column]:
    """One conditional count per bin, so empty bins count 0 without a join."""
    return [
        F.count(F.when(F.col(index) == i, 1)).alias(name) for i, name in enumerate(bin_names(n_bins))
    ]


def score_profile(
    predictions: DataFrame, by: Sequence[str] = ("snapshot_date",), score: str = "score", n_bins: int = 10
) -> DataFrame:
    """Row count, score mean, population deviation and ``bins`` per cohort, in one aggregate."""
    clean = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    binned = predictions.select(*by, clean.alias("_score")).withColumn(
        "_bin", bin_index(F.col("_score"), n_bins)
    )
    counted = binned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count("_score").alias("n_scores"),
        F.avg("_score").alias("mean_score"),
        F.stddev_pop("_score").alias("std_score"),
        *bin_counts("_bin", n_bins),
    )
    return counted.select(
        *by,
        "n_predictions",
        "n_scores",
        "mean_score",
        "std_score",
        F.array(*bin_names(n_bins)).alias("bins"),
    )


def psi_term(expected: Column, actual: Column) -> Column:
    """(a - e) ln(a / e) with both shares floored."""
    e = F.greatest(expected, F.lit(SHARE_FLOOR))
    a = F.greatest(actual, F.lit(SHARE_FLOOR))
    return (a - e) * F.log(a / e)


def array_total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda total, n: total + n)


def array_shares(counts: Column) -> Column:
    """Counts divided by their sum; all 0 when there are none."""
    total = F.greatest(array_total(counts), F.lit(1)).cast("double")
    return F.transform(counts, lambda n: n.cast("double") / total)


def psi(expected: Column, actual: Column) -> Column:
    """Population stability index of two arrays of bin counts; null when nothing is expected."""
    terms = F.zip_with(array_shares(expected), array_shares(actual), psi_term)
    value = F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)
    return F.when(array_total(expected) > 0, value)


def previous_bins(
    order: str = "snapshot_date",
    by: Sequence[str] = (),
    window: int = ROLLING_COHORTS,
    n_bins: int = 10,
) -> Column:
    """Pooled bin counts of the previous ``window`` cohorts of a per-cohort profile.

    Pooling raw scores is adding up their bin counts, so raw scores are never read again.
    The window runs over one row per cohort.
    """
    previous = Window.partitionBy(*by).orderBy(order).rowsBetween(-window, -1)
    return F.array(
        *[F.coalesce(F.sum(F.col("bins")[i]).over(previous), F.lit(0)) for i in range(n_bins)]
    )


def sample_bins(sample: DataFrame, value: str, n_bins: int = 10) -> DataFrame:
    """One row with the bin counts of a small reference sample."""
    binned = sample.select(bin_index(F.col(value), n_bins).alias("_bin"))
    return binned.agg(*bin_counts("_bin", n_bins)).select(F.array(*bin_names(n_bins)).alias("bins"))


def edge_index(value: Column, edges: Column, top_bin: Column, n_edges: int) -> Column:
    """Bin of ``value`` among ascending ``edges`` that may repeat; null outside them.

    The bin is named by how many edges lie at or below the value, so repeated edges act
    as one. The last edge belongs to ``top_bin``, the bin below it.
    """
    items = [edges[i] for i in range(n_edges)]
    at_or_below = reduce(add, [F.when(value >= e, 1).otherwise(0) for e in items])
    inside = value.isNotNull() & (value >= items[0]) & (value <= items[-1])
    return F.when(inside, F.least(at_or_below, top_bin))


def decile_edges(features: DataFrame) -> DataFrame:
    """``feature, edges``: the 11 deciles of each feature of a long (feature, value) frame."""
    return exact_percentiles(features, ["feature"], "value", DECILES).select(
        "feature", F.col("percentiles").alias("edges")
    )


def feature_bins(
    features: DataFrame, edges: DataFrame, by: Sequence[str] = (), n_edges: int = 11, prefix: str = "k"
) -> DataFrame:
    """``by, feature, n_bins, n`` and one count per bin ``k1, k2, ...``.

    Rows are counted right after the unpivot, before any shuffle. ``n`` counts every value,
    also those outside the edges. ``edges`` has one row per feature, so it is broadcast.
    """
    below_last = F.size(F.filter("edges", lambda e: e < F.element_at("edges", -1)))
    small = edges.select(
        "feature",
        "edges",
        (F.size(F.array_distinct("edges")) - 1).alias("n_bins"),
        below_last.alias("_top_bin"),
    )
    placed = features.join(F.broadcast(small), "feature").select(
        *by,
        "feature",
        "n_bins",
        "value",
        edge_index(F.col("value"), F.col("edges"), F.col("_top_bin"), n_edges).alias("_bin"),
    )
    return placed.groupBy(*by, "feature", "n_bins").agg(
        F.count("value").alias("n"),
        *[F.count(F.when(F.col("_bin") == i, 1)).alias(f"{prefix}{i}") for i in range(1, n_edges)],
    )


def covariate_shift(
    features: DataFrame, edges: DataFrame, by: Sequence[str] = ("snapshot_date",), n_edges: int = 11
) -> DataFrame:
    """``by, feature, csi``: PSI of each feature against equal shares of its decile bins.

    ``features`` is long (by, feature, value). Values outside the edges stay in the
    denominator only; a feature with fewer than 3 different edges has CSI 0.
    """
    counted = feature_bins(features, edges, by, n_edges)
    bins = F.col("n_bins")
    expected = F.lit(1.0) / bins.cast("double")
    n = F.greatest(F.col("n"), F.lit(1)).cast("double")
    counts = [F.col(f"k{i}") for i in range(1, n_edges)]
    occupied = reduce(add, [F.when(c > 0, 1).otherwise(0) for c in counts])
    filled = reduce(
        add,
        [F.when(c > 0, psi_term(expected, c.cast("double") / n)).otherwise(F.lit(0.0)) for c in counts],
    )
    empty = (bins - occupied).cast("double") * psi_term(expected, F.lit(0.0))
    return counted.select(
        *by,
        "feature",
        F.when(bins < 2, F.lit(0.0)).otherwise(F.round(filled + empty, 6)).alias("csi"),
    )


def quantile_psi(
    baseline: DataFrame,
    current: DataFrame,
    by: Sequence[str] = (),
    n_edges: int = 11,
) -> DataFrame:
    """``by, feature, psi`` over decile bins of the baseline values, both sides counted."""
    edges = decile_edges(baseline)
    expected = feature_bins(baseline, edges, (), n_edges, "e").withColumnRenamed("n", "e_n")
    actual = feature_bins(current, edges, by, n_edges, "a").withColumnRenamed("n", "a_n")
    joined = actual.join(F.broadcast(expected), ["feature", "n_bins"])

    def share(side: str, i: int) -> Column:
        total = F.greatest(F.col(f"{side}_n"), F.lit(1)).cast("double")
        return F.col(f"{side}{i}").cast("double") / total

    value = reduce(add, [psi_term(share("e", i), share("a", i)) for i in range(1, n_edges)])
    return joined.select(
        *by, "feature", F.when(F.col("n_bins") < 2, F.lit(0.0)).otherwise(value).alias("psi")
    )
