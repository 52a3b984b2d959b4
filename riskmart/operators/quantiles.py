"""Exact percentiles with linear interpolation, distributed.

``percentile`` keeps every distinct value of a group in one buffer. Here a histogram over
balanced ranges of the values finds where the wanted ranks lie, and only the rows of those
ranges are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.operators.running import beside, bucket_offsets, with_range

DECILES = [i / 10 for i in range(11)]
# Ranges a group's values are cut into.
PERCENTILE_RANGES = 1024
PERCENTILES_1_99 = [i / 100 for i in range(1, 100)]


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    ranges: int = PERCENTILE_RANGES,
    weight: str | None = None,
    few_groups: bool = True,
) -> DataFrame:
    """``percentiles`` (array in the order of ``probabilities``) and ``n`` per group.

    A row with integer ``weight`` w counts as w equal rows.

    A group's splitters, and its ranges that hold a wanted rank (at most ``2 * len(probabilities)``),
    are broadcast; with ``few_groups=False`` they are joined and there may be any number of groups.
    """
    spark_probabilities = F.array(*[F.lit(float(p)) for p in probabilities])
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    for name in by:
        usable = usable.where(F.col(name).isNotNull())
    values = usable.select(
        *by,
        F.col(value).cast("double").alias("_value"),
        (F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")).alias("_weight"),
    ).where(F.col("_weight") > 0)
    bucketed = with_range(values, by, "_value", ranges, few_groups)
    groups = list(by)
    if not groups:
        groups = ["_all"]
        bucketed = bucketed.withColumn("_all", F.lit(0))

    def ranks(n: Column) -> Column:
        positions = F.transform(spark_probabilities, lambda p: p * (n - 1))
        lower = F.transform(positions, lambda x: F.floor(x).cast("bigint"))
        upper = F.transform(positions, lambda x: F.ceil(x).cast("bigint"))
        return F.array_distinct(F.concat(lower, upper))

    def ranks_within(n: Column, start: Column, size: Column) -> Column:
        return F.filter(ranks(n), lambda r: (r >= start) & (r < start + size))

    counts = bucketed.groupBy(*groups, "_bucket").agg(F.sum("_weight").alias("n"))
    start = F.col("before_n")
    end = start + F.col("bucket_n")

    def in_bucket(rank: Column) -> Column:
        return (rank >= start) & (rank < end)

    last = F.col("total_n") - 1
    holds_a_rank = F.exists(
        spark_probabilities, lambda p: in_bucket(F.floor(p * last)) | in_bucket(F.ceil(p * last))
    )
    located = (
        bucket_offsets(counts, groups, ["n"])
        .where(holds_a_rank)
        .select(*groups, "_bucket", F.col("before_n").alias("_start"), F.col("total_n").alias("_n"))
    )

    inside = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first_rank = F.col("_start") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    picked = (
        beside(bucketed, located, [*groups, "_bucket"], few_groups)
        .groupBy(*groups, "_bucket", "_value")
        .agg(
            F.sum("_weight").alias("_copies"),
            F.max("_start").alias("_start"),
            F.max("_n").alias("_n"),
        )
        .withColumn("_rank", first_rank)
        .withColumn("_hits", ranks_within(F.col("_n"), F.col("_rank"), F.col("_copies")))
        .select(*groups, "_n", "_value", F.explode("_hits").alias("_at"))
    )
    by_rank = picked.groupBy(*groups).agg(
        F.max("_n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("_at", "_value"))).alias("_values"),
    )

    def interpolate(p):
        position = p * (F.col("n") - 1)
        low = F.element_at("_values", F.floor(position).cast("bigint"))
        high = F.element_at("_values", F.ceil(position).cast("bigint"))
        share = position - F.floor(position)
        return F.when(share == 0, low).otherwise((F.lit(1.0) - share) * low + share * high)

    return by_rank.select(*by, F.transform(spark_probabilities, interpolate).alias("percentiles"), "n")


def exact_medians(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """``median`` per group."""
    halves = exact_percentiles(df, by, value, [0.5], weight=weight)
    return halves.select(*by, F.element_at("percentiles", 1).alias("median"))


def long_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot feature columns to (keep, feature, value) with double values, NaN as null."""
    missing = F.lit(None).cast("double")
    casted = df.select(
        *keep, *[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in features]
    )
    return casted.unpivot(list(keep), list(features), "feature", "value")


def moments(df: DataFrame, by: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """``n, mean, squares`` per group, ``squares`` being the summed squared distance to the mean.

    A row with integer ``weight`` w counts as w equal rows. ``by`` must be a bounded set of
    groups: with weights their means are broadcast for a second pass.
    """
    usable = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if weight is None:
        n = F.count(F.lit(1))
        return usable.groupBy(*by).agg(
            n.alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * n).alias("squares")
        )
    w = F.col(weight)
    means = usable.groupBy(*by).agg((F.sum(F.col(value) * w) / F.sum(w)).alias("_mean"))
    if by:
        centred = usable.join(F.broadcast(means), list(by))
    else:
        centred = usable.withColumn("_mean", means.scalar())
    distance = F.col(value) - F.col("_mean")
    return centred.groupBy(*by).agg(
        F.sum(w).alias("n"), F.max("_mean").alias("mean"), F.sum(distance * distance * w).alias("squares")
    )
