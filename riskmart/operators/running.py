"""Running sums over an ordered value without putting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Ranges a group's values are cut into for running sums.
RUNNING_RANGES = 256
# The quantile sketch is as fine as this share of a range.
SKETCH_DETAIL = 10


def splitters(df: DataFrame, by: Sequence[str], value: str, ranges: int) -> DataFrame:
    """``_splitters`` per ``by``: the values that cut the group's rows into about equal parts.

    They come from a quantile sketch that tasks merge, so they follow the data: values packed
    around one number are cut as finely as others.
    """
    ranges = max(ranges, 2)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    sketch = F.percentile_approx(F.col(value).cast("double"), shares, SKETCH_DETAIL * ranges)
    return df.groupBy(*by).agg(sketch.alias("_splitters"))


def search_steps(ranges: int) -> list[int]:
    """Step sizes of a binary search among ``ranges``."""
    return [1 << i for i in reversed(range((max(ranges, 2) - 1).bit_length()))]


def range_of(value: Column, cuts: Column, ranges: int) -> Column:
    """How many of the ascending ``cuts`` are at most ``value``, by binary search.

    Never decreases as ``value`` grows, so equal values share a range and ranges split the
    ordering exactly, wherever the cuts lie. Never null: a nullable join key would get an extra
    filter on one side only, and two uses of the same counts could then not share their shuffle.
    """
    steps = F.array(*map(F.lit, search_steps(ranges)))

    def step(low: Column, size: Column) -> Column:
        return F.when(F.get(cuts, low + size - 1) <= value.cast("double"), low + size).otherwise(low)

    return F.coalesce(F.aggregate(steps, F.lit(0), step).cast("bigint"), F.lit(0).cast("bigint"))


def beside(df: DataFrame, small: DataFrame, keys: Sequence[str], few_groups: bool) -> DataFrame:
    """``df`` joined to a table with a bounded number of rows per group.

    It is broadcast when the caller knows the groups to be few, as features or months are; otherwise
    both sides are shuffled, and adaptive execution may split a hot group.
    """
    return df.join(F.broadcast(small) if few_groups else small, list(keys))


def with_range(df: DataFrame, by: Sequence[str], value: str, ranges: int, few_groups: bool = True) -> DataFrame:
    """``df`` with ``_bucket``, the balanced range that ``value`` lies in among the rows of ``by``.

    Groups must not be null. The search is that of ``range_of``, a column for each step: such steps are compiled, while
    a higher-order function is interpreted for every value.
    """
    cuts = splitters(df, by, value, ranges)
    located = beside(df, cuts, by, few_groups) if by else df.withColumn("_splitters", cuts.scalar())
    low, number = F.col("_bucket"), F.col(value).cast("double")
    located = located.withColumn("_bucket", F.lit(0))
    for size in search_steps(ranges):
        higher = F.get("_splitters", low + F.lit(size - 1)) <= number
        located = located.withColumn("_bucket", F.when(higher, low + F.lit(size)).otherwise(low))
    return located.select(*df.columns, low.cast("bigint").alias("_bucket"))


def bucket_offsets(
    bucketed: DataFrame, by: Sequence[str], sums: Sequence[str], bucket: str = "_bucket"
) -> DataFrame:
    """Per (by, bucket): its own ``bucket_x``, ``before_x`` (lower buckets), ``total_x`` (all of ``by``)."""
    totals = bucketed.groupBy(*by, bucket).agg(*[F.sum(c).alias(c) for c in sums])
    whole = Window.partitionBy(*by)
    before = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        bucket,
        *[F.col(c).alias(f"bucket_{c}") for c in sums],
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
    )


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Sequence[str],
    ranges: int = RUNNING_RANGES,
    few_groups: bool = True,
) -> DataFrame:
    """Add ``below_x`` and ``total_x`` for each summed column.

    ``df`` has one row per (by, value). The ordering is cut into balanced ranges: a window
    runs inside each range, and a second one over their totals gives the offsets. A
    large group is spread over its ranges, and equal values are one row already. With
    ``few_groups=False`` there may be any number of groups.
    """
    bucketed = with_range(df, by, value, ranges, few_groups)
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = bucketed.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_in_{c}") for c in sums]
    )
    return local.join(bucket_offsets(bucketed, by, sums), [*by, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"before_{c}") + F.col(f"_in_{c}")).alias(f"below_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )
