"""Exact-size random samples per group without sorting or collecting the rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE_BITS = 16


def random_place(key: str, seed: int) -> Column:
    """A number from the whole range of longs that depends on the row's unique ``key`` and the seed only."""
    return F.xxhash64(F.col(key), F.lit(seed))


def bottom_k(df: DataFrame, by: str, key: str, sizes: Mapping, seed: int = 0) -> DataFrame:
    """For each value of ``by`` the ``sizes[value]`` rows with the least hash of ``key``; all if there are fewer.

    ``key`` numbers the rows, so equal rows are chosen independently and a retried task chooses
    the same. A histogram of the hashes' first bits, combined before the shuffle, tells how far the wanted
    rows reach; only the rows of the last bucket, one in ``2**PLACE_BITS``, are put in order.
    Values of ``by`` without a size have no rows in the sample.
    """
    place, bucket = random_place(key, seed), F.shiftright(random_place(key, seed), 64 - PLACE_BITS)
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    rows = df.where(F.col(by).isin(list(sizes))).withColumns({"__place": place, "__bucket": bucket})
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("_n"))
    reach = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_wanted", wanted[F.col(by)])
    # One row for each value of ``by``: the bucket in which its sample ends, and how many rows that bucket gives.
    ends = reach.where(F.col("_before") < F.col("_wanted")).groupBy(by).agg(
        F.max(F.struct("__bucket", (F.col("_wanted") - F.col("_before")).alias("left"))).alias("_end")
    )
    cut = rows.join(F.broadcast(ends), by)
    inner = cut.where(F.col("__bucket") < F.col("_end.__bucket"))
    border = cut.where(F.col("__bucket") == F.col("_end.__bucket"))
    order = Window.partitionBy(by).orderBy("__place", key)
    border = border.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("_end.left"))
    return reduce(DataFrame.unionByName, [part.select(*df.columns) for part in (inner, border)])


def proportional(counts: Mapping, total: int) -> dict:
    """``total`` dealt to groups in proportion to their counts, at least one each, none more than it has."""
    everything = sum(counts.values())
    if everything <= total:
        return dict(counts)
    shares = {g: max(1, n * total // everything) for g, n in counts.items() if n}
    by_rest = sorted(shares, key=lambda g: (-(counts[g] * total % everything), str(g)))
    for g in by_rest[: max(0, total - sum(shares.values()))]:
        shares[g] += 1
    largest = max(shares, key=lambda g: (shares[g], str(g)))
    shares[largest] -= max(0, sum(shares.values()) - total)
    return shares
