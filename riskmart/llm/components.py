"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.sources.scratch import drop, keep


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sides`` (u, v) with ``m``, the least of u and its neighbours.

    The minimum is combined before the shuffle and written, so that the join back has two plain
    shuffles and a node with very many neighbours can be split over tasks.
    """
    least = keep(sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return sides.join(least, "u"), least


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for all nodes that have edges.

    ``edges`` are pairs of longs in its first two columns, in any direction, repeated or not.
    Each step only rewires edges to smaller nodes and keeps what is connected; when a round
    changes nothing, every component is a star around its smallest node.
    """
    a, b = edges.columns[:2]
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = keep(now, "edges")
    seen = _fingerprint(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        sides, least = _with_least(both)
        large = keep(sides.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        drop(least, now)
        sides, least = _with_least(large)
        small = sides.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        drop(least, large)
        before, seen = seen, _fingerprint(now)
        if before == seen:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
