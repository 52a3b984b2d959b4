"""Pooling of adjacent violators in ranges, the part of an isotonic fit that grows with the data."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


Block = tuple[float, float, float, float]


def pool(values: Iterable[tuple[float, float, float]], blocks: list[Block] | None = None) -> list[Block]:
    """Blocks (first, last, target, weight) of ascending (value, target, weight) with rising targets.

    Goes on from the ``blocks`` of smaller values, if given, and changes them.
    """
    blocks = [] if blocks is None else blocks
    for value, target, weight in values:
        blocks.append((value, value, target, weight))
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            (first, _, a, w), (_, last, b, v) = blocks[-2:]
            blocks[-2:] = [(first, last, (a * w + b * v) / (w + v), w + v)]
    return blocks


def pooled_blocks(df: DataFrame, value: str, target: str, weight: str) -> DataFrame:
    """``value, target, weight`` rows that have the isotonic fit of ``df``, but few.

    ``df`` has one row per value. It is cut into ranges of the value, and violators are pooled in
    each; a block is given back as its two ends with half the weight each, so the
    steps keep their limits. Pooling is associative: what is pooled in a range would be in the
    whole. Labels of 0 and 1 leave few blocks, however many rows there are. A task reads its range batch by
    batch and holds its blocks only.
    """

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: list[Block] = []
        for part in parts:
            pool(part.itertuples(index=False, name=None), blocks)
        out = []
        for first, last, mean, total in blocks:
            if first == last:
                out.append((first, mean, total))
            else:
                out += [(first, mean, total / 2), (last, mean, total / 2)]
        yield pd.DataFrame(out, columns=[value, target, weight])

    columns = df.select(*[F.col(c).cast("double").alias(c) for c in (value, target, weight)])
    ranges = columns.repartitionByRange(value).sortWithinPartitions(value)
    return ranges.mapInPandas(ends, f"`{value}` double, `{target}` double, `{weight}` double")
