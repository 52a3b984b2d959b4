"""As-of join: the whole latest dated record at or before each visit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.schemas import CUSTOMER, MONTH

# A key has fewer dates than this power of two: Spark's calendar has 3.7 million days.
DATE_BITS = 22


def next_month_start(column: Column) -> Column:
    """First month start that is not before the date."""
    return F.when(F.dayofmonth(column) == 1, column).otherwise(
        F.trunc(F.add_months(column, 1), "month")
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Whole row with the greatest ``order`` per key, combined map-side before the shuffle."""
    payload = [c for c in (keep or df.columns) if c not in keys]
    ranked = F.max(F.struct(*order, F.struct(*payload).alias("_row"))).alias("_top")
    return df.groupBy(*keys).agg(ranked).select(*keys, "_top._row.*")


def search_sizes(dates: Column) -> Column:
    """Step sizes of a binary search among ``dates``."""
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(DATE_BITS))])
    return F.filter(powers, lambda size: size <= F.size(dates))


def latest_at(rows: Column, dates: Column, sizes: Column, date: Column) -> Column:
    """Of ``rows`` that hold from the ascending ``dates`` on, the last one that holds at ``date``."""

    def step(place: Column, size: Column) -> Column:
        return F.when(F.get(dates, place + size - 1) <= date, place + size).otherwise(place)

    return F.get(rows, F.aggregate(sizes, F.lit(0), step) - 1)


def asof_latest(
    visits: DataFrame,
    histories: Mapping[str, DataFrame],
    key: str = CUSTOMER,
    date: str = MONTH,
    tiebreak: Sequence[str] = (),
    monthly: bool = True,
) -> DataFrame:
    """Left join to each history's latest record dated at or before the visit.

    A record is taken as a whole, its nulls included. Among records of one date the
    greatest ``tiebreak`` wins, then the greatest remaining columns; tiebreak columns
    are not returned. ``monthly`` says that visits are dated on month starts, so the
    records of a month can be reduced to one before anything else happens.

    Records of all histories are first reduced to one row per (key, date), combined map-side,
    then to one row per key with the records of each history in order of date: at most one per date,
    however hot the key is. Visits are computed and shuffled once, by key, and look their
    records up in that row. The join has unique keys on its right side, and both sides are
    plain shuffles that adaptive execution can split when a key is hot.
    """
    streams = []
    payloads = {}
    for name, history in histories.items():
        ties = [c for c in tiebreak if c in history.columns]
        payloads[name] = [c for c in history.columns if c not in (key, date, *ties)]
        usable_from = next_month_start(F.col(date)) if monthly else F.col(date)
        record = F.struct(F.col(date).alias("_dated"), *ties, F.struct(*payloads[name]).alias("_row"))
        streams.append(
            history.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(
                F.col(key), usable_from.alias(date), record.alias(name)
            )
        )

    moments = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)
        .groupBy(key, date)
        .agg(*[F.max(name).alias(name) for name in histories])
    )
    dated = {name: F.struct(F.col(date).alias("from"), F.col(f"{name}._row").alias("row")) for name in histories}
    # Grouped by a hash, too: rows that lie by key alone would not be shuffled for the join, and only
    # two shuffles made for a join are split.
    known = moments.groupBy(F.hash(key).alias("_hash"), key).agg(
        *[F.sort_array(F.collect_list(F.when(F.col(n).isNotNull(), r))).alias(n) for n, r in dated.items()]
    )
    timeline = known.select(
        key,
        *[
            F.struct(F.col(f"{n}.row").alias("rows"), F.col(f"{n}.from").alias("dates"), search_sizes(F.col(n)).alias("sizes")).alias(f"_{n}")
            for n in histories
        ],
    )
    found = visits.join(timeline, key, "left").select(
        *[F.col(c) for c in visits.columns],
        *[
            latest_at(F.col(f"_{n}.rows"), F.col(f"_{n}.dates"), F.col(f"_{n}.sizes"), F.col(date)).alias(f"_{n}")
            for n in histories
        ],
    )
    others = [c for c in visits.columns if c not in (key, date)]
    return found.select(key, date, *others, *[F.col(f"_{n}.{c}") for n, cs in payloads.items() for c in cs])
