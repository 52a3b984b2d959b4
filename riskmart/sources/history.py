"""Dated histories: the records landed so far, and the latest one of each customer carried from month to month.

Records lie by landing and by the month start they can first be used in. What is carried names the
month it holds and the last landing it has taken in, so the records it lacks are whole folders: later landings,
whatever their date, and later months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators.asof import latest_per_key, next_month_start
from riskmart.schemas import CUSTOMER, MONTH
from riskmart.sources import readers, writers

LANDED = "landed"
USABLE = "usable_from"
# Month and last landing of what is carried, as one partition column "2024-07-01 12".
THROUGH = "through"


def landings(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the landings a history consists of, ascending."""
    readers.settle(spark, path)
    return sorted(int(v) for v in readers.partition_values(spark, path, LANDED))


def land(records: DataFrame, path: str, whole: bool = False) -> None:
    """Add records as a landing of its own; ``whole`` replaces all earlier ones.

    Numbers always go up, so that what was carried from replaced landings is known as outdated.
    """
    number = max(landings(records.sparkSession, path), default=0) + 1
    placed = records.withColumns({LANDED: F.lit(number), USABLE: next_month_start(F.col(MONTH))}).hint("rebalance", USABLE)
    if whole:
        writers.write_static(placed, path, by=[LANDED, USABLE])
    else:
        placed.write.mode("append").partitionBy(LANDED, USABLE).parquet(path)


@dataclass
class History:
    """One history with what is carried of it; ``prepare`` is applied to records before they are compared."""

    spark: SparkSession
    path: str
    carried: str
    prepare: Callable[[DataFrame], DataFrame]

    def __post_init__(self) -> None:
        self.landed = landings(self.spark, self.path)

    def through(self) -> tuple[dt.date, int] | None:
        """Month and last landing of what is carried; None when nothing is or its landings were replaced."""
        readers.settle(self.spark, self.carried)
        for value in readers.partition_values(self.spark, self.carried, THROUGH):
            month, landing = value.split(" ")
            if self.landed and self.landed[0] <= int(landing):
                return dt.date.fromisoformat(month), int(landing)
        return None

    def records(self, months: Sequence[dt.date]) -> DataFrame:
        """Records with the same latest ones at each of ``months`` as the whole history has.

        The landings are those known when this object was made. Records without customer or date are left out.
        """
        rows = self.spark.read.parquet(self.path)
        usable = F.col(USABLE).try_cast("date")
        rows = rows.where(F.col(LANDED).isin(self.landed) & (usable <= F.lit(max(months))))
        through = self.through()
        if through is None or min(months) < through[0]:
            return self._prepared(rows)
        month, landing = through
        lacking = self._prepared(rows.where((F.col(LANDED) > landing) | (usable > F.lit(month))))
        return self.spark.read.parquet(self.carried).drop(THROUGH).unionByName(lacking)

    def carry(self, month: dt.date) -> bool:
        """Move what is carried on to ``month``; never back. Says if it did."""
        through = self.through()
        if not self.landed or (through is not None and (month, self.landed[-1]) <= through):
            return False
        if through is not None and month < through[0]:
            return False
        latest = latest_per_key(self.records([month]), [CUSTOMER], [MONTH])
        value = F.lit(f"{month} {self.landed[-1]}")
        writers.write_static(latest.withColumn(THROUGH, value), self.carried, by=[THROUGH])
        return True

    def _prepared(self, rows: DataFrame) -> DataFrame:
        known = rows.where(F.col(CUSTOMER).isNotNull() & F.col(MONTH).isNotNull())
        return self.prepare(known.drop(LANDED, USABLE))
