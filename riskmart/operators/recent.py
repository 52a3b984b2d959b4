"""Last-N questions about small per-month tables.

Each function is an aggregate expression: the months with a value are collected in date
order (one entry per month, so the list is bounded by the calendar).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(column: Column) -> Column:
    """Neither null nor NaN."""
    return column.isNotNull() & ~F.isnan(column)


def latest_entries(entry: Column, condition: Column, n: int) -> Column:
    """Aggregate: the last ``n`` entries by their first field, newest first."""
    kept = F.collect_list(F.when(condition, entry))
    return F.slice(F.sort_array(kept, asc=False), 1, n)


def last_value(value: Column, order: Column, condition: Column) -> Column:
    """Aggregate: value of the latest row that meets ``condition``."""
    return F.max_by(F.when(condition, value), F.when(condition, order))


def mean_of_last(value: Column, order: Column, n: int) -> Column:
    """Aggregate: mean of the last ``n`` present values; null when there is none."""
    entries = latest_entries(F.struct(order.alias("at"), value.alias("v")), present(value), n)
    total = F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["v"])
    return F.when(F.size(entries) > 0, total / F.size(entries))
