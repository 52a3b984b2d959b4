"""Column profiles and key checks for the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NULL_WARN = 0.30
NULL_FAIL = 0.80


def null_rate_sql(df: DataFrame, column: str) -> str:
    """Share of null values, and of NaN in a floating column, as a SQL aggregate."""
    missing = f"`{column}` IS NULL"
    if df.schema[column].dataType.typeName() in ("float", "double"):
        missing += f" OR isnan(`{column}`)"
    return f"avg(CASE WHEN {missing} THEN 1.0D ELSE 0.0D END)"


def null_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, column_name, null_rate``: one aggregate over all columns, unpivoted afterwards."""
    wide = df.groupBy(*by).agg(*[F.expr(null_rate_sql(df, c)).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column_name", "null_rate")


def null_mark(rate: Column) -> Column:
    """fail / warn / ok display mark of a null rate."""
    return F.when(rate > NULL_FAIL, "fail").when(rate > NULL_WARN, "warn").otherwise("ok")


def top_null_rates(rates: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` columns with the highest null rate, marked."""
    return (
        rates.orderBy(F.desc("null_rate"), "column_name")
        .limit(n)
        .withColumn("mark", null_mark(F.col("null_rate")))
    )


def duplicate_rate(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, duplicate_rate``: share of rows beyond the first of their key, null being a key."""
    copies = df.groupBy(*by, *[c for c in key if c not in by]).agg(F.count(F.lit(1)).alias("_n"))
    rate = F.try_divide(F.sum(F.col("_n") - 1).cast("double"), F.sum("_n").cast("double"))
    return copies.groupBy(*by).agg(rate.alias("duplicate_rate"))


def first_of_key(key: Sequence[str]) -> Column:
    """True for one row of each key, null being a key."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(key[-1])) == 1


def any_negative_sql(column: str) -> str:
    """True when a value is below 0, as a SQL aggregate; nulls are ignored."""
    return f"coalesce(bool_or(`{column}` < 0), false)"


def negative_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, column_name, has_negative``."""
    wide = df.groupBy(*by).agg(*[F.expr(any_negative_sql(c)).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column_name", "has_negative")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the frame lacks, in the required order."""
    return [c for c in required if c not in df.columns]
