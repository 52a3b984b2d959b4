"""Category codes, ratio features and clickstream totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmart.schemas import CATEGORY_CODES


def encode(column: Column, codes: Mapping[str, int]) -> Column:
    """Integer code of a category; null when the category is unknown."""
    branches = iter(codes.items())
    value, code = next(branches)
    expression = F.when(column == value, F.lit(code))
    for value, code in branches:
        expression = expression.when(column == value, F.lit(code))
    return expression


def encoded_categories(columns: Sequence[str]) -> dict[str, Column]:
    """Encodings of those of the known category columns that are present."""
    return {
        name: encode(F.col(name), codes).alias(name)
        for name, codes in CATEGORY_CODES.items()
        if name in columns
    }


def at_least_one(column: Column) -> Column:
    """Raise values below 1 to 1 and keep null (``greatest`` would not)."""
    return F.when(column < 1, F.lit(1.0)).otherwise(column.cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio over a denominator of at least 1."""
    return numerator.cast("double") / at_least_one(denominator)


def ratio_features() -> dict[str, Column]:
    """Leverage, cash-flow and credit-behaviour ratios."""
    debt = F.col("Outstanding_Debt")
    salary = F.col("Monthly_Inhand_Salary")
    emi = F.col("Total_EMI_per_month")
    return {
        "debt_to_income": ratio(debt, F.col("Annual_Income")),
        "emi_to_salary": ratio(emi, salary),
        "debt_per_loan": ratio(debt, F.col("Num_of_Loan")),
        "free_cash_flow_ratio": ratio(salary.cast("double") - emi.cast("double"), salary),
        "savings_rate": ratio(F.col("Amount_invested_monthly"), salary),
        "inquiry_rate": ratio(F.col("Num_Credit_Inquiries"), F.col("credit_history_months")),
    }


def row_total(columns: Sequence[str]) -> Column:
    """Sum over columns, null counting as 0."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def row_positive_count(columns: Sequence[str]) -> Column:
    """Number of columns above 0."""
    return reduce(add, [F.when(F.col(c) > 0, F.lit(1)).otherwise(F.lit(0)) for c in columns])


def engineered_features(columns: Sequence[str]) -> dict[str, Column]:
    """All engineered features; clickstream totals only when ``fe_*`` columns exist."""
    features = ratio_features()
    channels = [c for c in columns if c.startswith("fe_")]
    if channels:
        features["clickstream_total"] = row_total(channels)
        features["clickstream_active_channels"] = row_positive_count(channels)
    return features
