"""Cleaning expressions for text columns, driven by a small rule table.

Every cast is a ``try_cast``: a bad value becomes null whatever the session's
ANSI setting is.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.schemas import NA_TOKENS, PAYMENT_BEHAVIOUR_CODES

# A plain decimal number: its sign and whole digits. Exponents do not match.
PLAIN_NUMBER = r"^\s*(?<sign>[+-]?)(?=\.?\d)(?<whole>\d*)(\.\d*)?\s*$"


def na_to_null(column: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null for any token that stands for a missing value."""
    return F.when(~column.isin(list(tokens)), column)


def na_to_null_sql(column: str, tokens: Iterable[str] = NA_TOKENS) -> str:
    """The same as a SQL expression, quick to build for tables with many columns."""
    listed = ", ".join(f"'{token}'" for token in tokens)
    return f"CASE WHEN `{column}` NOT IN ({listed}) THEN `{column}` END AS `{column}`"


def sentinel_to_null(column: Column, *sentinels: str) -> Column:
    """Null when the value is one of ``sentinels``."""
    return F.when(~column.isin(list(sentinels)), column)


def strip_text(column: Column, text: str = "_") -> Column:
    """Remove every occurrence of ``text``."""
    return F.replace(column, F.lit(text))


def strip_matches(column: Column, pattern: str) -> Column:
    """Remove every match of a regular expression."""
    return F.regexp_replace(column, pattern, "")


def to_integer(column: Column) -> Column:
    """Text to int, cutting decimals off; anything but a plain number is null.

    Whole numbers take the plain cast; only other text with a decimal point is rewritten to its whole digits.
    """
    whole = F.regexp_replace(column, PLAIN_NUMBER, "${sign}0${whole}")
    return F.coalesce(column.try_cast("int"), F.when(F.contains(column, F.lit(".")), whole.try_cast("int")))


def to_truncated(column: Column) -> Column:
    """Text to float to int: exponents are accepted, decimals are cut off."""
    return F.nanvl(column.try_cast("float"), F.lit(None).cast("float")).try_cast("int")


def to_real(column: Column, dtype: str = "float") -> Column:
    """Text to a floating type with neither bad values nor NaN."""
    return F.nanvl(column.try_cast(dtype), F.lit(None).cast(dtype))


def within(
    column: Column,
    low: float | None = None,
    high: float | None = None,
    above: float | None = None,
) -> Column:
    """Null outside ``low <= x <= high`` and at or below ``above``; open ends are allowed."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (column >= low)
    if high is not None:
        keep = keep & (column <= high)
    if above is not None:
        keep = keep & (column > above)
    return F.when(keep, column)


def valid_or_null(column: Column, allowed: Iterable[str]) -> Column:
    """Null unless the value is one of ``allowed``."""
    return F.when(column.isin(list(allowed)), column)


def list_size(column: Column, separator: str = ",") -> Column:
    """Number of items in a separated text; 0 for null."""
    return F.when(column.isNull(), F.lit(0)).otherwise(F.size(F.split(column, separator)))


def duration_months(column: Column) -> Column:
    """``X Years and Y Months`` as months; null when a part is missing."""
    years = F.regexp_extract(column, r"(\d+) Years", 1).try_cast("int")
    months = F.regexp_extract(column, r"(\d+) Months", 1).try_cast("int")
    return years * 12 + months


@dataclass(frozen=True)
class NumberRule:
    """How to clean one numeric text column."""

    column: str
    dtype: str
    strip: str | None = None
    strip_pattern: str | None = None
    low: float | None = None
    high: float | None = None
    above: float | None = None

    def number(self) -> Column:
        """The typed value, not yet checked."""
        text = F.col(self.column)
        if self.strip:
            text = strip_text(text, self.strip)
        if self.strip_pattern:
            text = strip_matches(text, self.strip_pattern)
        if self.dtype == "int":
            return to_integer(text)
        if self.dtype == "truncated":
            return to_truncated(text)
        return text.try_cast(self.dtype)

    def guarded(self) -> Column:
        """The value of the typed column, null when it is NaN or out of range."""
        column = F.col(self.column)
        if self.dtype == "float":
            column = F.nanvl(column, F.lit(None).cast("float"))
        if (self.low, self.high, self.above) == (None, None, None):
            return column
        return within(column, self.low, self.high, self.above)


# Ranges and stray characters of the numeric columns.
AGE_RULE = NumberRule("Age", "int", strip_pattern="[^0-9]", low=18, high=100)
FINANCIAL_RULES = [
    NumberRule("Annual_Income", "float", strip="_", above=0),
    NumberRule("Monthly_Inhand_Salary", "float"),
    NumberRule("Num_Bank_Accounts", "int", low=0, high=20),
    NumberRule("Num_Credit_Card", "int", low=0, high=50),
    NumberRule("Interest_Rate", "int", low=0, high=100),
    NumberRule("Num_of_Loan", "int", strip="_", low=0, high=50),
    NumberRule("Delay_from_due_date", "int", low=0),
    NumberRule("Num_of_Delayed_Payment", "int", strip="_", low=0, high=100),
    NumberRule("Changed_Credit_Limit", "float", strip="_"),
    NumberRule("Num_Credit_Inquiries", "truncated", low=0, high=100),
    NumberRule("Outstanding_Debt", "float", strip="_"),
    NumberRule("Credit_Utilization_Ratio", "float"),
    NumberRule("Total_EMI_per_month", "float"),
    NumberRule("Amount_invested_monthly", "float", strip="_"),
    NumberRule("Monthly_Balance", "float", strip="_", above=-1_000_000),
]

# Text that means "unknown" in the category columns.
OCCUPATION_UNKNOWN = "_______"
CREDIT_MIX_UNKNOWN = "_"
PAYMENT_OF_MIN_AMOUNT_UNKNOWN = "NM"


ATTRIBUTE_RULES = [AGE_RULE]


def clean_numbers(df: DataFrame, rules: Sequence[NumberRule]) -> DataFrame:
    """Apply number rules in two steps, so that each value is parsed once and then checked."""
    by_name = {rule.column: rule for rule in rules}
    parsed = df.select(
        *[by_name[c].number().alias(c) if c in by_name else F.col(c) for c in df.columns]
    )
    return parsed.select(
        *[by_name[c].guarded().alias(c) if c in by_name else F.col(c) for c in df.columns]
    )


def attribute_categories() -> dict[str, Column]:
    """Cleaned category columns of the attributes."""
    return {"Occupation": sentinel_to_null(F.col("Occupation"), OCCUPATION_UNKNOWN)}


def financial_categories() -> dict[str, Column]:
    """Cleaned category, list and duration columns of the financial records."""
    return {
        "num_loan_types": list_size(F.col("Type_of_Loan")),
        "credit_history_months": duration_months(F.col("Credit_History_Age")),
        "Credit_Mix": sentinel_to_null(F.col("Credit_Mix"), CREDIT_MIX_UNKNOWN),
        "Payment_of_Min_Amount": sentinel_to_null(
            F.col("Payment_of_Min_Amount"), PAYMENT_OF_MIN_AMOUNT_UNKNOWN
        ),
        "Payment_Behaviour": valid_or_null(F.col("Payment_Behaviour"), PAYMENT_BEHAVIOUR_CODES),
    }
