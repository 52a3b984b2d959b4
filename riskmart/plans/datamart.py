"""Raw to silver to gold, all months in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions import cleaning, features, loans
from riskmart.operators.asof import asof_latest
from riskmart.schemas import (
    ATTRIBUTE_COLUMNS,
    CLICKSTREAM_COLUMNS,
    CUSTOMER,
    DPD,
    FINANCIAL_COLUMNS,
    LOAN_TYPES,
    MOB,
    MONTH,
)


def normalise_text(raw: DataFrame) -> DataFrame:
    """Bronze of an all-text extract: missing-value tokens become null."""
    text = [name for name, dtype in raw.dtypes if dtype == "string"]
    return raw.selectExpr(
        *[cleaning.na_to_null_sql(c) if c in text else f"`{c}`" for c in raw.columns]
    )


def silver_loans(bronze: DataFrame) -> DataFrame:
    """Typed loan months with month on book, missed installments and days past due."""
    text = {name for name, dtype in bronze.dtypes if dtype == "string"}

    def typed(name: str, dtype: str) -> Column:
        if dtype == "int" and name in text:
            return cleaning.to_integer(F.col(name))
        return F.col(name).try_cast(dtype)

    columns = bronze.select(
        *[typed(c, t).alias(c) for c, t in LOAN_TYPES.items()],
        typed("installment_num", "int").alias("mob"),
    )
    missed = loans.installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    filled = columns.withColumn("installments_missed", missed).na.fill(0)
    dated = filled.withColumn(
        "first_missed_date", loans.first_missed_date(F.col(MONTH), F.col("installments_missed"))
    )
    return dated.withColumn(
        "dpd", loans.days_past_due(F.col("overdue_amt"), F.col(MONTH), F.col("first_missed_date"))
    )


def label_store(silver: DataFrame, dpd: int = DPD, mob: int = MOB) -> DataFrame:
    """Default labels of the loans that are ``mob`` months on book."""
    return silver.where(F.col("mob") == mob).select(
        "loan_id",
        CUSTOMER,
        loans.default_label(F.col("dpd"), dpd).alias("label"),
        F.lit(loans.label_definition(dpd, mob)).alias("label_def"),
        MONTH,
        F.add_months(MONTH, -mob).alias("origination_date"),
    )


def silver_clickstream(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed clickstream."""
    return bronze.select(
        *[cleaning.to_integer(F.col(c)).alias(c) for c in CLICKSTREAM_COLUMNS],
        F.col(CUSTOMER).cast("string").alias(CUSTOMER),
        F.col(MONTH).try_cast("date").alias(MONTH),
        *keep,
    )


def silver_attributes(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean attributes without names and social security numbers."""
    return silver_records(
        bronze, ATTRIBUTE_COLUMNS, cleaning.ATTRIBUTE_RULES, cleaning.attribute_categories(), keep
    )


def silver_financials(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean financial records."""
    return silver_records(
        bronze, FINANCIAL_COLUMNS, cleaning.FINANCIAL_RULES, cleaning.financial_categories(), keep
    )


def silver_records(
    bronze: DataFrame,
    columns: Sequence[str],
    rules: Sequence[cleaning.NumberRule],
    categories: Mapping[str, Column],
    keep: Sequence[str],
) -> DataFrame:
    """Dated customer records with the given columns, cleaned."""
    cleaned = bronze.select(
        F.col(CUSTOMER).cast("string").alias(CUSTOMER),
        *[(categories[c] if c in categories else F.col(c)).alias(c) for c in columns],
        F.col(MONTH).try_cast("date").alias(MONTH),
        *keep,
    )
    return cleaning.clean_numbers(cleaned, rules)


def encoded_history(history: DataFrame) -> DataFrame:
    """Dated records with their categories as codes."""
    codes = features.encoded_categories(history.columns)
    return history.select(*[codes.get(c, F.col(c)) for c in history.columns])


def feature_store(
    clickstream: DataFrame,
    attributes: DataFrame | None,
    financials: DataFrame | None,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Visitors with their latest attributes and financials as of the month, encoded.

    The histories are encoded before the as-of join, so that integers are shuffled and not
    category names.
    """
    histories = {}
    for name, history in (("attributes", attributes), ("financials", financials)):
        if history is not None:
            histories[name] = encoded_history(history)
    if not histories:
        return clickstream
    return asof_latest(clickstream, histories, tiebreak=tiebreak)


def with_engineered(store: DataFrame) -> DataFrame:
    """Add ratio features and clickstream totals."""
    return store.withColumns(features.engineered_features(store.columns))


def missing_months(wanted: DataFrame, existing: DataFrame, month: str = MONTH) -> DataFrame:
    """Months that are wanted and not yet built."""
    have = existing.select(month).distinct()
    return wanted.select(month).where(F.col(month).isNotNull()).distinct().join(have, month, "left_anti")


def distinct_months(df: DataFrame, month: str = MONTH) -> DataFrame:
    return df.select(month).where(F.col(month).isNotNull()).distinct()
