"""Quality gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, query, sql_with, table
from riskmart.catalog.datamart import LABELS, STORE, feature_store, label_store
from riskmart.operators.profile import (
    duplicate_rate,
    missing_columns,
    negative_columns,
    null_rates,
    top_null_rates,
)
from riskmart.plans.datamart import distinct_months
from riskmart.plans.quality import empty_partitions
from riskmart.plans.quality import quality_report as build_report
from riskmart.schemas import (
    ATTRIBUTE_COLUMNS,
    CLICKSTREAM_COLUMNS,
    FINANCIAL_COLUMNS,
    REQUIRED_FEATURE_COLUMNS,
)
from riskmart.sources.scratch import keep

STORE_COLUMNS = ["Customer_ID", "snapshot_date", *CLICKSTREAM_COLUMNS, *ATTRIBUTE_COLUMNS, *FINANCIAL_COLUMNS]


def _rates(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM feature_store"
        for c in columns
    )


CTE["null_profile"] = _rates(STORE_COLUMNS)


def null_profile(spark, folder):
    return null_rates(feature_store(spark, folder), STORE_COLUMNS)


@query(
    "null_rate_profile",
    sql_with([*STORE, "null_profile"], "SELECT column_name, round(null_rate, 6) AS null_rate FROM null_profile"),
)
def null_rate_profile(spark, folder):
    return null_profile(spark, folder).withColumn("null_rate", F.round("null_rate", 6))


@query(
    "top_null_rates",
    sql_with(
        [*STORE, "null_profile"],
        """SELECT column_name, round(null_rate, 6) AS null_rate, CASE WHEN null_rate > 0.8 THEN 'fail'
        WHEN null_rate > 0.3 THEN 'warn' ELSE 'ok' END AS mark FROM null_profile
        ORDER BY null_rate DESC, column_name LIMIT 5""",
    ),
)
def top_nulls(spark, folder):
    return top_null_rates(null_profile(spark, folder)).withColumn("null_rate", F.round("null_rate", 6))


@query(
    "duplicate_key_rate",
    """SELECT snapshot_date, round(sum(n - 1) / sum(n), 6) AS duplicate_rate FROM (
    SELECT make_date(CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 1) AS snapshot_date,
    l_orderkey, l_linenumber, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL) GROUP BY snapshot_date""",
)
def duplicate_key_rate(spark, folder):
    from riskmart.functions.loans import month_start

    keys = table(spark, folder, "lineitem").select(
        month_start(F.col("l_shipdate")).alias("snapshot_date"), "l_orderkey", "l_linenumber"
    )
    rates = duplicate_rate(keys, ["l_orderkey", "l_linenumber"], ["snapshot_date"])
    return rates.withColumn("duplicate_rate", F.round("duplicate_rate", 6))


@query(
    "negative_columns",
    """SELECT c_mktsegment, 'c_acctbal' AS column_name, bool_or(c_acctbal < 0) AS has_negative FROM customer
    GROUP BY ALL UNION ALL SELECT c_mktsegment, 'c_custkey', bool_or(c_custkey < 0) FROM customer GROUP BY ALL""",
)
def negatives(spark, folder):
    return negative_columns(table(spark, folder, "customer"), ["c_acctbal", "c_custkey"], ["c_mktsegment"])


@query(
    "required_columns",
    """SELECT 'Age' AS column_name, count(*) AS n_rows FROM customer UNION ALL
    SELECT 'c_phone', count(*) FROM customer""",
)
def required_columns(spark, folder):
    customer = table(spark, folder, "customer")
    absent = missing_columns(customer, ["c_custkey", "Age", "c_acctbal", "c_phone"])
    return customer.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.explode(F.array(*[F.lit(c) for c in absent])).alias("column_name"), "n_rows"
    )


def _report_sql() -> str:
    parts = [
        """SELECT m.snapshot_date, 'feature_partition' AS "check", CAST(NULL AS VARCHAR) AS column_name,
        CAST(coalesce(r.n, 0) AS DOUBLE) AS value, CASE WHEN r.n IS NULL THEN 'warn' ELSE 'ok' END AS severity
        FROM wanted m LEFT JOIN built r ON r.snapshot_date = m.snapshot_date""",
        """SELECT snapshot_date, 'row_count', NULL, CAST(n AS DOUBLE), CASE WHEN n < 10 THEN 'warn' ELSE 'ok' END
        FROM built""",
        """SELECT snapshot_date, 'duplicate_key', 'Customer_ID', 1 - count(DISTINCT Customer_ID) / count(*),
        CASE WHEN 1 - count(DISTINCT Customer_ID) / count(*) > 0.05 THEN 'warn' ELSE 'ok' END
        FROM feature_store GROUP BY ALL""",
        """SELECT snapshot_date, 'null_key', 'Customer_ID', avg(CASE WHEN Customer_ID IS NULL THEN 1.0 ELSE 0.0 END),
        CASE WHEN bool_or(Customer_ID IS NULL) THEN 'warn' ELSE 'ok' END FROM feature_store GROUP BY ALL""",
        """SELECT snapshot_date, 'default_rate', 'label', avg(CAST(label AS DOUBLE)),
        CASE WHEN avg(label) = 0 OR avg(label) > 0.8 THEN 'warn' ELSE 'ok' END FROM label_store GROUP BY ALL""",
    ]
    for column in STORE_COLUMNS:
        if column != "snapshot_date":
            rate = f"avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END)"
            parts.append(
                f"""SELECT snapshot_date, 'null_rate', '{column}', {rate},
                CASE WHEN {rate} > 0.3 THEN 'warn' ELSE 'ok' END FROM feature_store GROUP BY ALL"""
            )
    for column in CLICKSTREAM_COLUMNS:
        test = f"coalesce(bool_or({column} < 0), false)"
        parts.append(
            f"""SELECT snapshot_date, 'negative_values', '{column}', CAST(CAST({test} AS INT) AS DOUBLE),
            CASE WHEN {test} THEN 'warn' ELSE 'ok' END FROM feature_store GROUP BY ALL"""
        )
    return " UNION ALL ".join(parts)


CTE["wanted"] = "SELECT DISTINCT snapshot_date FROM label_store"
CTE["built"] = "SELECT snapshot_date, count(*) AS n FROM feature_store WHERE snapshot_date IN (FROM wanted) GROUP BY ALL"
CTE["report"] = _report_sql()


@query(
    "quality_report",
    sql_with(
        [*STORE, *LABELS, "wanted", "built", "report"],
        """SELECT snapshot_date, "check", column_name, round(value, 6) AS value, severity FROM report
        WHERE snapshot_date IN (FROM wanted)""",
    ),
)
def quality_report(spark, folder):
    labels = label_store(spark, folder)
    report = build_report(
        feature_store(spark, folder), labels, distinct_months(labels), REQUIRED_FEATURE_COLUMNS, one_pass=True
    )
    return report.withColumn("value", F.round("value", 6))


@query(
    "quality_critical_rows",
    sql_with(
        [*STORE, *LABELS, "wanted", "built"],
        """SELECT snapshot_date, 'required_column' AS "check", 'Age' AS column_name, CAST(0 AS DOUBLE) AS value, 'critical' AS severity
        FROM built UNION ALL
        SELECT snapshot_date, 'empty_partition', NULL, CAST(0 AS DOUBLE), 'critical' FROM wanted
        WHERE snapshot_date NOT IN (SELECT snapshot_date FROM built)""",
    ),
)
def quality_critical_rows(spark, folder):
    """A store without a required column, and label months for which no features were written."""
    labels, features = label_store(spark, folder), feature_store(spark, folder)
    months = distinct_months(labels)
    report = keep(build_report(features.drop("Age"), labels, months, REQUIRED_FEATURE_COLUMNS, one_pass=True), "report")
    # The months that features have, from the few rows of the report: the store is not computed again.
    built = report.where("check = 'row_count'")
    report = report.unionByName(empty_partitions(months, built))
    return report.where("severity = 'critical'")
