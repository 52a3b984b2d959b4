"""The quality gate."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskmart.plans import quality
from riskmart.schemas import REQUIRED_FEATURE_COLUMNS

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def store(spark, rows, drop=()):
    """rows of (month, customer, fe_1, income)."""
    df = spark.createDataFrame(rows, "snapshot_date date, Customer_ID string, fe_1 int, Annual_Income float")
    for c in REQUIRED_FEATURE_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(1))
    return df.drop(*drop)


def found(report, *severities):
    return {(r["snapshot_date"], r["check"], r["column_name"]) for r in report.where(F.col("severity").isin(*severities)).collect()}


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "snapshot_date date, label int")


def months(spark, *wanted):
    return spark.createDataFrame([(m,) for m in wanted], "snapshot_date date")


def test_clean_month_passes(spark):
    rows = [(JAN, f"c{i}", i, 1.0) for i in range(20)]
    report = quality.quality_report(store(spark, rows), labels(spark, [(JAN, 0), (JAN, 1)]), months(spark, JAN))
    assert found(report, "critical", "warn") == set()
    quality.require_passed(report)


def test_warnings(spark):
    rows = [(JAN, f"c{i % 4}", -1 if i == 3 else None, None if i < 6 else 1.0) for i in range(7)]
    rows[0] = (JAN, None, 1, None)
    report = quality.quality_report(
        store(spark, rows), labels(spark, [(JAN, 0), (JAN, 0), (FEB, 1), (MAR, 1)]), months(spark, JAN, FEB)
    )
    assert found(report, "critical") == set()
    assert found(report, "warn") == {
        (JAN, "row_count", None),
        (JAN, "null_rate", "Annual_Income"),
        (JAN, "null_rate", "fe_1"),
        (JAN, "negative_values", "fe_1"),
        (JAN, "duplicate_key", "Customer_ID"),
        (JAN, "null_key", "Customer_ID"),
        (JAN, "default_rate", "label"),
        (FEB, "feature_partition", None),
        (FEB, "default_rate", "label"),
    }
    quality.require_passed(report)


def test_missing_column_is_critical(spark):
    rows = [(JAN, f"c{i}", i, 1.0) for i in range(20)]
    report = quality.quality_report(store(spark, rows, drop=["Age"]), labels(spark), months(spark, JAN))
    assert found(report, "critical") == {(JAN, "required_column", "Age")}
    with pytest.raises(quality.QualityGateError, match="Age"):
        quality.require_passed(report)


def test_empty_partition_is_critical(spark):
    empty = quality.empty_partitions(months(spark, JAN, FEB), store(spark, [(JAN, "c", 1, 1.0)]))
    assert found(empty, "critical") == {(FEB, "empty_partition", None)}
    no_labels = quality.empty_partitions(months(spark, JAN), labels(spark), "empty_label_partition")
    assert found(no_labels, "warn") == {(JAN, "empty_label_partition", None)}


def test_one_pass_finds_the_same_and_reads_once(spark):
    rows = spark.range(60).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL ELSE add_months(DATE '2024-01-01', CAST(id % 2 AS INT)) END AS snapshot_date",
        "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('c', id % 13) END AS Customer_ID",
        "CAST(IF(id % 3 = 0, NULL, id - 9) AS INT) AS fe_1",
        "CASE WHEN id % 7 = 0 THEN float('NaN') ELSE CAST(id AS FLOAT) END AS Annual_Income",
    )
    wanted = months(spark, JAN, FEB, MAR)
    two, one = (quality.feature_findings(rows, wanted, one_pass=o) for o in (False, True))
    assert one._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert found(one, "warn") >= {(JAN, "duplicate_key", "Customer_ID"), (FEB, "duplicate_key", "Customer_ID")}
