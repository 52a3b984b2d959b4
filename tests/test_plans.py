"""Physical plans: pushdown, shared shuffles, skew splitting, no single-task work on raw rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from riskmart.catalog import QUERIES
from riskmart.operators.asof import asof_latest
from riskmart.operators.ranking import join_predictions, ranking_metrics
from riskmart.plans.training_data import labelled_dataset

FOLDER = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_slice_reaches_the_scan(spark):
    plan = planned(QUERIES["month_slice_ingest"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>", plan)


def test_label_store_reads_only_its_columns(spark):
    plan = planned(QUERIES["label_store"](spark, FOLDER))
    assert "EqualTo(l_linenumber,6)" in plan or "l_linenumber" in plan
    assert "o_totalprice" not in plan and "l_returnflag" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_and_no_cross_joins(spark, name):
    if name.startswith(("train_", "search_", "calibrate_", "shadow_", "feature_importance")):
        pytest.skip("fits models")
    plan = planned(QUERIES[name](spark, FOLDER))
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ranking_shares_the_score_counts(spark):
    df = spark.range(2000).select(
        (F.col("id") % 5).alias("cohort"), (F.col("id") * 7 % 1000 / 1000).alias("score"), (F.col("id") % 2).alias("label")
    )
    assert "ReusedExchange" in executed(ranking_metrics(df, ["cohort"]))


@pytest.fixture
def small_skew_threshold(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_visits(spark):
    """One customer owns a third of all rows, all of them in one month."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, 60_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("Customer_ID"),
        F.add_months(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("snapshot_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        (F.col("id") % 1000 / 1000).alias("score"),
    )


def test_asof_splits_a_hot_customer(spark, small_skew_threshold):
    history = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("Customer_ID"),
        F.date_sub(F.lit(dt.date(2023, 12, 31)), (F.col("id") % 300).cast("int")).alias("snapshot_date"),
        F.col("id").alias("value"),
    )
    out = asof_latest(hot_visits(spark), {"h": history})
    assert "skew=true" in executed(out)
    assert out.count() == 60_000
    assert out.where("Customer_ID = 'hot' and value is null").count() == 0


def hot_labels(spark):
    return hot_visits(spark).select("Customer_ID", "snapshot_date", F.lit(1).alias("label")).where("score < 0.5")


def test_prediction_join_splits_a_hot_customer(spark, small_skew_threshold):
    out = join_predictions(hot_visits(spark), hot_labels(spark), ["Customer_ID", "snapshot_date"], ["score", "payload"])
    assert "skew=true" in executed(out)


def test_labelled_dataset_splits_a_hot_customer(spark, small_skew_threshold):
    labels = hot_labels(spark).withColumn("snapshot_date", F.add_months("snapshot_date", 6))
    out = labelled_dataset(hot_visits(spark), labels)
    assert "skew=true" in executed(out)
    assert out.where("Customer_ID = 'hot'").count() == 20_000


def scans(spark, name, table):
    """How often the query reads a table, by a column only that table has."""
    column = {"lineitem": "l_orderkey", "orders": "o_orderkey"}[table]
    return len(re.findall(rf"ReadSchema: struct<[^>]*{column}", planned(QUERIES[name](spark, FOLDER))))


@pytest.mark.parametrize("name, times", [("feature_store", 1), ("quality_report", 4), ("labeled_dataset_offset", 2), ("quality_critical_rows", 1)])
def test_visits_are_computed_once(spark, name, times):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        assert scans(spark, name, "lineitem") == times
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)


def test_asof_reads_visits_once(spark):
    visits = spark.range(50).selectExpr("CAST(id % 7 AS STRING) AS Customer_ID", "DATE '2024-01-01' AS snapshot_date", "id AS n")
    history = spark.createDataFrame([("1", dt.date(2023, 12, 5), 4)], "Customer_ID string, snapshot_date date, value int")
    out = asof_latest(visits, {"h": history})
    assert planned(out).count("Range (") == 1
    assert {(r["Customer_ID"], r["value"]) for r in out.collect()} == {(str(i), 4 if i == 1 else None) for i in range(7)}
