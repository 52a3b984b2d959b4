"""Loan, label and feature store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, clickstream, loan_tape, month_of, query, sql_with, table
from riskmart.catalog.cleaning import ATTRIBUTES, FINANCIALS, silver_attributes, silver_financials
from riskmart.functions.loans import month_start
from riskmart.operators.asof import asof_latest, latest_per_key
from riskmart.plans import datamart, training_data
from riskmart.schemas import (
    ATTRIBUTE_COLUMNS,
    CATEGORY_CODES,
    CLICKSTREAM_COLUMNS,
    ENGINEERED_COLUMNS,
    FINANCIAL_COLUMNS,
)

TRAIN_END = "1998-06-01"
TEST_END = "1999-12-01"

CTE["typed_loans"] = """SELECT loan_id, Customer_ID, loan_start_date,
  coalesce(tenure, 0) AS tenure, coalesce(installment_num, 0) AS installment_num,
  coalesce(CAST(loan_amt AS FLOAT), 0) AS loan_amt, coalesce(CAST(due_amt AS FLOAT), 0) AS due_amt,
  coalesce(CAST(paid_amt AS FLOAT), 0) AS paid_amt, coalesce(CAST(overdue_amt AS FLOAT), 0) AS overdue_amt,
  coalesce(CAST(balance AS FLOAT), 0) AS balance, snapshot_date, coalesce(installment_num, 0) AS mob,
  coalesce(CAST(CASE WHEN CAST(due_amt AS FLOAT) = 0 THEN 0
    ELSE ceil(CAST(CAST(overdue_amt AS FLOAT) AS DOUBLE) / CAST(CAST(due_amt AS FLOAT) AS DOUBLE)) END AS INT), 0)
    AS installments_missed FROM loan_tape"""
CTE["dated_loans"] = """SELECT *, CASE WHEN installments_missed > 0
  THEN CAST(snapshot_date - installments_missed * INTERVAL 1 MONTH AS DATE) END AS first_missed_date FROM typed_loans"""
CTE["silver_loans"] = """SELECT *, CAST(CASE WHEN overdue_amt > 0
  THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS INT) AS dpd FROM dated_loans"""
CTE["label_store"] = """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
  '30dpd_6mob' AS label_def, snapshot_date, CAST(snapshot_date - INTERVAL 6 MONTH AS DATE) AS origination_date
  FROM silver_loans WHERE mob = 6"""
LOANS = ["loan_tape", "typed_loans", "dated_loans", "silver_loans"]
LABELS = [*LOANS, "label_store"]


def _code(column: str) -> str:
    whens = " ".join(f"WHEN '{value}' THEN {code}" for value, code in CATEGORY_CODES[column].items())
    return f"CASE {column} {whens} END"


def _asof(history: str, columns: list[str]) -> str:
    chosen = ", ".join(_code(c) + f" AS {c}" if c in CATEGORY_CODES else c for c in columns)
    return f"""SELECT Customer_ID, month, {chosen} FROM (
    SELECT h.*, v.snapshot_date AS month, row_number() OVER (PARTITION BY v.Customer_ID, v.snapshot_date
      ORDER BY h.snapshot_date DESC, h.record_id DESC) AS rn
    FROM clickstream v JOIN {history} h ON v.Customer_ID = h.Customer_ID AND h.snapshot_date <= v.snapshot_date)
    WHERE rn = 1"""


CTE["known_attributes"] = _asof("silver_attributes", ATTRIBUTE_COLUMNS)
CTE["known_financials"] = _asof("silver_financials", FINANCIAL_COLUMNS)
CTE["feature_store"] = (
    "SELECT v.*, "
    + ", ".join([f"a.{c}" for c in ATTRIBUTE_COLUMNS] + [f"f.{c}" for c in FINANCIAL_COLUMNS])
    + """ FROM clickstream v
    LEFT JOIN known_attributes a ON a.Customer_ID = v.Customer_ID AND a.month = v.snapshot_date
    LEFT JOIN known_financials f ON f.Customer_ID = v.Customer_ID AND f.month = v.snapshot_date"""
)


def _ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / CASE WHEN {bottom} < 1 THEN 1.0 ELSE CAST({bottom} AS DOUBLE) END"


ENGINEERED_SQL = {
    "debt_to_income": _ratio("Outstanding_Debt", "Annual_Income"),
    "emi_to_salary": _ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "debt_per_loan": _ratio("Outstanding_Debt", "Num_of_Loan"),
    "free_cash_flow_ratio": _ratio(
        "(CAST(Monthly_Inhand_Salary AS DOUBLE) - CAST(Total_EMI_per_month AS DOUBLE))", "Monthly_Inhand_Salary"
    ),
    "savings_rate": _ratio("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "inquiry_rate": _ratio("Num_Credit_Inquiries", "credit_history_months"),
    "clickstream_total": "CAST(" + " + ".join(f"coalesce({c}, 0)" for c in CLICKSTREAM_COLUMNS) + " AS INT)",
    "clickstream_active_channels": "CAST("
    + " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in CLICKSTREAM_COLUMNS)
    + " AS INT)",
}
CTE["engineered"] = "SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in ENGINEERED_SQL.items()) + " FROM feature_store"

STORE = ["clickstream", *ATTRIBUTES, *FINANCIALS, "known_attributes", "known_financials", "feature_store"]


def silver_loans(spark, folder):
    return datamart.silver_loans(loan_tape(spark, folder))


def label_store(spark, folder):
    return datamart.label_store(silver_loans(spark, folder))


def store_of(visits, spark, folder):
    return datamart.feature_store(
        visits,
        silver_attributes(spark, folder),
        silver_financials(spark, folder),
        tiebreak=["record_id"],
    )


def feature_store(spark, folder):
    return store_of(clickstream(spark, folder), spark, folder)


def labelled(spark, folder):
    """Visits meet their labels first: the store attaches columns row by row, and only labelled rows come out."""
    visits = training_data.labelled_dataset(clickstream(spark, folder), label_store(spark, folder))
    store = store_of(visits, spark, folder)
    ends = ["label", "weight"]
    added = [c for c in store.columns if c not in visits.columns]
    return store.select(*[c for c in visits.columns if c not in ends], *added, *ends)


query("loan_silver", sql_with(LOANS, "SELECT * FROM silver_loans"))(silver_loans)
query("label_store", sql_with(LABELS, "SELECT * FROM label_store"))(label_store)
query("feature_store", sql_with(STORE, "SELECT * FROM feature_store"))(feature_store)


@query(
    "month_slice_ingest",
    f"""SELECT {month_of("l_shipdate")} AS snapshot_date, count(*) AS n_rows,
    round(sum(l_extendedprice), 2) AS amount FROM lineitem
    WHERE {month_of("l_shipdate")} = DATE '1997-03-01' GROUP BY ALL""",
)
def month_slice_ingest(spark, folder):
    bounds = (F.col("l_shipdate") >= F.lit("1997-03-01").cast("timestamp_ntz")) & (
        F.col("l_shipdate") < F.lit("1997-04-01").cast("timestamp_ntz")
    )
    month = table(spark, folder, "lineitem").where(bounds)
    return month.groupBy(month_start(F.col("l_shipdate")).alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_extendedprice"), 2).alias("amount")
    )


@query(
    "missing_months",
    f"""SELECT DISTINCT {month_of("l_shipdate")} AS snapshot_date FROM lineitem
    WHERE {month_of("l_shipdate")} NOT IN (SELECT {month_of("o_orderdate")} FROM orders)""",
)
def missing_months(spark, folder):
    wanted = table(spark, folder, "lineitem").select(month_start(F.col("l_shipdate")).alias("snapshot_date"))
    existing = table(spark, folder, "orders").select(month_start(F.col("o_orderdate")).alias("snapshot_date"))
    return datamart.missing_months(wanted, existing)


@query(
    "latest_month",
    f"""SELECT {month_of("l_shipdate")} AS snapshot_date, count(*) AS n_rows FROM lineitem
    WHERE {month_of("l_shipdate")} = (SELECT max({month_of("l_shipdate")}) FROM lineitem) GROUP BY ALL""",
)
def latest_month(spark, folder):
    months = table(spark, folder, "lineitem").select(month_start(F.col("l_shipdate")).alias("snapshot_date"))
    latest = months.agg(F.max("snapshot_date")).scalar()
    return months.where(F.col("snapshot_date") == latest).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "label_rate_by_cohort",
    sql_with(
        LABELS,
        """SELECT snapshot_date, origination_date, count(*) AS n_loans,
        round(avg(CAST(label AS DOUBLE)), 6) AS default_rate FROM label_store GROUP BY ALL""",
    ),
)
def label_rate_by_cohort(spark, folder):
    return label_store(spark, folder).groupBy("snapshot_date", "origination_date").agg(
        F.count(F.lit(1)).alias("n_loans"), F.round(F.avg("label"), 6).alias("default_rate")
    )


def _orders_as_records(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("snapshot_date"),
        F.col("o_orderkey").alias("record_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )


CTE["records"] = """SELECT CAST(o_custkey AS STRING) AS Customer_ID, CAST(o_orderdate AS DATE) AS snapshot_date,
  o_orderkey AS record_id, o_totalprice AS price, o_orderpriority AS priority FROM orders"""
CTE["daily_visits"] = """SELECT l_orderkey, l_linenumber, CAST(o_custkey AS STRING) AS Customer_ID,
  CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(
    "asof_latest_record",
    sql_with(
        ["records", "daily_visits"],
        """SELECT v.*, r.price, r.priority FROM daily_visits v LEFT JOIN (
          SELECT * FROM (SELECT m.Customer_ID, m.snapshot_date AS day, h.price, h.priority,
            row_number() OVER (PARTITION BY m.Customer_ID, m.snapshot_date
              ORDER BY h.snapshot_date DESC, h.record_id DESC) AS rn
            FROM (SELECT DISTINCT Customer_ID, snapshot_date FROM daily_visits) m
            JOIN records h ON h.Customer_ID = m.Customer_ID AND h.snapshot_date <= m.snapshot_date) WHERE rn = 1
        ) r ON r.Customer_ID = v.Customer_ID AND r.day = v.snapshot_date""",
    ),
)
def asof_latest_record(spark, folder):
    from riskmart.catalog.base import items_with_orders

    visits = items_with_orders(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.col("l_shipdate").cast("date").alias("snapshot_date"),
    )
    history = {"order": _orders_as_records(spark, folder)}
    return asof_latest(visits, history, tiebreak=["record_id"], monthly=False)


@query(
    "latest_record_per_customer",
    sql_with(
        ["records"],
        """SELECT Customer_ID, snapshot_date, record_id, price, priority FROM records
        QUALIFY row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC, record_id DESC) = 1""",
    ),
)
def latest_record_per_customer(spark, folder):
    return latest_per_key(_orders_as_records(spark, folder), ["Customer_ID"], ["snapshot_date", "record_id"])


@query(
    "engineered_features",
    sql_with(
        [*STORE, "engineered"],
        "SELECT Customer_ID, snapshot_date, " + ", ".join(ENGINEERED_COLUMNS) + " FROM engineered",
    ),
)
def engineered_features(spark, folder):
    store = datamart.with_engineered(feature_store(spark, folder))
    return store.select("Customer_ID", "snapshot_date", *ENGINEERED_COLUMNS)


CTE["label_groups"] = """SELECT Customer_ID, origination_date, label, count(*) AS weight
  FROM label_store GROUP BY ALL"""
CTE["labelled"] = """SELECT f.*, f.snapshot_date AS feature_snapshot_date, l.label, l.weight FROM feature_store f
  JOIN label_groups l ON l.Customer_ID = f.Customer_ID AND l.origination_date = f.snapshot_date"""
LABELLED = [*STORE, *LABELS, "label_groups", "labelled"]


@query("labeled_dataset_offset", sql_with(LABELLED, "SELECT * FROM labelled"))
def labeled_dataset_offset(spark, folder):
    return labelled(spark, folder)


@query(
    "scoring_month_features",
    sql_with(
        ["clickstream"],
        """SELECT * REPLACE (CAST(snapshot_date + INTERVAL 6 MONTH AS DATE) AS snapshot_date) FROM clickstream""",
    ),
)
def scoring_month_features(spark, folder):
    return training_data.scoring_features(clickstream(spark, folder))


SPLIT_SQL = f"""CASE WHEN feature_snapshot_date <= DATE '{TRAIN_END}' THEN 'train'
  WHEN feature_snapshot_date <= DATE '{TEST_END}' THEN 'test' ELSE 'oot' END"""


@query(
    "temporal_split_stats",
    sql_with(
        LABELLED,
        f"""SELECT {SPLIT_SQL} AS split, min(feature_snapshot_date) AS first_month,
        max(feature_snapshot_date) AS last_month, CAST(sum(weight) AS BIGINT) AS n_rows,
        round(CAST(sum(label * weight) AS DOUBLE) / CAST(sum(weight) AS DOUBLE), 6) AS prevalence
        FROM labelled GROUP BY ALL""",
    ),
)
def temporal_split_stats(spark, folder):
    dataset = labelled(spark, folder).withColumn(
        "split", training_data.split_name(F.col("feature_snapshot_date"), TRAIN_END, TEST_END)
    )
    stats = training_data.split_stats(dataset, weight=F.col("weight"))
    return stats.withColumn("prevalence", F.round("prevalence", 6))


@query(
    "class_weights",
    sql_with(
        LABELS,
        """SELECT n_neg, n_pos, round((n_neg + n_pos) / (2.0 * n_neg), 6) AS weight_neg,
        round((n_neg + n_pos) / (2.0 * n_pos), 6) AS weight_pos,
        round(n_neg / greatest(n_pos, 1), 6) AS scale_pos_weight FROM (
        SELECT CAST(count(*) FILTER (label = 0) AS DOUBLE) AS neg, count(*) FILTER (label = 0) AS n_neg,
        count(*) FILTER (label = 1) AS n_pos FROM label_store)""",
    ),
)
def class_weights(spark, folder):
    weights = training_data.class_weights(label_store(spark, folder))
    return weights.select(
        "n_neg",
        "n_pos",
        *[F.round(c, 6).alias(c) for c in ("weight_neg", "weight_pos", "scale_pos_weight")],
    )
