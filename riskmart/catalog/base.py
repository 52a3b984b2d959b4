"""Query registry and the views that give the test tables the shape of the datamart.

A view is a list of plain SQL expressions that mean the same in Spark and in the checking
engine. Only inputs are shared this way; every operator is written separately.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskmart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that checks it where there is one."""

    def register(function):
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(tune(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_list(view: dict[str, str]) -> str:
    return ",\n  ".join(f"{expression} AS {name}" for name, expression in view.items())


def apply_view(df: DataFrame, view: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in view.items()])


def month_of(column: str) -> str:
    return f"make_date(CAST(year({column}) AS INT), CAST(month({column}) AS INT), 1)"


# --- loans: one line item is one loan month -------------------------------------------

LOAN_TAPE = {
    "loan_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "loan_start_date": "CAST(o_orderdate AS DATE)",
    "tenure": "CASE WHEN l_quantity = 11 THEN NULL ELSE CAST(l_quantity AS INT) END",
    "installment_num": "l_linenumber",
    "loan_amt": "l_extendedprice",
    "due_amt": "CASE WHEN l_quantity = 7 THEN NULL ELSE l_extendedprice * l_tax END",
    "paid_amt": "l_extendedprice * (1 - l_discount)",
    "overdue_amt": "CASE WHEN l_quantity = 5 THEN NULL ELSE l_extendedprice * l_discount END",
    "balance": "o_totalprice",
    "snapshot_date": month_of("l_shipdate"),
}


def items_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey)


def loan_tape(spark: SparkSession, folder: str) -> DataFrame:
    return apply_view(items_with_orders(spark, folder), LOAN_TAPE)


# --- clickstream: 20 counters per customer and month ----------------------------------

CLICKSTREAM = {
    **{f"fe_{i}": f"CAST(count(CASE WHEN l_linenumber = {i} THEN 1 END) AS INT)" for i in range(1, 8)},
    **{
        f"fe_{i + 7}": f"CAST(sum(CASE WHEN l_linenumber = {i} THEN CAST(l_quantity AS INT) END) AS INT)"
        for i in range(1, 8)
    },
    "fe_15": "CAST(count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS INT)",
    "fe_16": "CAST(count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS INT)",
    "fe_17": "CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS INT)",
    "fe_18": "CAST(count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS INT)",
    "fe_19": "CAST(count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS INT)",
    "fe_20": "CAST(sum(l_partkey % 5 - 1) AS INT)",
}


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    joined = items_with_orders(spark, folder)
    keyed = joined.selectExpr(
        "CAST(o_custkey AS STRING) AS Customer_ID",
        f"{month_of('l_shipdate')} AS snapshot_date",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "l_partkey",
    )
    return keyed.groupBy("Customer_ID", "snapshot_date").agg(
        *[F.expr(expression).alias(name) for name, expression in CLICKSTREAM.items()]
    )


# --- dated customer records: one order is one record, with text as dirty as the real one

RAW_ATTRIBUTES = {
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "Name": "concat('Customer ', CAST(o_custkey AS STRING))",
    "Age": """CASE o_orderkey % 9
      WHEN 0 THEN concat(CAST(15 + o_orderkey % 70 AS STRING), '_')
      WHEN 1 THEN '-25' WHEN 2 THEN '30.0' WHEN 3 THEN 'NA'
      ELSE CAST(10 + o_orderkey % 100 AS STRING) END""",
    "SSN": "concat('000-00-', CAST(o_custkey % 10000 AS STRING))",
    "Occupation": """CASE o_orderpriority
      WHEN '1-URGENT' THEN 'Doctor' WHEN '2-HIGH' THEN 'Engineer' WHEN '3-MEDIUM' THEN 'Media_Manager'
      WHEN '4-NOT SPECIFIED' THEN '_______' ELSE 'Pilot' END""",
    "snapshot_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "record_id": "o_orderkey",
}

PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS STRING)"

RAW_FINANCIALS = {
    "Customer_ID": "CAST(o_custkey AS STRING)",
    "Annual_Income": f"""CASE WHEN o_orderkey % 5 = 0 THEN concat({PRICE}, '_')
      WHEN o_orderkey % 11 = 0 THEN '0' WHEN o_orderkey % 13 = 0 THEN 'abc' ELSE {PRICE} END""",
    "Monthly_Inhand_Salary": """CASE WHEN o_orderkey % 17 = 0 THEN 'nan'
      ELSE concat(CAST(o_orderkey * 37 % 9000 AS STRING), '.5') END""",
    "Num_Bank_Accounts": """CASE WHEN o_orderkey % 8 = 0 THEN '-1' WHEN o_orderkey % 8 = 1 THEN '3.0'
      ELSE CAST(o_orderkey % 25 AS STRING) END""",
    "Num_Credit_Card": "CAST(o_orderkey % 60 AS STRING)",
    "Interest_Rate": "CAST(o_orderkey % 130 - 10 AS STRING)",
    "Num_of_Loan": "concat(CAST(o_orderkey % 54 - 1 AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN '_' ELSE '' END)",
    "Type_of_Loan": """CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Auto Loan'
      WHEN 2 THEN 'Auto Loan, and Home Equity Loan' ELSE 'Payday Loan, Personal Loan, and Student Loan' END""",
    "Delay_from_due_date": "CAST(o_orderkey % 70 - 5 AS STRING)",
    "Num_of_Delayed_Payment": """CASE WHEN o_orderkey % 6 = 0 THEN concat(CAST(o_orderkey % 30 AS STRING), '_')
      ELSE CAST(o_orderkey % 120 - 3 AS STRING) END""",
    "Changed_Credit_Limit": """CASE WHEN o_orderkey % 10 = 0 THEN '_'
      ELSE concat(CAST(o_orderkey % 40 - 8 AS STRING), '.25') END""",
    "Num_Credit_Inquiries": """CASE WHEN o_orderkey % 7 = 0 THEN '11.9' WHEN o_orderkey % 7 = 1 THEN '101'
      ELSE concat(CAST(o_orderkey % 20 AS STRING), '.0') END""",
    "Credit_Mix": "CASE o_orderstatus WHEN 'F' THEN 'Good' WHEN 'O' THEN 'Standard' ELSE '_' END",
    "Outstanding_Debt": f"CASE WHEN o_orderkey % 3 = 0 THEN concat({PRICE}, '_') ELSE {PRICE} END",
    "Credit_Utilization_Ratio": "concat(CAST(20 + o_orderkey % 30 AS STRING), '.75')",
    "Credit_History_Age": """CASE WHEN o_orderkey % 12 = 0 THEN 'NA' WHEN o_orderkey % 12 = 1 THEN '5 Years'
      ELSE concat(CAST(o_orderkey % 30 AS STRING), ' Years and ', CAST(o_orderkey % 12 AS STRING), ' Months') END""",
    "Payment_of_Min_Amount": "CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END",
    "Total_EMI_per_month": "concat(CAST(o_orderkey * 13 % 800 AS STRING), '.5')",
    "Amount_invested_monthly": """CASE WHEN o_orderkey % 9 = 0 THEN '__10000__'
      ELSE concat(CAST(o_orderkey * 7 % 600 AS STRING), '.25') END""",
    "Payment_Behaviour": """CASE o_orderkey % 5 WHEN 0 THEN '!@9#%8' WHEN 1 THEN 'Low_spent_Small_value_payments'
      WHEN 2 THEN 'High_spent_Large_value_payments' WHEN 3 THEN 'Low_spent_Large_value_payments'
      ELSE 'High_spent_Medium_value_payments' END""",
    "Monthly_Balance": """CASE WHEN o_orderkey % 50 = 0 THEN '__-333333333333333333333333333__'
      ELSE concat(CAST(o_orderkey * 11 % 1500 - 300 AS STRING), '.5') END""",
    "snapshot_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "record_id": "o_orderkey",
}


def raw_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return apply_view(table(spark, folder, "orders"), RAW_ATTRIBUTES)


def raw_financials(spark: SparkSession, folder: str) -> DataFrame:
    return apply_view(table(spark, folder, "orders"), RAW_FINANCIALS)


# --- predictions: every line item is scored, those with status F are labelled ---------

PREDICTIONS = {
    "Customer_ID": "CAST(l_orderkey AS STRING)",
    "snapshot_date": month_of("l_shipdate"),
    "score": "CASE WHEN l_quantity = 13 THEN NULL ELSE l_discount * 10 END",
    "challenger_score": "CASE WHEN l_quantity = 17 THEN NULL ELSE l_tax * 12.5 END",
    "price_score": "l_extendedprice / 105000.0",
    "label": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "is_labelled": "l_linestatus = 'F'",
}


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return apply_view(table(spark, folder, "lineitem"), PREDICTIONS)


def observed_labels(spark: SparkSession, folder: str) -> DataFrame:
    return predictions(spark, folder).where("is_labelled").select("Customer_ID", "snapshot_date", "label")


# --- SQL of the same views for the check ----------------------------------------------

CTE = {
    "loan_tape": f"""SELECT {select_list(LOAN_TAPE)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "clickstream": f"""SELECT CAST(o_custkey AS STRING) AS Customer_ID, {month_of("l_shipdate")} AS snapshot_date,
  {select_list(CLICKSTREAM)}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
    "raw_attributes": f"SELECT {select_list(RAW_ATTRIBUTES)} FROM orders",
    "raw_financials": f"SELECT {select_list(RAW_FINANCIALS)} FROM orders",
    "predictions": f"SELECT {select_list(PREDICTIONS)} FROM lineitem",
    "observed_labels": "SELECT Customer_ID, snapshot_date, label FROM predictions WHERE is_labelled",
}


def sql_with(names: Sequence[str], body: str, **more: str) -> str:
    """A WITH query over named views, in the given order, then ``more`` views."""
    views = [f"{name} AS ({CTE[name]})" for name in names]
    views += [f"{name} AS ({text})" for name, text in more.items()]
    return "WITH " + ",\n".join(views) + "\n" + body
