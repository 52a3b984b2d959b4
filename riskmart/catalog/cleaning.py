"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.catalog.base import CTE, query, raw_attributes, raw_financials, sql_with, table
from riskmart.functions import cleaning, features
from riskmart.plans import datamart
from riskmart.schemas import CLICKSTREAM_COLUMNS, NA_TOKENS

TOKENS = ", ".join(f"'{token}'" for token in NA_TOKENS)
NUMBER = r"'^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$'"


def _int(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, {NUMBER}) THEN TRY_CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INT) END"


def _between(value: str, low: float | None, high: float | None) -> str:
    tests = [f"{value} >= {low}"] if low is not None else []
    tests += [f"{value} <= {high}"] if high is not None else []
    return f"CASE WHEN {' AND '.join(tests)} THEN {value} END"


def _strip(column: str) -> str:
    return f"replace({column}, '_', '')"


def _real(text: str) -> str:
    return f"TRY_CAST({text} AS FLOAT)"


CTE["bronze_attributes"] = f"""SELECT * REPLACE (
  CASE WHEN Age NOT IN ({TOKENS}) THEN Age END AS Age,
  CASE WHEN Occupation NOT IN ({TOKENS}) THEN Occupation END AS Occupation) FROM raw_attributes"""

CTE["silver_attributes"] = f"""SELECT Customer_ID,
  {_between(_int("regexp_replace(Age, '[^0-9]', '', 'g')"), 18, 100)} AS Age,
  CASE WHEN Occupation <> '_______' THEN Occupation END AS Occupation,
  TRY_CAST(snapshot_date AS DATE) AS snapshot_date, record_id FROM bronze_attributes"""

CTE["bronze_financials"] = f"""SELECT * REPLACE (
  CASE WHEN Monthly_Inhand_Salary NOT IN ({TOKENS}) THEN Monthly_Inhand_Salary END AS Monthly_Inhand_Salary,
  CASE WHEN Credit_History_Age NOT IN ({TOKENS}) THEN Credit_History_Age END AS Credit_History_Age
) FROM raw_financials"""

CTE["silver_financials"] = rf"""SELECT Customer_ID,
  CASE WHEN {_real(_strip("Annual_Income"))} > 0 THEN {_real(_strip("Annual_Income"))} END AS Annual_Income,
  {_real("Monthly_Inhand_Salary")} AS Monthly_Inhand_Salary,
  {_between(_int("Num_Bank_Accounts"), 0, 20)} AS Num_Bank_Accounts,
  {_between(_int("Num_Credit_Card"), 0, 50)} AS Num_Credit_Card,
  {_between(_int("Interest_Rate"), 0, 100)} AS Interest_Rate,
  {_between(_int(_strip("Num_of_Loan")), 0, 50)} AS Num_of_Loan,
  CASE WHEN Type_of_Loan IS NULL THEN 0 ELSE CAST(len(string_split(Type_of_Loan, ',')) AS INT) END AS num_loan_types,
  {_between(_int("Delay_from_due_date"), 0, None)} AS Delay_from_due_date,
  {_between(_int(_strip("Num_of_Delayed_Payment")), 0, 100)} AS Num_of_Delayed_Payment,
  {_real(_strip("Changed_Credit_Limit"))} AS Changed_Credit_Limit,
  {_between("TRY_CAST(trunc(TRY_CAST(Num_Credit_Inquiries AS FLOAT)) AS INT)", 0, 100)} AS Num_Credit_Inquiries,
  CASE WHEN Credit_Mix <> '_' THEN Credit_Mix END AS Credit_Mix,
  {_real(_strip("Outstanding_Debt"))} AS Outstanding_Debt,
  {_real("Credit_Utilization_Ratio")} AS Credit_Utilization_Ratio,
  TRY_CAST(regexp_extract(Credit_History_Age, '(\d+) Years', 1) AS INT) * 12
    + TRY_CAST(regexp_extract(Credit_History_Age, '(\d+) Months', 1) AS INT) AS credit_history_months,
  CASE WHEN Payment_of_Min_Amount <> 'NM' THEN Payment_of_Min_Amount END AS Payment_of_Min_Amount,
  {_real("Total_EMI_per_month")} AS Total_EMI_per_month,
  {_real(_strip("Amount_invested_monthly"))} AS Amount_invested_monthly,
  CASE WHEN Payment_Behaviour IN (
    'Low_spent_Small_value_payments', 'Low_spent_Medium_value_payments', 'Low_spent_Large_value_payments',
    'High_spent_Small_value_payments', 'High_spent_Medium_value_payments', 'High_spent_Large_value_payments')
    THEN Payment_Behaviour END AS Payment_Behaviour,
  CASE WHEN {_real(_strip("Monthly_Balance"))} > -1000000 THEN {_real(_strip("Monthly_Balance"))} END AS Monthly_Balance,
  TRY_CAST(snapshot_date AS DATE) AS snapshot_date, record_id FROM bronze_financials"""

ATTRIBUTES = ["raw_attributes", "bronze_attributes", "silver_attributes"]
FINANCIALS = ["raw_financials", "bronze_financials", "silver_financials"]


def silver_attributes(spark, folder):
    bronze = datamart.normalise_text(raw_attributes(spark, folder))
    return datamart.silver_attributes(bronze, keep=["record_id"])


def silver_financials(spark, folder):
    bronze = datamart.normalise_text(raw_financials(spark, folder))
    return datamart.silver_financials(bronze, keep=["record_id"])


@query("attributes_silver", sql_with(ATTRIBUTES, "SELECT * FROM silver_attributes"))
def attributes_silver(spark, folder):
    return silver_attributes(spark, folder)


@query("financials_silver", sql_with(FINANCIALS, "SELECT * FROM silver_financials"))
def financials_silver(spark, folder):
    return silver_financials(spark, folder)


@query(
    "na_tokens_to_null",
    sql_with(
        ["raw_financials"],
        f"""SELECT record_id, CASE WHEN Monthly_Inhand_Salary NOT IN ({TOKENS}) THEN Monthly_Inhand_Salary END AS salary,
        CASE WHEN Credit_History_Age NOT IN ({TOKENS}) THEN Credit_History_Age END AS history FROM raw_financials""",
    ),
)
def na_tokens_to_null(spark, folder):
    return raw_financials(spark, folder).select(
        "record_id",
        cleaning.na_to_null(F.col("Monthly_Inhand_Salary")).alias("salary"),
        cleaning.na_to_null(F.col("Credit_History_Age")).alias("history"),
    )


@query(
    "sentinel_to_null",
    "SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders",
)
def sentinel_to_null(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        cleaning.sentinel_to_null(F.col("o_orderpriority"), "4-NOT SPECIFIED").alias("priority"),
    )


@query(
    "strip_and_cast",
    f"""SELECT c_custkey, {_int("regexp_replace(c_name, '[^0-9]', '', 'g')")} AS name_number FROM customer""",
)
def strip_and_cast(spark, folder):
    digits = cleaning.strip_matches(F.col("c_name"), "[^0-9]")
    return table(spark, folder, "customer").select("c_custkey", cleaning.to_integer(digits).alias("name_number"))


@query(
    "range_guard",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS income,
    CASE WHEN c_nationkey >= 5 AND c_nationkey <= 20 THEN c_nationkey END AS accounts FROM customer""",
)
def range_guard(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        cleaning.within(F.col("c_acctbal"), above=0).alias("income"),
        cleaning.within(F.col("c_nationkey"), low=5, high=20).alias("accounts"),
    )


@query(
    "valid_category_or_null",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS priority
    FROM orders""",
)
def valid_category_or_null(spark, folder):
    allowed = ["1-URGENT", "2-HIGH"]
    return table(spark, folder, "orders").select(
        "o_orderkey", cleaning.valid_or_null(F.col("o_orderpriority"), allowed).alias("priority")
    )


@query(
    "list_item_count",
    "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INT) AS n_words FROM part",
)
def list_item_count(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", cleaning.list_size(F.col("p_name"), " ").alias("n_words")
    )


@query(
    "duration_to_months",
    sql_with(
        FINANCIALS[:2],
        r"""SELECT record_id, TRY_CAST(regexp_extract(Credit_History_Age, '(\d+) Years', 1) AS INT) * 12
        + TRY_CAST(regexp_extract(Credit_History_Age, '(\d+) Months', 1) AS INT) AS months FROM bronze_financials""",
    ),
)
def duration_to_months(spark, folder):
    return raw_financials(spark, folder).select(
        "record_id", cleaning.duration_months(F.col("Credit_History_Age")).alias("months")
    )


@query(
    "numeric_fill_zero",
    """SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_tax > 0 THEN l_tax END, 0) AS tax,
    coalesce(CASE WHEN l_linenumber > 3 THEN l_linenumber END, 0) AS line,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag FROM lineitem""",
)
def numeric_fill_zero(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
        F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
    )
    return items.na.fill(0)


@query(
    "label_encode",
    sql_with(
        ["raw_attributes", "raw_financials"],
        """SELECT a.record_id,
        CASE Occupation WHEN 'Doctor' THEN 3 WHEN 'Engineer' THEN 4 WHEN 'Media_Manager' THEN 9 END AS occupation,
        CASE Credit_Mix WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END AS credit_mix,
        CASE Payment_of_Min_Amount WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 END AS payment_of_min_amount,
        CASE Payment_Behaviour WHEN 'Low_spent_Small_value_payments' THEN 0 WHEN 'Low_spent_Large_value_payments' THEN 2
          WHEN 'High_spent_Medium_value_payments' THEN 4 WHEN 'High_spent_Large_value_payments' THEN 5 END
          AS payment_behaviour
        FROM raw_attributes a JOIN raw_financials f ON a.record_id = f.record_id""",
    ),
)
def label_encode(spark, folder):
    from riskmart.catalog.base import RAW_ATTRIBUTES, RAW_FINANCIALS

    names = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
    text = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS record_id",
        f"{RAW_ATTRIBUTES['Occupation']} AS Occupation",
        *[f"{RAW_FINANCIALS[n]} AS {n}" for n in names],
    )
    codes = features.encoded_categories(text.columns)
    return text.select("record_id", *[codes[n].alias(n.lower()) for n in ["Occupation", *names]])


EVENT_TYPES = ["view", "click", "purchase", "error", "signup"]


@query(
    "clickstream_pivot",
    "SELECT CAST(user_id AS STRING) AS Customer_ID, CAST(ts AS DATE) AS snapshot_date,\n"
    + ",\n".join(
        f"CAST(count(CASE WHEN event_type = '{kind}' THEN 1 END) AS INT) AS fe_{i}"
        for i, kind in enumerate(EVENT_TYPES, 1)
    )
    + "\nFROM events GROUP BY ALL",
)
def clickstream_pivot(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("Customer_ID"),
        F.col("ts").cast("date").alias("snapshot_date"),
        "event_type",
    )
    return events.groupBy("Customer_ID", "snapshot_date").agg(
        *[
            F.count(F.when(F.col("event_type") == kind, 1)).cast("int").alias(f"fe_{i}")
            for i, kind in enumerate(EVENT_TYPES, 1)
        ]
    )


FE_TEXT = {
    f"fe_{i}": f"CASE WHEN event_id % {i + 1} = 0 THEN '' WHEN event_id % {i + 1} = 1 THEN "
    f"concat(CAST(event_id % 90 - {i} AS STRING), '.7') ELSE CAST(event_id % 50 AS STRING) END"
    for i in range(1, 21)
}


@query(
    "clickstream_silver",
    "SELECT event_id, Customer_ID, snapshot_date, "
    + ", ".join(f"{_int(c)} AS {c}" for c in CLICKSTREAM_COLUMNS)
    + " FROM (SELECT event_id, CAST(user_id AS STRING) AS Customer_ID, CAST(ts AS DATE) AS snapshot_date, "
    + ", ".join(f"{e} AS {c}" for c, e in FE_TEXT.items())
    + " FROM events)",
)
def clickstream_silver(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id",
        "CAST(user_id AS STRING) AS Customer_ID",
        "CAST(CAST(ts AS DATE) AS STRING) AS snapshot_date",
        *[f"{e} AS {c}" for c, e in FE_TEXT.items()],
    )
    return datamart.silver_clickstream(raw, keep=["event_id"])
