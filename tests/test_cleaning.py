"""Edge rows of the cleaning rules and the loan arithmetic."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskmart.functions import bands, cleaning, features
from riskmart.plans import datamart
from riskmart.schemas import (
    LOAN_TYPES,
    NA_TOKENS,
    RAW_ATTRIBUTE_COLUMNS,
    RAW_FINANCIAL_COLUMNS,
    text_schema,
)


def apply(spark, values, expression, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_to_integer(spark):
    values = ["3", " 7 ", "11.0", "11.9", "-4.5", ".5", "1e3", "abc", "", None, "99999999999", "1.2.3", "+8"]
    assert apply(spark, values, cleaning.to_integer) == [
        3, 7, 11, 11, -4, 0, None, None, None, None, None, None, 8
    ]


def test_only_text_with_a_point_is_rewritten(spark):
    """What has no decimal point is a whole number for the plain cast, or null: it meets no regular expression."""
    old = lambda c: F.coalesce(c.try_cast("int"), F.regexp_replace(c, cleaning.PLAIN_NUMBER, "${sign}0${whole}").try_cast("int"))
    odd = ["", " ", "+", "-", ".", "-.", "\t5\n", "\x0b6\x0c", "+007", "2147483647", "2147483648", "-2147483649.5", "7.", " -8.9\r", "1e2.", "\x01 9", "9\u00a0", "0x1", "5f"]
    assert apply(spark, odd, cleaning.to_integer) == apply(spark, odd, old)
    plan = spark.createDataFrame([("1",)], "x string").select(cleaning.to_integer(F.col("x")).alias("y"))
    assert "CASE WHEN Contains" in plan._jdf.queryExecution().analyzed().toString()


def test_na_tokens(spark):
    assert apply(spark, [*NA_TOKENS, "x"], cleaning.na_to_null) == [None] * len(NA_TOKENS) + ["x"]


def test_list_and_duration(spark):
    assert apply(spark, [None, "A", "A, B, and C"], cleaning.list_size) == [0, 1, 3]
    spans = ["22 Years and 1 Months", "5 Years", None, "0 Years and 11 Months"]
    assert apply(spark, spans, cleaning.duration_months) == [265, None, None, 11]


def financial(spark, **cells):
    n = max(len(v) for v in cells.values())
    base = {c: [None] * n for c in RAW_FINANCIAL_COLUMNS} | cells
    rows = list(zip(*[base[c] for c in RAW_FINANCIAL_COLUMNS]))
    raw = spark.createDataFrame(rows, text_schema(RAW_FINANCIAL_COLUMNS)).coalesce(1)
    return datamart.silver_financials(datamart.normalise_text(raw)).collect()


@pytest.mark.parametrize(
    ("column", "raw", "expected"),
    [
        ("Annual_Income", ["52312.5_", "0", "abc", "-3", "NaN"], [52312.5, None, None, None, None]),
        ("Num_Bank_Accounts", ["-1", "20", "21", "3.0"], [None, 20, None, 3]),
        ("Num_Credit_Inquiries", ["11.0", "11.9", "101", "1e1"], [11, 11, None, 10]),
        ("Num_of_Loan", ["1_", "51", "-1", "50"], [1, None, None, 50]),
        ("Changed_Credit_Limit", ["_", "-3.5", ""], [None, -3.5, None]),
        ("Monthly_Balance", ["__-333333333333333333333333333__", "-999999", "-1000000"], [None, -999999.0, None]),
        ("Payment_Behaviour", ["!@9#%8", "Low_spent_Small_value_payments"], [None, "Low_spent_Small_value_payments"]),
        ("Credit_Mix", ["_", "Good"], [None, "Good"]),
        ("Payment_of_Min_Amount", ["NM", "Yes", "No"], [None, "Yes", "No"]),
        ("Amount_invested_monthly", ["__10000__", "1.5"], [10000.0, 1.5]),
        ("Interest_Rate", ["-1", "0", "100", "101"], [None, 0, 100, None]),
        ("Delay_from_due_date", ["-5", "5"], [None, 5]),
    ],
)
def test_financials(spark, column, raw, expected):
    assert [r[column] for r in financial(spark, **{column: raw})] == expected


def test_attributes(spark):
    ages = ["28_", "-25", "17", "30.0", "", "101"]
    rows = [("c", "n", a, "s", "_______" if i else "Lawyer", "2023-01-01") for i, a in enumerate(ages)]
    raw = spark.createDataFrame(rows, text_schema(RAW_ATTRIBUTE_COLUMNS)).coalesce(1)
    clean = datamart.silver_attributes(datamart.normalise_text(raw))
    assert clean.columns == ["Customer_ID", "Age", "Occupation", "snapshot_date"]
    assert [r["Age"] for r in clean.collect()] == [28, 25, None, None, None, None]
    assert [r["Occupation"] for r in clean.collect()] == ["Lawyer"] + [None] * 5


LOAN_CASES = [
    # snapshot, due, overdue -> missed, first missed, dpd, label
    ("2023-03-01", "100", "100", 1, "2023-02-01", 28, 0),
    ("2023-04-01", "100", "100", 1, "2023-03-01", 31, 1),
    ("2023-05-01", "100", "150", 2, "2023-03-01", 61, 1),
    ("2023-05-01", "100", "0", 0, None, 0, 0),
    ("2023-05-01", "0", "50", 0, None, None, 0),
    ("2023-05-01", None, "50", 0, None, None, 0),
    ("2023-05-01", None, None, 0, None, 0, 0),
]


def test_loans(spark):
    rows = [
        (f"L{i}", "C", "2022-11-01", None, "6", "1000", due, "1", over, "1", snapshot)
        for i, (snapshot, due, over, *_) in enumerate(LOAN_CASES)
    ]
    silver = datamart.silver_loans(spark.createDataFrame(rows, text_schema(list(LOAN_TYPES))))
    labels = {r["loan_id"]: r for r in datamart.label_store(silver).collect()}
    for i, r in enumerate(silver.orderBy("loan_id").collect()):
        _, _, _, missed, first, dpd, label = LOAN_CASES[i]
        assert (r["installments_missed"], str(r["first_missed_date"]), r["dpd"]) == (missed, str(first), dpd)
        assert labels[f"L{i}"]["label"] == label
        assert r["tenure"] == 0 and r["due_amt"] is not None and r["overdue_amt"] is not None
    assert labels["L0"]["label_def"] == "30dpd_6mob"
    assert labels["L0"]["origination_date"] == dt.date(2022, 9, 1)


def test_only_month_on_book_six_is_labelled(spark):
    rows = [(str(m), "C", "2022-11-01", "1", str(m), "1", "1", "1", "1", "1", "2023-07-01") for m in (5, 6, 7)]
    silver = datamart.silver_loans(spark.createDataFrame(rows, text_schema(list(LOAN_TYPES))))
    assert [r["loan_id"] for r in datamart.label_store(silver).collect()] == ["6"]


def test_ratios_keep_null_denominators(spark):
    row = spark.createDataFrame(
        [(50.0, None, 0, None, 3, -1)],
        "Outstanding_Debt float, Annual_Income float, Num_of_Loan int, fe_1 int, fe_2 int, fe_3 int",
    )
    out = row.select(
        features.ratio(F.col("Outstanding_Debt"), F.col("Annual_Income")).alias("dti"),
        features.ratio(F.col("Outstanding_Debt"), F.col("Num_of_Loan")).alias("per_loan"),
        features.row_total(["fe_1", "fe_2", "fe_3"]).alias("total"),
        features.row_positive_count(["fe_1", "fe_2", "fe_3"]).alias("active"),
    ).first()
    assert tuple(out) == (None, 50.0, 2, 1)


def test_encode_unseen_is_null(spark):
    encode = lambda c: features.encode(c, {"Bad": 0, "Good": 2})
    assert apply(spark, ["Good", "Bad", "Pilot", None], encode) == [2, 0, None, None]


def test_flags_at_the_boundaries(spark):
    values = [None, float("nan"), 0.0999, 0.10, 0.2499, 0.25]
    flags = ["unknown", "unknown", "stable", "drift", "drift", "retrain"]
    assert apply(spark, values, bands.stability_flag, "double") == flags
