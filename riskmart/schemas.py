"""Table schemas, feature lists and other values shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMER = "Customer_ID"
MONTH = "snapshot_date"

MOB = 6
DPD = 30

# Column names and types of the loan management extract.
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

CLICKSTREAM_COLUMNS = [f"fe_{i}" for i in range(1, 21)]

# The cleaned columns kept of the dated customer records.
ATTRIBUTE_COLUMNS = ["Age", "Occupation"]
FINANCIAL_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "num_loan_types",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "credit_history_months",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
]
ENGINEERED_COLUMNS = [
    "debt_to_income",
    "emi_to_salary",
    "debt_per_loan",
    "free_cash_flow_ratio",
    "savings_rate",
    "inquiry_rate",
    "clickstream_total",
    "clickstream_active_channels",
]

FEATURE_COLUMNS = CLICKSTREAM_COLUMNS + ATTRIBUTE_COLUMNS + FINANCIAL_COLUMNS + ENGINEERED_COLUMNS

# Raw columns of the all-text extracts.
RAW_ATTRIBUTE_COLUMNS = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]
RAW_FINANCIAL_COLUMNS = [
    "Customer_ID",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Type_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Credit_Mix",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Payment_Behaviour",
    "Monthly_Balance",
    "snapshot_date",
]
RAW_CLICKSTREAM_COLUMNS = CLICKSTREAM_COLUMNS + ["Customer_ID", "snapshot_date"]

# Columns the quality gate insists on.
REQUIRED_FEATURE_COLUMNS = [
    CUSTOMER,
    MONTH,
    *CLICKSTREAM_COLUMNS,
    "Age",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
]

# Integer codes of the categorical columns.
OCCUPATION_CODES = {
    "Accountant": 0,
    "Architect": 1,
    "Developer": 2,
    "Doctor": 3,
    "Engineer": 4,
    "Entrepreneur": 5,
    "Journalist": 6,
    "Lawyer": 7,
    "Manager": 8,
    "Media_Manager": 9,
    "Mechanic": 10,
    "Musician": 11,
    "Scientist": 12,
    "Teacher": 13,
    "Writer": 14,
}
CREDIT_MIX_CODES = {"Bad": 0, "Standard": 1, "Good": 2}
PAYMENT_OF_MIN_AMOUNT_CODES = {"No": 0, "Yes": 1}
PAYMENT_BEHAVIOUR_CODES = {
    "Low_spent_Small_value_payments": 0,
    "Low_spent_Medium_value_payments": 1,
    "Low_spent_Large_value_payments": 2,
    "High_spent_Small_value_payments": 3,
    "High_spent_Medium_value_payments": 4,
    "High_spent_Large_value_payments": 5,
}
CATEGORY_CODES = {
    "Occupation": OCCUPATION_CODES,
    "Credit_Mix": CREDIT_MIX_CODES,
    "Payment_of_Min_Amount": PAYMENT_OF_MIN_AMOUNT_CODES,
    "Payment_Behaviour": PAYMENT_BEHAVIOUR_CODES,
}

# Text that stands for a missing value in the all-text extracts.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def text_schema(columns: list[str]) -> T.StructType:
    """Schema with every column read as text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def loan_schema() -> T.StructType:
    """Explicit schema of the loan extract; values are typed when cleaned."""
    return text_schema(list(LOAN_TYPES))
