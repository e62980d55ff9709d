"""Table contracts: columns, types, keys, tracked columns and value domains.

Everything here is a fixed value. The column names and domains are the interface
users rely on, so they are written out plainly and in table order.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (DataType, DateType, DecimalType, IntegerType, LongType, StringType,
                               StructType, TimestampType)

OPEN_END = "9999-12-31"

AUDIT = "_ingestion_ts timestamp, _source_file string, _batch_id string"

# Raw layer: every source column is text.
BRONZE_COLUMNS: dict[str, list[str]] = {
    "customers": (
        "customer_id first_name last_name date_of_birth gender phone email pan_number "
        "aadhar_number address city state pin_code customer_since is_active"
    ).split(),
    "accounts": (
        "account_id customer_id account_number account_type product_id branch_id ifsc_code "
        "balance currency open_date close_date status nominee_name"
    ).split(),
    "transactions": (
        "transaction_id account_id transaction_date transaction_time transaction_type amount "
        "currency channel status description beneficiary_acc reference_number"
    ).split(),
    "loans": (
        "loan_id customer_id loan_type product_id principal_amount interest_rate tenure_months "
        "emi_amount disburse_date maturity_date outstanding_amount status branch_id collateral_type"
    ).split(),
    "branches": (
        "branch_id branch_name branch_code ifsc_code address city state pin_code phone "
        "manager_name established_date is_active"
    ).split(),
    "product_types": "product_id product_name product_category interest_rate".split(),
}

# Conformed layer. `balance` on dim_account feeds the balance measures of the customer mart.
SILVER_DDL: dict[str, str] = {
    "dim_customer": (
        "customer_sk bigint, customer_id string, first_name string, last_name string, "
        "full_name string, date_of_birth date, age int, gender string, phone string, email string, "
        "pan_number string, aadhar_number string, city string, state string, pin_code string, "
        "customer_since date, is_active string, effective_date date, expiry_date date, "
        "is_current string, _etl_loaded_ts timestamp"
    ),
    "dim_account": (
        "account_sk bigint, account_id string, customer_id string, account_number string, "
        "account_type string, product_id string, branch_id string, ifsc_code string, "
        "balance decimal(15,2), currency string, open_date date, close_date date, status string, "
        "nominee_name string, _etl_loaded_ts timestamp"
    ),
    "dim_branch": (
        "branch_sk bigint, branch_id string, branch_name string, branch_code string, "
        "ifsc_code string, city string, state string, pin_code string, phone string, "
        "manager_name string, established_date date, is_active string, _etl_loaded_ts timestamp"
    ),
    "dim_product": (
        "product_sk bigint, product_id string, product_name string, product_category string, "
        "interest_rate decimal(5,2), _etl_loaded_ts timestamp"
    ),
    "dim_date": (
        "date_sk int, full_date date, year int, quarter int, month int, month_name string, "
        "week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend string, "
        "is_holiday string, fiscal_year int, fiscal_quarter int"
    ),
    "fact_transaction": (
        "transaction_sk bigint, transaction_id string, account_sk bigint, customer_sk bigint, "
        "branch_sk bigint, date_sk int, transaction_date date, transaction_time string, "
        "transaction_type string, amount decimal(15,2), currency string, channel string, "
        "status string, description string, beneficiary_acc string, reference_number string, "
        "_etl_loaded_ts timestamp"
    ),
    "fact_loan": (
        "loan_sk bigint, loan_id string, customer_sk bigint, branch_sk bigint, product_sk bigint, "
        "loan_type string, principal_amount decimal(15,2), interest_rate decimal(5,2), "
        "tenure_months int, emi_amount decimal(15,2), disburse_date date, maturity_date date, "
        "outstanding_amount decimal(15,2), status string, collateral_type string, "
        "_etl_loaded_ts timestamp"
    ),
}

GOLD_DDL: dict[str, str] = {
    "gold_customer_360": (
        "customer_id string, full_name string, city string, state string, customer_since date, "
        "total_accounts bigint, active_accounts bigint, total_balance decimal(18,2), "
        "avg_balance decimal(18,2), total_transactions bigint, total_credit_amount decimal(18,2), "
        "total_debit_amount decimal(18,2), active_loans bigint, "
        "total_loan_outstanding decimal(18,2), last_transaction_date date, "
        "customer_segment string, risk_score decimal(5,2), _etl_loaded_ts timestamp"
    ),
    "gold_branch_performance": (
        "branch_id string, branch_name string, city string, report_month date, "
        "total_customers bigint, total_accounts bigint, total_deposits decimal(18,2), "
        "total_withdrawals decimal(18,2), net_flow decimal(18,2), "
        "total_loans_disbursed decimal(18,2), active_loans bigint, npa_amount decimal(18,2), "
        "_etl_loaded_ts timestamp"
    ),
    "gold_daily_txn_summary": (
        "transaction_date date, channel string, transaction_type string, total_count bigint, "
        "success_count bigint, failed_count bigint, total_amount decimal(18,2), "
        "avg_amount decimal(18,2), max_amount decimal(18,2), min_amount decimal(18,2), "
        "_etl_loaded_ts timestamp"
    ),
    "gold_loan_portfolio": (
        "loan_type string, report_month date, total_loans bigint, active_loans bigint, "
        "defaulted_loans bigint, total_principal decimal(18,2), total_outstanding decimal(18,2), "
        "avg_interest_rate decimal(5,2), avg_tenure_months decimal(5,1), npa_ratio decimal(5,2), "
        "_etl_loaded_ts timestamp"
    ),
}

# Loader tables kept outside the layers.
LOADER_DDL: dict[str, str] = {
    "sales": (
        "brand string, category string, branch_city string, transaction_date date, "
        "units_sold int, unit_price decimal(12,2), margin_pct decimal(5,2), "
        "profit decimal(14,2), inventory_type string"
    ),
    "account_master": (
        "id bigint, name string, last_name string, acc_number string, city string, "
        "balance decimal(15,2), nominee string, phone_number string, email string, "
        "account_open_date date, record_created_date timestamp"
    ),
}

BUSINESS_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "accounts": ["account_id"],
    "transactions": ["transaction_id"],
    "loans": ["loan_id"],
    "branches": ["branch_id"],
    "product_types": ["product_id"],
    "dim_customer": ["customer_id", "effective_date"],
    "dim_account": ["account_id"],
    "dim_branch": ["branch_id"],
    "dim_product": ["product_id"],
    "dim_date": ["date_sk"],
    "fact_transaction": ["transaction_id"],
    "fact_loan": ["loan_id"],
    "gold_customer_360": ["customer_id"],
    "gold_branch_performance": ["branch_id", "report_month"],
    "gold_daily_txn_summary": ["transaction_date", "channel", "transaction_type"],
    "gold_loan_portfolio": ["loan_type", "report_month"],
}

# Customer attributes whose change opens a new version.
TRACKED_CUSTOMER = ["first_name", "last_name", "phone", "email", "city", "state", "is_active"]

CHANNELS = ["NEFT", "RTGS", "IMPS", "UPI", "ATM", "BRANCH", "NET_BANKING", "MOBILE_BANKING"]
TRANSACTION_TYPES = ["CREDIT", "DEBIT"]
TRANSACTION_STATUSES = ["SUCCESS", "FAILED", "PENDING", "REVERSED"]
ACCOUNT_TYPES = ["SAVINGS", "CURRENT", "SALARY", "NRI", "FD", "RD"]
ACCOUNT_STATUSES = ["ACTIVE", "DORMANT", "CLOSED"]
LOAN_TYPES = ["HOME", "PERSONAL", "CAR", "EDUCATION", "GOLD", "BUSINESS"]
LOAN_STATUSES = ["ACTIVE", "CLOSED", "DEFAULT", "RESTRUCTURED"]
SEGMENTS = ["PLATINUM", "GOLD", "SILVER", "BASIC"]
GENDERS = ["Male", "Female", "Other"]

PHONE_PATTERN = r"^\+91[6-9]\d{9}$"
PAN_PATTERN = r"^[A-Z]{5}\d{4}[A-Z]$"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
TWELVE_DIGITS = r"^\d{12}$"


_SIMPLE: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "date": DateType(),
    "timestamp": TimestampType(),
}


def _struct(ddl: str) -> StructType:
    """Column list to StructType; unlike StructType.fromDDL this needs no running session."""
    schema = StructType()
    for name, kind in (column.split(" ") for column in ddl.split(", ")):
        money = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
        schema.add(name, DecimalType(*map(int, money.groups())) if money else _SIMPLE[kind])
    return schema


def bronze_schema(entity: str, audit: bool = False) -> StructType:
    ddl = ", ".join(f"{name} string" for name in BRONZE_COLUMNS[entity])
    return _struct(f"{ddl}, {AUDIT}" if audit else ddl)


def table_schema(table: str) -> StructType:
    """Schema of a conformed, mart or loader table, or of `bronze_<entity>` with audit columns."""
    if table.startswith("bronze_"):
        return bronze_schema(table.removeprefix("bronze_"), audit=True)
    return _struct({**SILVER_DDL, **GOLD_DDL, **LOADER_DDL}[table])


ALL_TABLES = [f"bronze_{e}" for e in BRONZE_COLUMNS] + list(SILVER_DDL) + list(GOLD_DDL)
