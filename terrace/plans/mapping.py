"""Source-to-target mappings as data: target column to Spark expression.

A mapping is applied in one projection. Keys, joins, version columns and load time are added
by the table builders and are listed in `ADDED_BY_BUILDER`, so that conformance of mapping
and table contract can be checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.schemas import table_schema

Mapping = dict[str, Column]


def keep(*names: str) -> Mapping:
    return {n: F.col(n) for n in names}


def trimmed(*names: str) -> Mapping:
    return {n: F.trim(F.col(n)) for n in names}


def titled(*names: str) -> Mapping:
    return {n: C.title(n) for n in names}


def coded(*names: str) -> Mapping:
    return {n: C.code(n) for n in names}


def dated(*names: str) -> Mapping:
    return {n: C.tolerant_date(n) for n in names}


def typed(dtype: str, *names: str) -> Mapping:
    return {n: C.tolerant_cast(n, dtype) for n in names}


def _customer(as_of: Column) -> Mapping:
    return {
        **keep("customer_id", "is_active"),
        **titled("first_name", "last_name", "city", "state"),
        "full_name": F.concat_ws(" ", C.title("first_name"), C.title("last_name")),
        **dated("date_of_birth", "customer_since"),
        "age": C.age_in_years(C.tolerant_date("date_of_birth"), as_of),
        "gender": C.gender_label("gender"),
        **trimmed("phone", "aadhar_number", "pin_code"),
        "email": F.lower(F.trim("email")),
        **coded("pan_number"),
    }


def _account() -> Mapping:
    return {
        **keep("account_id", "customer_id", "account_number", "product_id", "branch_id",
               "currency"),
        **coded("account_type", "ifsc_code", "status"),
        **typed("decimal(15,2)", "balance"),
        **dated("open_date", "close_date"),
        **titled("nominee_name"),
    }


def _branch() -> Mapping:
    return {
        **keep("branch_id", "branch_code", "is_active"),
        **trimmed("branch_name", "pin_code", "phone"),
        **coded("ifsc_code"),
        **titled("city", "state", "manager_name"),
        **dated("established_date"),
    }


def _product() -> Mapping:
    return {
        **keep("product_id"),
        **trimmed("product_name"),
        **coded("product_category"),
        **typed("decimal(5,2)", "interest_rate"),
    }


def _transaction() -> Mapping:
    return {
        **keep("transaction_id", "account_id", "transaction_time", "currency", "description",
               "beneficiary_acc", "reference_number"),
        **coded("transaction_type", "channel", "status"),
        **dated("transaction_date"),
        **typed("decimal(15,2)", "amount"),
    }


def _loan() -> Mapping:
    return {
        **keep("loan_id", "customer_id", "branch_id", "product_id"),
        **coded("loan_type", "status", "collateral_type"),
        **typed("decimal(15,2)", "principal_amount", "emi_amount", "outstanding_amount"),
        **typed("decimal(5,2)", "interest_rate"),
        **typed("int", "tenure_months"),
        **dated("disburse_date", "maturity_date"),
    }


SILVER_MAPPINGS: dict[str, Callable[..., Mapping]] = {
    "dim_customer": _customer,
    "dim_account": _account,
    "dim_branch": _branch,
    "dim_product": _product,
    "fact_transaction": _transaction,
    "fact_loan": _loan,
}

# Columns the table builders add to the mapped ones.
ADDED_BY_BUILDER: dict[str, list[str]] = {
    "dim_customer": ["customer_sk", "effective_date", "expiry_date", "is_current",
                     "_etl_loaded_ts"],
    "dim_account": ["account_sk", "_etl_loaded_ts"],
    "dim_branch": ["branch_sk", "_etl_loaded_ts"],
    "dim_product": ["product_sk", "_etl_loaded_ts"],
    "fact_transaction": ["transaction_sk", "account_sk", "customer_sk", "branch_sk", "date_sk",
                         "_etl_loaded_ts"],
    "fact_loan": ["loan_sk", "customer_sk", "branch_sk", "product_sk", "_etl_loaded_ts"],
}
# Mapped columns that serve a join and are not part of the table.
JOIN_ONLY: dict[str, list[str]] = {
    "fact_transaction": ["account_id"],
    "fact_loan": ["customer_id", "branch_id", "product_id"],
}


def apply_mapping(df: DataFrame, mapping: Mapping) -> DataFrame:
    return df.select(*(expr.alias(target) for target, expr in mapping.items()))


def mapping_targets(table: str) -> list[str]:
    build = SILVER_MAPPINGS[table]
    mapped = build(F.lit("2000-01-01").cast("date")) if table == "dim_customer" else build()
    kept = [c for c in mapped if c not in JOIN_ONLY.get(table, [])]
    return kept + ADDED_BY_BUILDER[table]


def mapping_conformance(spark: SparkSession) -> DataFrame:
    """Contract columns against mapping targets: (table, column, in_contract, in_mapping)."""
    rows = []
    for table in SILVER_MAPPINGS:
        contract, mapped = set(table_schema(table).names), set(mapping_targets(table))
        rows += [(table, c, c in contract, c in mapped) for c in sorted(contract | mapped)]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, in_contract boolean, in_mapping boolean")
