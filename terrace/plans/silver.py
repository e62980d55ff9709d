"""Conformed layer: raw text tables to typed dimensions and facts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators.history import open_versions, scd2_merge
from terrace.operators.rows import dedup_latest, lookup
from terrace.plans.mapping import SILVER_MAPPINGS, apply_mapping
from terrace.schemas import TRACKED_CUSTOMER, table_schema


def _load_time(loaded_at: datetime | None) -> Column:
    return F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")


def _contract(df: DataFrame, table: str, loaded_at: datetime | None) -> DataFrame:
    """Columns of the table contract, in its order and types."""
    return df.withColumn("_etl_loaded_ts", _load_time(loaded_at)).to(table_schema(table))


def _latest(df: DataFrame, key: str) -> DataFrame:
    newest = [F.col("_ingestion_ts").desc_nulls_last()] if "_ingestion_ts" in df.columns else []
    return dedup_latest(df, [key], newest)


def conform_customers(customers: DataFrame, as_of: date | str) -> DataFrame:
    """Cleansed customer attributes, latest row per customer, without version columns."""
    day = F.lit(str(as_of)).cast("date")
    return apply_mapping(_latest(customers, "customer_id"), SILVER_MAPPINGS["dim_customer"](day))


def dim_customer(
    customers: DataFrame,
    as_of: date | str,
    effective: date | str | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Initial load: one open version per customer, from `effective` (default: `as_of`)."""
    opened = open_versions(
        conform_customers(customers, as_of), "customer_id", "customer_sk", effective or as_of)
    return _contract(opened, "dim_customer", loaded_at)


def merge_dim_customer(
    versions: DataFrame,
    customers: DataFrame,
    as_of: date | str,
    effective: date | str,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """The customer dimension after one more day's raw customers."""
    merged = scd2_merge(
        versions.drop("_etl_loaded_ts"), conform_customers(customers, as_of),
        "customer_id", "customer_sk", TRACKED_CUSTOMER, effective)
    return _contract(merged, "dim_customer", loaded_at)


def _keyed_dimension(df: DataFrame, table: str, key: str, sk: str,
                     loaded_at: datetime | None) -> DataFrame:
    mapped = apply_mapping(_latest(df, key), SILVER_MAPPINGS[table]())
    return _contract(mapped.withColumn(sk, C.surrogate_key(F.col(key))), table, loaded_at)


def dim_account(accounts: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return _keyed_dimension(accounts, "dim_account", "account_id", "account_sk", loaded_at)


def dim_branch(branches: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return _keyed_dimension(branches, "dim_branch", "branch_id", "branch_sk", loaded_at)


def dim_product(products: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return _keyed_dimension(products, "dim_product", "product_id", "product_sk", loaded_at)


def whole_years(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Bounds of a calendar that doesn't hang on the days that happen to be in the facts."""
    days = f"date '{first:04d}-01-01' AS first_day", f"date '{last:04d}-12-31' AS last_day"
    return spark.range(1).selectExpr(*days)


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day of every whole year touched by `bounds` (one row: first_day, last_day)."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    span = F.sequence(
        F.trunc("first_day", "year"), F.date_sub(F.add_months(F.trunc("last_day", "year"), 12), 1))
    days = bounds.select(F.explode(span).alias("full_date")).select(
        C.date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.when(weekday >= 6, "Y").otherwise("N").alias("is_weekend"),
        F.lit("N").alias("is_holiday"),
        C.fiscal_year(day).alias("fiscal_year"),
        C.fiscal_quarter(day).alias("fiscal_quarter"),
    )
    return days.to(table_schema("dim_date"))


def date_bounds(df: DataFrame, *day_columns: str) -> DataFrame:
    """First and last day over the given date columns."""
    lows = [F.min(c) for c in day_columns]
    highs = [F.max(c) for c in day_columns]
    return df.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("first_day"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("last_day"))


def _current_keys(customers: DataFrame) -> DataFrame:
    return customers.filter("is_current = 'Y'").select("customer_id", "customer_sk")


def typed_transactions(transactions: DataFrame) -> DataFrame:
    """Raw transactions with typed columns, before any key is resolved."""
    return apply_mapping(transactions, SILVER_MAPPINGS["fact_transaction"]())


def typed_loans(loans: DataFrame) -> DataFrame:
    """The latest state of each loan with typed columns, before any key is resolved."""
    return apply_mapping(_latest(loans, "loan_id"), SILVER_MAPPINGS["fact_loan"]())


def fact_transaction(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """All raw transactions with typed columns and resolved keys; unresolved keys are null.

    The account side is resolved to customer and branch first, so the transactions - by far
    the largest input - are joined, and shuffled, once instead of three times.
    """
    return resolved_transactions(typed_transactions(transactions), accounts, customers, branches, loaded_at)


def resolved_transactions(
    typed: DataFrame, accounts: DataFrame, customers: DataFrame, branches: DataFrame, loaded_at: datetime | None = None,
) -> DataFrame:
    """Typed transactions with their keys resolved, by the fact's contract."""
    route = accounts.select("account_id", "account_sk", "customer_id", "branch_id")
    route = lookup(route, _current_keys(customers), "customer_id")
    route = lookup(route, branches.select("branch_id", "branch_sk"), "branch_id")
    route = route.select("account_id", "account_sk", "customer_sk", "branch_sk")
    keyed = lookup(typed, route, "account_id").withColumns({
        "transaction_sk": C.surrogate_key(F.col("transaction_id")),
        "date_sk": C.date_key(F.col("transaction_date")),
    })
    return _contract(keyed, "fact_transaction", loaded_at)


def fact_loan(
    loans: DataFrame,
    customers: DataFrame,
    branches: DataFrame,
    products: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """One row per loan, the latest state sent, with resolved keys."""
    keyed = lookup(typed_loans(loans), _current_keys(customers), "customer_id")
    keyed = lookup(keyed, branches.select("branch_id", "branch_sk"), "branch_id")
    keyed = lookup(keyed, products.select("product_id", "product_sk"), "product_id")
    keyed = keyed.withColumn("loan_sk", C.surrogate_key(F.col("loan_id")))
    return _contract(keyed, "fact_loan", loaded_at)
