"""Layer jobs: landing files to raw, raw to conformed, conformed to marts.

Each table is written once to a folder of its own and read back by the next step, so a
lost executor costs a task, not the chain, and no input is overwritten while it is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import history
from terrace.operators.rows import drop_known
from terrace.plans import gold, silver
from terrace.plans.facts import FactStore
from terrace.schemas import table_schema
from terrace.session import cut_lineage, free_shuffles, scratch
from terrace.sources import files
from terrace.sources.tables import write_table


@dataclass(frozen=True)
class Landing:
    """A landing file: entity, path and format (`csv`, `csv_header` or `json`)."""

    entity: str
    path: str
    format: str = "csv"
    multi_line: bool = False

    def scan(self, spark: SparkSession) -> DataFrame:
        if self.format == "json":
            return files.scan_json(spark, self.path, self.entity, self.multi_line)
        if self.format == "csv_header":
            return files.scan_csv_header(spark, self.path)
        return files.scan_csv(spark, self.path, self.entity)


def source_to_bronze(
    spark: SparkSession, landing: list[Landing], bronze: str, mode: str = "overwrite",
    batch_id: str | None = None, ingested_at: datetime | None = None,
) -> tuple[str, dict[str, int]]:
    """Store all entities under one load id; returns it with the rows written per table."""
    batch = batch_id or uuid.uuid4().hex[:8]
    written = {}
    for source in landing:
        audited = files.add_audit(source.scan(spark), batch, ingested_at=ingested_at)
        table = f"bronze_{source.entity}"
        written[table] = write_table(audited, f"{bronze}/{table}", mode)
    return batch, written


#: Transactions that break one of these go to quarantine instead of into the fact.
FACT_RULES = {
    "no id": "transaction_id IS NULL OR trim(transaction_id) = ''",
    "no amount": "amount IS NULL", "no date": "transaction_date IS NULL"}


def fact_store(spark: SparkSession, path: str) -> FactStore:
    """The stored transactions, by month and load."""
    return FactStore(spark, path, table_schema("fact_transaction"), "transaction_id", "transaction_date")


def _append_facts(
    spark: SparkSession, incoming: DataFrame, resolve: Callable[[DataFrame], DataFrame], path: str, rejected: str,
    load: str | None,
) -> dict[str, int]:
    """Store valid transactions that are not stored yet, one row per id, and set aside the others.

    `incoming` is typed; the rules ask for nothing that `resolve` adds, so only rows to be stored are resolved.
    """
    rules = {name: F.expr(rule) for name, rule in FACT_RULES.items()}
    with scratch(spark) as folder:
        valid, broken = history.quarantine(cut_lineage(incoming, folder), rules)
        added = fact_store(spark, path).add(valid, load, [F.col("transaction_date").desc()], resolve)
        _, judged = history.quarantine(resolve(broken), rules)
        return {"fact_transaction": added, "quarantine_transaction": write_table(judged, rejected)}


def _longer_calendar(spark: SparkSession, calendar: DataFrame, rows: DataFrame) -> DataFrame:
    """The stored calendar, with the days of all years up to those of the rows; stored days stay as they are."""
    both = silver.date_bounds(calendar, "full_date").unionByName(silver.date_bounds(rows, "transaction_date"))
    span = both.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    return calendar.unionByName(drop_known(silver.dim_date(span), calendar, ["date_sk"]))


def bronze_to_silver(
    spark: SparkSession, bronze: str, target: str, as_of: date | str,
    effective: date | str | None = None, loaded_at: datetime | None = None,
    facts: str | None = None, years: tuple[int, int] | None = None, load: str | None = None,
) -> dict[str, int]:
    """The first load. Dimensions first; the facts look keys up in the stored dimensions.

    `facts` is the folder of the transactions, which later loads add to; by default it lies in
    `target`. `years` bounds the calendar; without it, the transactions do. `load` names the load; one
    that is repeated under its name adds no transactions.
    """
    facts = facts or f"{target}/fact_transaction"

    def raw(entity: str) -> DataFrame:
        return files.scan_parquet(spark, bronze, f"bronze_{entity}")

    written: dict[str, int] = {}

    def store(table: str, df: DataFrame) -> DataFrame:
        written[table] = write_table(df, f"{target}/{table}")
        free_shuffles(spark)
        return files.scan_parquet(spark, target, table)

    customers = store("dim_customer", silver.dim_customer(
        raw("customers"), as_of, effective, loaded_at))
    accounts = store("dim_account", silver.dim_account(raw("accounts"), loaded_at))
    branches = store("dim_branch", silver.dim_branch(raw("branches"), loaded_at))
    products = store("dim_product", silver.dim_product(raw("product_types"), loaded_at))
    written |= _append_facts(
        spark, silver.typed_transactions(raw("transactions")),
        lambda df: silver.resolved_transactions(df, accounts, customers, branches, loaded_at), facts,
        f"{target}/quarantine_transaction", load)
    store("fact_loan", silver.fact_loan(raw("loans"), customers, branches, products, loaded_at))
    bounds = silver.whole_years(spark, *years) if years else silver.date_bounds(
        fact_store(spark, facts).rows(), "transaction_date")
    store("dim_date", silver.dim_date(bounds))
    return written


def update_silver(
    spark: SparkSession, bronze: str, current: str, target: str, facts: str,
    as_of: date | str, effective: date | str, loaded_at: datetime | None = None, load: str | None = None,
) -> dict[str, int]:
    """One more load onto the layer stored in `current`; the new dimensions and loans go to `target`.

    `bronze` holds the raw tables of this load. Customers are merged into their versions, valid from
    `effective`; accounts, branches and products are upserted; of loans the latest state wins.
    Transactions are added to `facts` where their ids are not there yet, under whatever month, in the
    months that they touch, and the calendar is extended to them. Loading the same again changes
    nothing.
    """
    def raw(entity: str) -> DataFrame:
        return files.scan_parquet(spark, bronze, f"bronze_{entity}")

    written: dict[str, int] = {}

    def store(table: str, df: DataFrame) -> DataFrame:
        written[table] = write_table(df, f"{target}/{table}")
        free_shuffles(spark)
        return files.scan_parquet(spark, target, table)

    def upsert(table: str, incoming: DataFrame, key: str) -> DataFrame:
        known = files.scan_parquet(spark, current, table)
        return store(table, history.scd1_upsert(known, incoming, [key]))

    customers = store("dim_customer", silver.merge_dim_customer(
        files.scan_parquet(spark, current, "dim_customer"), raw("customers"), as_of, effective,
        loaded_at))
    accounts = upsert("dim_account", silver.dim_account(raw("accounts"), loaded_at), "account_id")
    branches = upsert("dim_branch", silver.dim_branch(raw("branches"), loaded_at), "branch_id")
    products = upsert("dim_product", silver.dim_product(raw("product_types"), loaded_at), "product_id")
    written |= _append_facts(
        spark, silver.typed_transactions(raw("transactions")),
        lambda df: silver.resolved_transactions(df, accounts, customers, branches, loaded_at), facts,
        f"{target}/quarantine_transaction", load := load or uuid.uuid4().hex)
    upsert("fact_loan", silver.fact_loan(raw("loans"), customers, branches, products, loaded_at), "loan_id")
    store("dim_date", _longer_calendar(
        spark, files.scan_parquet(spark, current, "dim_date"), fact_store(spark, facts).staged(load)))
    return written


def silver_to_gold(
    spark: SparkSession, source: str, target: str, loaded_at: datetime | None = None,
    facts: str | None = None,
) -> dict[str, int]:
    def table(name: str) -> DataFrame:
        return files.scan_parquet(spark, source, name)

    customers, accounts, branches = map(table, ("dim_customer", "dim_account", "dim_branch"))
    transactions = fact_store(spark, facts or f"{source}/fact_transaction").rows()
    loans = table("fact_loan")
    marts: Mapping[str, DataFrame] = {
        "gold_customer_360": gold.customer_360(
            customers, accounts, transactions, loans, loaded_at),
        "gold_branch_performance": gold.branch_performance(
            branches, accounts, transactions, loans, loaded_at),
        "gold_daily_txn_summary": gold.daily_txn_summary(transactions, loaded_at),
        "gold_loan_portfolio": gold.loan_portfolio(loans, loaded_at),
    }
    return {name: write_table(df, f"{target}/{name}") for name, df in marts.items()}
