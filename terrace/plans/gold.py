"""Marts over the conformed layer.

Facts are pre-aggregated on their own foreign key before any join, so what is joined is
already one row per key and a key with very many facts is combined in the map tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.schemas import table_schema


def _finish(df: DataFrame, table: str, loaded_at: datetime | None) -> DataFrame:
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.withColumn("_etl_loaded_ts", stamp).to(table_schema(table))


def _sum_if(condition: Column, amount: str) -> Column:
    return F.sum(F.when(condition, F.col(amount)).otherwise(F.lit(0)))


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


def _mean(column: str) -> Column:
    """Sum over count in decimal arithmetic, so that exact halves round up."""
    return F.try_divide(F.sum(column).cast("decimal(25,2)"), F.count(column))


def transaction_parts() -> list[Column]:
    """What a group of transactions contributes to the marts; parts of a group add up."""
    return [F.count("transaction_id").alias("n"),
            _sum_if(_is("transaction_type", "CREDIT"), "amount").alias("credit"),
            _sum_if(_is("transaction_type", "DEBIT"), "amount").alias("debit"),
            F.max("transaction_date").alias("last_date"),
            F.count_if(F.col("status").isin("FAILED", "REVERSED")).alias("unsuccessful")]


def parts_together() -> list[Column]:
    return [F.sum("n").alias("n"), F.sum("credit").alias("credit"), F.sum("debit").alias("debit"),
            F.max("last_date").alias("last_date"), F.sum("unsuccessful").alias("unsuccessful")]


def account_measures(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per customer, in one grouping of the accounts: accounts, balances, and what was done on them.

    Takes the stored fact, typed transactions that still carry the account's own id, or stored parts.
    They are added up per account first, so the join sees one row per account.
    """
    key = "account_sk" if "account_sk" in transactions.columns else "account_id"
    per_account = transactions.groupBy(key).agg(
        *(parts_together() if "unsuccessful" in transactions.columns else transaction_parts()))
    active = _is("status", "ACTIVE")
    balance = F.when(active, F.col("balance"))
    return accounts.select(*dict.fromkeys((key, "account_id", "customer_id", "status", "balance"))).join(
        per_account, key, "left").groupBy("customer_id").agg(
        F.count("account_id").alias("total_accounts"),
        F.count_if(active).alias("active_accounts"),
        F.sum(balance).alias("total_balance"),
        F.try_divide(F.sum(balance), F.count(balance)).alias("avg_balance"),
        F.sum("n").alias("total_transactions"),
        F.sum("credit").alias("total_credit_amount"),
        F.sum("debit").alias("total_debit_amount"),
        F.max("last_date").alias("last_transaction_date"),
        F.sum("unsuccessful").alias("unsuccessful_transactions"),
    )


def loan_measures(loans: DataFrame, customer_versions: DataFrame) -> DataFrame:
    """Per customer over all versions: loans granted to an expired version still count.

    Takes the stored fact, or typed loans, which carry the customer's own id and need no join.
    """
    resolved = "customer_sk" in loans.columns
    per_version = loans.groupBy("customer_sk" if resolved else "customer_id").agg(
        F.count("*").alias("n"),
        F.count_if(_is("status", "ACTIVE")).alias("active"),
        F.count_if(_is("status", "DEFAULT")).alias("defaulted"),
        F.sum("outstanding_amount").alias("outstanding"),
        F.sum("principal_amount").alias("principal"),
    )
    if not resolved:
        return per_version.toDF("customer_id", "loans", "active_loans", "default_loans", "total_loan_outstanding",
                                "total_principal")
    owner = customer_versions.select("customer_sk", "customer_id")
    return per_version.join(owner, "customer_sk").groupBy("customer_id").agg(
        F.sum("n").alias("loans"),
        F.sum("active").alias("active_loans"),
        F.sum("defaulted").alias("default_loans"),
        F.sum("outstanding").alias("total_loan_outstanding"),
        F.sum("principal").alias("total_principal"),
    )


def risk_score() -> Column:
    """0 to 100 from default share, unsuccessful-transaction share and debt share."""
    return C.round_half_up(
        F.lit(100.0) * (
            F.lit(0.5) * C.share(F.col("default_loans"), F.col("loans"))
            + F.lit(0.3) * C.share(F.col("unsuccessful_transactions"), F.col("total_transactions"))
            + F.lit(0.2) * F.least(
                F.lit(1.0), C.share(F.col("total_loan_outstanding"), F.col("total_principal")))
        ), 2)


def customer_360(
    customer_versions: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    loans: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """One row per current customer; balances are those of ACTIVE accounts."""
    base = customer_versions.filter("is_current = 'Y'").select(
        "customer_id", "full_name", "city", "state", "customer_since")
    assembled = (
        base.join(account_measures(accounts, transactions), "customer_id", "left")
        .join(loan_measures(loans, customer_versions), "customer_id", "left")
        .fillna(0)
    )
    scored = assembled.withColumns({
        "customer_segment": C.segment_for(F.col("total_balance")),
        "risk_score": risk_score(),
    })
    return _finish(scored, "gold_customer_360", loaded_at)


def segment_by_turnover(mart: DataFrame) -> DataFrame:
    """The same thresholds applied to credit turnover instead of balance."""
    return mart.select(
        "customer_id", "total_credit_amount",
        C.segment_for(F.col("total_credit_amount")).alias("turnover_segment"))


def branch_performance(
    branches: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    loans: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Branch by month. Account and loan totals are per branch and repeat on each month.

    Transactions and loans may come without a resolved branch: they are then added up by account
    and month, or by branch id, before the branch is looked up. Transactions may come as stored parts.
    """
    stored = "unsuccessful" in transactions.columns
    flows = [F.sum("credit").alias("total_deposits"), F.sum("debit").alias("total_withdrawals")] if stored else [
        _sum_if(_is("transaction_type", "CREDIT"), "amount").alias("total_deposits"),
        _sum_if(_is("transaction_type", "DEBIT"), "amount").alias("total_withdrawals")]
    resolved = "branch_sk" in transactions.columns
    monthly = transactions.groupBy(
        "branch_sk" if resolved else "account_id",
        # A part lies in one month, so any of its days tells it.
        C.month_start(F.col("last_date" if stored else "transaction_date")).alias("report_month")).agg(*flows)
    keys = branches.select("branch_id", "branch_sk")
    if not resolved:
        route = accounts.select("account_id", "branch_id").join(keys, "branch_id", "left")
        monthly = monthly.join(route, "account_id", "left").groupBy("branch_sk", "report_month").agg(
            F.sum("total_deposits").alias("total_deposits"),
            F.sum("total_withdrawals").alias("total_withdrawals"))
    monthly = monthly.withColumn("net_flow", F.col("total_deposits") - F.col("total_withdrawals"))
    # Rows per (branch, customer) first, so that a branch holding a third of all accounts is
    # counted in parts.
    per_branch = (
        accounts.groupBy("branch_id", "customer_id").agg(F.count("account_id").alias("n"))
        .groupBy("branch_id")
        .agg(F.count("customer_id").alias("total_customers"), F.sum("n").alias("total_accounts"))
    )
    lent_by = "branch_sk" if "branch_sk" in loans.columns else "branch_id"
    lending = loans.groupBy(lent_by).agg(
        F.sum("principal_amount").alias("total_loans_disbursed"),
        F.count_if(_is("status", "ACTIVE")).alias("active_loans"),
        _sum_if(_is("status", "DEFAULT"), "outstanding_amount").alias("npa_amount"))
    profile = (
        branches.select("branch_sk", "branch_id", "branch_name", "city")
        .join(per_branch, "branch_id", "left")
        .join(lending, lent_by, "left")
    )
    assembled = monthly.join(profile, "branch_sk", "left").fillna(0)
    return _finish(assembled, "gold_branch_performance", loaded_at)


def daily_txn_summary(transactions: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    grouped = transactions.groupBy("transaction_date", "channel", "transaction_type").agg(
        F.count("*").alias("total_count"),
        F.count_if(_is("status", "SUCCESS")).alias("success_count"),
        F.count_if(_is("status", "FAILED")).alias("failed_count"),
        F.sum("amount").alias("total_amount"),
        _mean("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
    )
    return _finish(grouped, "gold_daily_txn_summary", loaded_at)


def loan_portfolio(loans: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    grouped = loans.groupBy(
        "loan_type", C.month_start(F.col("disburse_date")).alias("report_month")
    ).agg(
        F.count("*").alias("total_loans"),
        F.count_if(_is("status", "ACTIVE")).alias("active_loans"),
        F.count_if(_is("status", "DEFAULT")).alias("defaulted_loans"),
        F.sum("principal_amount").alias("total_principal"),
        F.sum("outstanding_amount").alias("total_outstanding"),
        _mean("interest_rate").alias("avg_interest_rate"),
        _mean("tenure_months").alias("avg_tenure_months"),
    )
    rated = grouped.withColumn(
        "npa_ratio", C.percent(F.col("defaulted_loans"), F.col("total_loans")))
    return _finish(rated, "gold_loan_portfolio", loaded_at)
