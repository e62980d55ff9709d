"""Registered queries: conformed tables, marts and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators import history, rows
from terrace.plans import gold, mapping, silver
from terrace.registry.common import SECOND_DAY, Tables, query
from terrace.registry.layers_sql import columns_of, conformed_customers, sk
from terrace.schemas import BRONZE_COLUMNS, table_schema
from terrace.sources import given
from terrace.sources.tables import catalog_columns


def _table(name: str, source: str) -> str:
    return f"SELECT {columns_of(name)} FROM {source}"


query("dim_customer", _table("dim_customer", "s_dim_customer"))(lambda t: t.customers)
query("dim_account", _table("dim_account", "s_dim_account"))(lambda t: t.accounts)
query("dim_branch", _table("dim_branch", "s_dim_branch"))(lambda t: t.branches)
query("dim_product", _table("dim_product", "s_dim_product"))(lambda t: t.products)
query("dim_date", _table("dim_date", "s_dim_date"))(lambda t: t.calendar)
query("fact_transaction", _table("fact_transaction", "s_fact_transaction"))(
    lambda t: t.transactions)
query("fact_loan", _table("fact_loan", "s_fact_loan"))(lambda t: t.loans)
query("gold_customer_360", _table("gold_customer_360", "g_customer_360"))(
    lambda t: t.customer_360)
query("gold_branch_performance", _table("gold_branch_performance", "g_branch_performance"))(
    lambda t: t.branch_performance)
query("gold_daily_txn_summary", _table("gold_daily_txn_summary", "g_daily_txn_summary"))(
    lambda t: t.daily_summary)
query("gold_loan_portfolio", _table("gold_loan_portfolio", "g_loan_portfolio"))(
    lambda t: t.loan_portfolio)


@query("gold_segment_by_turnover", """
  SELECT customer_id, cast(total_credit_amount as double) AS total_credit_amount,
    CASE WHEN total_credit_amount >= 1000000 THEN 'PLATINUM'
         WHEN total_credit_amount >= 500000 THEN 'GOLD'
         WHEN total_credit_amount >= 100000 THEN 'SILVER' ELSE 'BASIC' END AS turnover_segment
  FROM g_customer_360""")
def segment_by_turnover(t: Tables) -> DataFrame:
    return gold.segment_by_turnover(t.customer_360)


@query("gold_risk_score", """
  SELECT customer_id, customer_segment, cast(risk_score as double) AS risk_score
  FROM g_customer_360""")
def risk_score(t: Tables) -> DataFrame:
    return t.customer_360.select("customer_id", "customer_segment", "risk_score")


# --- history -------------------------------------------------------------------------------

query("scd2_merge", _table("dim_customer", "v_merged"))(lambda t: t.versions)


@query("scd2_gap_check", """
  SELECT customer_id, cast(effective_date as varchar) AS effective_date,
    cast(expiry_date as varchar) AS expiry_date, cast(next_effective as varchar) AS next_effective
  FROM (SELECT *, lead(effective_date) OVER (PARTITION BY customer_id ORDER BY effective_date)
          AS next_effective
        FROM (SELECT customer_id, effective_date, CASE WHEN state = 'Asia' AND is_current = 'N'
                THEN expiry_date - 5 ELSE expiry_date END AS expiry_date FROM v_merged))
  WHERE next_effective <> expiry_date + 1""")
def scd2_gap_check(t: Tables) -> DataFrame:
    # Old versions in one region end too early here, so that there are gaps to find.
    early = (F.col("state") == "Asia") & (F.col("is_current") == "N")
    damaged = t.versions.withColumn("expiry_date", F.when(
        early, F.date_sub("expiry_date", 5)).otherwise(F.col("expiry_date")))
    return history.version_gaps(damaged, "customer_id")


@query("join_scd2_asof", """
  SELECT t.transaction_id, a.customer_id, cast(t.transaction_date as varchar) AS transaction_date,
    v.customer_sk AS version_sk, v.city AS version_city
  FROM s_fact_transaction t LEFT JOIN s_dim_account a ON a.account_sk = t.account_sk
    LEFT JOIN v_merged v ON v.customer_id = a.customer_id
      AND t.transaction_date BETWEEN v.effective_date AND v.expiry_date""")
def join_scd2_asof(t: Tables) -> DataFrame:
    facts = t.typed_transactions.select("transaction_id", "account_id", "transaction_date").join(
        t.accounts.select("account_id", "customer_id"), "account_id", "left").drop("account_id")
    versions = t.versions.withColumnsRenamed({"customer_sk": "version_sk", "city": "version_city"})
    return history.version_as_of(
        facts, versions, "customer_id", "transaction_date", ["version_sk", "version_city"])


@query("scd1_upsert", f"""
  SELECT {columns_of('dim_account')} FROM (
    SELECT * REPLACE (
      CASE WHEN status = 'DORMANT' THEN 'CLOSED' ELSE status END AS status,
      CASE WHEN status = 'DORMANT' THEN date '{SECOND_DAY}' ELSE close_date END AS close_date)
    FROM s_dim_account)""")
def scd1_upsert(t: Tables) -> DataFrame:
    # Dormant accounts arrive again as closed ones.
    closures = t.accounts.filter("status = 'DORMANT'").withColumns({
        "status": F.lit("CLOSED"), "close_date": F.lit(SECOND_DAY).cast("date")})
    return history.scd1_upsert(t.accounts, closures, ["account_id"])


_CDC_COMPARED = [c for c in BRONZE_COLUMNS["customers"] if c != "customer_id"]


@query("cdc_classify", f"""
  SELECT change, count(*) AS keys, cast(sum(copies) as bigint) AS duplicate_rows FROM (
    SELECT CASE WHEN o.customer_id IS NULL THEN 'NEW' WHEN n.customer_id IS NULL THEN 'MISSING'
        WHEN {' OR '.join(f'o.{c} IS DISTINCT FROM n.{c}' for c in _CDC_COMPARED)} THEN 'CHANGED'
        ELSE 'UNCHANGED' END AS change, coalesce(copies, 1) - 1 AS copies
    FROM b_first_load o FULL JOIN (
      SELECT *, count(*) AS copies FROM b_customers_day2 GROUP BY ALL) n
      ON n.customer_id = o.customer_id)
  GROUP BY change""")
def cdc_classify(t: Tables) -> DataFrame:
    known = t.raw("customers").filter(F.col("customer_since") < given.FIRST_LOAD)
    return history.change_counts(history.classify_changes(
        known, t.raw("customers_day2"), "customer_id", _CDC_COMPARED))


# The first load has what was reported in time; the second everything, late rows included.
_ON_TIME = f"transaction_date < '{given.TRANSACTION_CUTOFF}' AND status <> 'REVERSED'"


@query("late_arrival_merge", f"""
  SELECT substring(day, 1, 7) AS month, count(*) AS appended,
    count(*) FILTER (WHERE day < '{given.TRANSACTION_CUTOFF}') AS late
  FROM (SELECT transaction_id, max(transaction_date) AS day FROM b_transactions
        GROUP BY transaction_id)
  WHERE transaction_id NOT IN (SELECT transaction_id FROM b_transactions WHERE {_ON_TIME})
  GROUP BY ALL""")
def late_arrival_merge(t: Tables) -> DataFrame:
    batch = t.raw("transactions")
    appended = history.append_unseen(
        batch.filter(_ON_TIME), batch, "transaction_id",
        newest_first=[F.col("transaction_date").desc()])
    late = F.col("transaction_date") < given.TRANSACTION_CUTOFF
    return appended.groupBy(F.substring("transaction_date", 1, 7).alias("month")).agg(
        F.count("*").alias("appended"), F.count_if(late).alias("late"))


@query("surrogate_key", f"""
  SELECT transaction_id, {sk('transaction_id')} AS transaction_sk,
    {sk('transaction_id', 'transaction_date')} AS dated_sk FROM b_transactions""")
def surrogate_key(t: Tables) -> DataFrame:
    return t.raw("transactions").select(
        "transaction_id",
        C.surrogate_key(F.col("transaction_id")).alias("transaction_sk"),
        C.surrogate_key(F.col("transaction_id"), F.col("transaction_date")).alias("dated_sk"))


def rejections():
    day, amount = C.tolerant_date("transaction_date"), C.tolerant_cast("amount", "decimal(15,2)")
    return {
        "blank_account": C.null_or_blank("account_id"),
        "bad_date": day.isNull(),
        "future_date": day > F.lit("2002-01-01").cast("date"),
        "bad_amount": amount.isNull(),
        "negative_amount": amount < 0,
        "zero_amount": amount == 0,
    }


@query("dq_quarantine", """
  SELECT transaction_id, account_id, transaction_date, amount, concat_ws(',',
    CASE WHEN account_id IS NULL OR trim(account_id) = '' THEN 'blank_account' END,
    CASE WHEN d IS NULL THEN 'bad_date' END,
    CASE WHEN d > date '2002-01-01' THEN 'future_date' END,
    CASE WHEN a IS NULL THEN 'bad_amount' END,
    CASE WHEN a < 0 THEN 'negative_amount' END,
    CASE WHEN a = 0 THEN 'zero_amount' END) AS reasons
  FROM (SELECT *, try_cast(transaction_date as date) AS d,
          try_cast(amount as decimal(15,2)) AS a FROM b_transactions_dirty)""")
def dq_quarantine(t: Tables) -> DataFrame:
    judged = history.with_reasons(t.raw("transactions_dirty"), rejections())
    return judged.select("transaction_id", "account_id", "transaction_date", "amount",
                         F.concat_ws(",", "reasons").alias("reasons"))


# --- mapping -------------------------------------------------------------------------------


@query("mapping_apply", "WITH m AS (" + conformed_customers("b_customers_day2") + """)
  SELECT * REPLACE (cast(date_of_birth as varchar) AS date_of_birth,
                    cast(customer_since as varchar) AS customer_since) FROM m""")
def mapping_apply(t: Tables) -> DataFrame:
    return silver.conform_customers(t.raw("customers_day2"), "2002-01-01")


_CONFORMANCE = [
    ("dim_customer", "s_dim_customer"), ("dim_account", "s_dim_account"),
    ("dim_branch", "s_dim_branch"), ("dim_product", "s_dim_product"),
    ("fact_transaction", "s_fact_transaction"), ("fact_loan", "s_fact_loan")]


def _conformance_sql() -> str:
    parts = []
    for table, source in _CONFORMANCE:
        for c in table_schema(table).names:
            n = "count(*)" if c == "_etl_loaded_ts" else f"count({c})"
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                         f"true AS in_contract, true AS in_mapping, {n} AS known_values "
                         f"FROM {source}")
    return " UNION ALL ".join(parts)


@query("mapping_conformance", _conformance_sql())
def mapping_conformance(t: Tables) -> DataFrame:
    built = {"dim_customer": t.customers, "dim_account": t.accounts, "dim_branch": t.branches,
             "dim_product": t.products, "fact_transaction": t.transactions, "fact_loan": t.loans}
    held = catalog_columns(built).select("table_name", "column_name", "known_values")
    return mapping.mapping_conformance(t.spark).join(
        held, ["table_name", "column_name"], "left")


# --- rows and sets -------------------------------------------------------------------------


@query("dedup_latest", f"""
  SELECT {', '.join(BRONZE_COLUMNS['customers'])} FROM b_customers_day2
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY city DESC) = 1""")
def dedup_latest(t: Tables) -> DataFrame:
    return rows.dedup_latest(t.raw("customers_day2"), ["customer_id"], [F.col("city").desc()])


@query("set_distinct", """
  SELECT DISTINCT channel, status, transaction_type FROM s_fact_transaction""")
def set_distinct(t: Tables) -> DataFrame:
    return rows.distinct_keys(t.transactions, "channel", "status", "transaction_type")


@query("set_except", """
  SELECT c_custkey AS customer FROM customer EXCEPT SELECT o_custkey FROM orders""")
def set_except(t: Tables) -> DataFrame:
    return rows.except_distinct(
        t.given("customer").select(F.col("c_custkey").alias("customer")),
        t.given("orders").select("o_custkey"))


@query("set_symmetric_diff", f"""
  SELECT account_id, 'open' AS side FROM (
    SELECT account_id FROM b_accounts WHERE status <> 'CLOSED'
    EXCEPT SELECT account_id FROM b_transactions
      WHERE transaction_date >= '{given.TRANSACTION_CUTOFF}')
  UNION ALL
  SELECT account_id, 'active since cutoff' AS side FROM (
    SELECT account_id FROM b_transactions WHERE transaction_date >= '{given.TRANSACTION_CUTOFF}'
    EXCEPT SELECT account_id FROM b_accounts WHERE status <> 'CLOSED')""")
def set_symmetric_diff(t: Tables) -> DataFrame:
    recent = t.raw("transactions").filter(
        F.col("transaction_date") >= given.TRANSACTION_CUTOFF)
    return rows.symmetric_difference(
        t.raw("accounts").filter("status <> 'CLOSED'"), recent, ["account_id"],
        ("open", "active since cutoff"))


@query("set_union_all", f"""
  SELECT customer_id, city, pin_code FROM b_customers WHERE customer_since < '{given.FIRST_LOAD}'
  UNION ALL SELECT customer_id, city, pin_code FROM b_customers_day2""")
def set_union_all(t: Tables) -> DataFrame:
    columns = ["customer_id", "city", "pin_code"]
    known = t.raw("customers").filter(F.col("customer_since") < given.FIRST_LOAD)
    return rows.union_all(known.select(*columns), t.raw("customers_day2").select(*columns))


@query("join_inner_compare", f"""
  SELECT customer_id, o.city AS left_city, n.city AS right_city,
    o.is_active AS left_is_active, n.is_active AS right_is_active
  FROM s_dim_customer o JOIN s_second_load n USING (customer_id)
  WHERE o.city IS DISTINCT FROM n.city OR o.is_active IS DISTINCT FROM n.is_active""")
def join_inner_compare(t: Tables) -> DataFrame:
    """Current versions that no longer equal the latest source row."""
    latest = silver.conform_customers(t.raw("customers_day2"), "2002-01-01")
    return rows.changed_values(
        t.customers.filter("is_current = 'Y'"), latest, ["customer_id"], ["city", "is_active"])


@query("join_left_anti", """
  SELECT c.customer_id, c.full_name FROM s_dim_customer c
  WHERE NOT EXISTS (SELECT 1 FROM s_dim_account a WHERE a.customer_id = c.customer_id)""")
def join_left_anti(t: Tables) -> DataFrame:
    return rows.drop_known(
        t.customers.select("customer_id", "full_name"), t.accounts, ["customer_id"])


@query("join_left_semi", """
  SELECT a.account_id, a.status FROM s_dim_account a
  WHERE EXISTS (SELECT 1 FROM b_transactions t WHERE t.account_id = a.account_id)""")
def join_left_semi(t: Tables) -> DataFrame:
    return rows.keep_known(
        t.accounts.select("account_id", "status"), t.raw("transactions"), ["account_id"])
