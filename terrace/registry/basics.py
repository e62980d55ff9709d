"""Registered queries: projections, filters, scalar functions, aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators import rows, sketches
from terrace.plans.silver import date_bounds
from terrace.registry.common import AS_OF, Tables, query
from terrace.registry.layers_sql import cents, day, dec, share, title
from terrace.schemas import CHANNELS, EMAIL_PATTERN, PHONE_PATTERN
from terrace.session import new_folder
from terrace.sources.files import add_audit

# --- projections ---------------------------------------------------------------------------


@query("prj_audit_columns", """
  SELECT transaction_id, 'lineitem.parquet' AS _source_file, 'batch-01' AS _batch_id,
    true AS stamped FROM b_transactions""")
def audit_columns(t: Tables) -> DataFrame:
    audited = add_audit(t.raw("transactions"), "batch-01", "lineitem.parquet")
    return audited.select("transaction_id", "_source_file", "_batch_id",
                          F.col("_ingestion_ts").isNotNull().alias("stamped"))


@query("prj_ordered_select", """
  SELECT loan_id, loan_type, principal_amount, interest_rate, tenure_months FROM b_loans""")
def ordered_select(t: Tables) -> DataFrame:
    return t.raw("loans").select(
        "loan_id", "loan_type", "principal_amount", "interest_rate", "tenure_months")


@query("prj_tolerant_cast", f"""
  SELECT transaction_id, amount AS raw_amount, cast({dec('amount')} as double) AS amount
  FROM b_transactions_dirty""")
def tolerant_cast(t: Tables) -> DataFrame:
    return t.raw("transactions_dirty").select(
        "transaction_id", F.col("amount").alias("raw_amount"),
        C.tolerant_cast("amount", "decimal(15,2)").alias("amount"))


@query("prj_tolerant_date", f"""
  SELECT transaction_id, transaction_date AS raw_date,
    cast({day('transaction_date')} as varchar) AS transaction_date FROM b_transactions_dirty""")
def tolerant_date(t: Tables) -> DataFrame:
    return t.raw("transactions_dirty").select(
        "transaction_id", F.col("transaction_date").alias("raw_date"),
        C.tolerant_date("transaction_date").alias("transaction_date"))


@query("prj_empty_to_null", f"""
  SELECT account_id, cast({day('close_date')} as varchar) AS close_date,
    close_date = '' AS was_empty FROM b_accounts""")
def empty_to_null(t: Tables) -> DataFrame:
    return t.raw("accounts").select(
        "account_id", C.tolerant_date("close_date").alias("close_date"),
        (F.col("close_date") == "").alias("was_empty"))


@query("prj_value_map", """
  SELECT customer_id, CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Other' END
    AS gender FROM b_customers""")
def value_map(t: Tables) -> DataFrame:
    return t.raw("customers").select("customer_id", C.gender_label("gender").alias("gender"))


@query("prj_segment_bucket", """
  SELECT account_id, CASE WHEN b >= 1000000 THEN 'PLATINUM' WHEN b >= 500000 THEN 'GOLD'
    WHEN b >= 100000 THEN 'SILVER' ELSE 'BASIC' END AS segment
  FROM (SELECT account_id, cast(balance as decimal(15,2)) * 3 AS b FROM b_accounts)""")
def segment_bucket(t: Tables) -> DataFrame:
    balance = C.tolerant_cast("balance", "decimal(15,2)") * 3
    return t.raw("accounts").select("account_id", C.segment_for(balance).alias("segment"))


@query("prj_fillna_numeric", f"""
  SELECT transaction_id, coalesce(cast({dec('amount')} as double), 0) AS amount,
    cast({day('transaction_date')} as varchar) AS transaction_date,
    nullif(beneficiary_acc, '') AS beneficiary_acc FROM b_transactions_dirty""")
def fillna_numeric(t: Tables) -> DataFrame:
    """Numbers become 0; dates and text stay null."""
    return t.raw("transactions_dirty").select(
        "transaction_id", C.tolerant_cast("amount", "decimal(15,2)").alias("amount"),
        C.tolerant_date("transaction_date").alias("transaction_date"),
        F.nullif("beneficiary_acc", F.lit("")).alias("beneficiary_acc")).fillna(0)


# --- filters -------------------------------------------------------------------------------


@query("flt_current_version", """
  SELECT customer_id, city, cast(effective_date as varchar) AS effective_date
  FROM v_merged WHERE is_current = 'Y'""")
def current_version(t: Tables) -> DataFrame:
    return t.versions.filter("is_current = 'Y'").select("customer_id", "city", "effective_date")


@query("flt_range", """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
  WHERE l_quantity BETWEEN 10 AND 20 AND l_shipdate >= timestamp '1997-01-01'
    AND (l_discount < 0.03 OR l_tax > 0.05) AND NOT l_returnflag = 'N'""")
def flt_range(t: Tables) -> DataFrame:
    keep = (
        F.col("l_quantity").between(10, 20)
        & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & ((F.col("l_discount") < 0.03) | (F.col("l_tax") > 0.05))
        & ~(F.col("l_returnflag") == "N"))
    return t.given("lineitem").filter(keep).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("flt_isin", f"""
  SELECT transaction_id, channel FROM b_transactions
  WHERE channel NOT IN ({', '.join(f"'{c}'" for c in CHANNELS)})""")
def flt_isin(t: Tables) -> DataFrame:
    return t.raw("transactions").filter(~F.col("channel").isin(CHANNELS)).select(
        "transaction_id", "channel")


@query("flt_regex", f"""
  SELECT customer_id, phone, email FROM s_customers
  WHERE regexp_matches(phone, '{PHONE_PATTERN}') AND regexp_matches(email, '{EMAIL_PATTERN}')
    AND starts_with(email, 'b') AND ends_with(email, '.example')""")
def flt_regex(t: Tables) -> DataFrame:
    keep = (F.col("phone").rlike(PHONE_PATTERN) & F.col("email").rlike(EMAIL_PATTERN)
            & F.col("email").startswith("b") & F.col("email").endswith(".example"))
    return t.customers.filter(keep).select("customer_id", "phone", "email")


@query("flt_null_or_blank", """
  SELECT transaction_id, account_id FROM b_transactions_dirty
  WHERE account_id IS NULL OR trim(account_id) = ''""")
def flt_null_or_blank(t: Tables) -> DataFrame:
    return t.raw("transactions_dirty").filter(C.null_or_blank("account_id")).select(
        "transaction_id", "account_id")


# --- scalar functions ----------------------------------------------------------------------


@query("fn_string", f"""
  SELECT customer_id, {title('first_name')} AS titled, upper(trim(pan_number)) AS pan,
    lower(email) AS email, {title('first_name')} || ' ' || {title('last_name')} AS full_name,
    length(first_name) AS n_chars FROM b_customers""")
def fn_string(t: Tables) -> DataFrame:
    return t.raw("customers").select(
        "customer_id", C.title("first_name").alias("titled"), C.code("pan_number").alias("pan"),
        F.lower("email").alias("email"),
        F.concat_ws(" ", C.title("first_name"), C.title("last_name")).alias("full_name"),
        F.length("first_name").cast("bigint").alias("n_chars"))


@query("fn_date", """
  SELECT o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) AS date_sk,
    cast(cast(date_trunc('month', o_orderdate) as date) as varchar) AS month_start,
    cast(year(o_orderdate) as int) AS year,
    cast(cast(o_orderdate as date) + 30 as varchar) AS plus_30,
    cast(cast(o_orderdate as date) - 7 as varchar) AS minus_7 FROM orders""")
def fn_date(t: Tables) -> DataFrame:
    day_ = F.col("o_orderdate").cast("date")
    return t.given("orders").select(
        "o_orderkey", C.date_key(day_).alias("date_sk"), C.month_start(day_).alias("month_start"),
        F.year(day_).alias("year"), F.date_add(day_, 30).alias("plus_30"),
        F.date_sub(day_, 7).alias("minus_7"))


@query("fn_age_asof", f"""
  SELECT customer_id, cast(floor((date '{AS_OF}' - {day('date_of_birth')}) / 365e0) as int) AS age
  FROM b_customers""")
def fn_age(t: Tables) -> DataFrame:
    return t.raw("customers").select("customer_id", C.age_in_years(
        C.tolerant_date("date_of_birth"), F.lit(AS_OF).cast("date")).alias("age"))


@query("fn_math", """
  SELECT p_partkey, cast(floor(p_retailprice / 7e0) as bigint) AS sevenths,
    round(p_retailprice * 1.5e0, 1) AS raised, p_retailprice / nullif(p_size - 10, 0) AS per_size
  FROM part""")
def fn_math(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.given("part").select(
        "p_partkey", F.floor(price / F.lit(7.0)).alias("sevenths"),
        F.round(price * 1.5, 1).alias("raised"),
        F.try_divide(price, F.col("p_size") - 10).alias("per_size"))


@query("fn_emi", """
  SELECT loan_id, cast(emi_amount as double) AS instalment FROM b_loans""")
def fn_emi(t: Tables) -> DataFrame:
    return t.raw("loans").select("loan_id", C.equated_instalment(
        C.tolerant_cast("principal_amount", "decimal(15,2)"),
        C.tolerant_cast("interest_rate", "decimal(5,2)"),
        C.tolerant_cast("tenure_months", "int")).alias("instalment"))


# --- aggregations --------------------------------------------------------------------------


@query("agg_count", """
  SELECT o_custkey, count(*) AS orders, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS settled
  FROM orders GROUP BY o_custkey""")
def agg_count(t: Tables) -> DataFrame:
    return t.given("orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        F.count(F.when(F.col("o_orderstatus") != "P", 1)).alias("settled"))


@query("agg_count_distinct", """
  SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders
  FROM lineitem GROUP BY l_suppkey""")
def agg_count_distinct(t: Tables) -> DataFrame:
    """Distinct (supplier, value) pairs are formed before suppliers are counted."""
    return t.given("lineitem").groupBy("l_suppkey").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_orderkey").alias("orders"))


@query("agg_conditional", """
  SELECT account_id, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded,
    cast(sum(CASE WHEN transaction_type = 'credit' THEN cast(amount as decimal(15,2)) ELSE 0 END)
      as double) AS credit,
    cast(sum(CASE WHEN transaction_type = 'DEBIT' THEN cast(amount as decimal(15,2)) ELSE 0 END)
      as double) AS debit
  FROM b_transactions GROUP BY account_id""")
def agg_conditional(t: Tables) -> DataFrame:
    amount = C.tolerant_cast("amount", "decimal(15,2)")

    def total(kind: str):
        return F.sum(F.when(F.col("transaction_type") == kind, amount).otherwise(F.lit(0)))

    return t.raw("transactions").groupBy("account_id").agg(
        F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
        total("credit").alias("credit"), total("DEBIT").alias("debit"))


@query("agg_having", """
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def agg_having(t: Tables) -> DataFrame:
    return t.given("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n")).filter("n > 1")


@query("agg_global_profile", """
  SELECT count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
    round(cast(sum(cast(l_extendedprice as decimal(15,2))) as double) / count(*), 6) AS mean,
    round(stddev_samp(l_extendedprice), 4) AS deviation FROM lineitem""")
def agg_global_profile(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    return t.given("lineitem").agg(
        F.count("*").alias("n"), F.min(price).alias("low"), F.max(price).alias("high"),
        F.round(F.sum(price.cast("decimal(15,2)")).cast("double") / F.count("*"), 6).alias("mean"),
        F.round(F.stddev_samp(price), 4).alias("deviation"))


@query("agg_quantiles", """
  SELECT l_returnflag, quantile_disc(l_extendedprice, 0.25) AS q1,
    quantile_disc(l_extendedprice, 0.5) AS median, quantile_disc(l_extendedprice, 0.75) AS q3
  FROM lineitem GROUP BY l_returnflag""")
def agg_quantiles(t: Tables) -> DataFrame:
    found = rows.exact_quantiles(
        t.given("lineitem"), ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75])
    return found.toDF("l_returnflag", "q1", "median", "q3")


_SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("agg_sketches", f"""
  SELECT channel, count(*) AS n, count(DISTINCT account_id) AS exact_distinct, true AS distinct_within,
    true AS quantiles_within FROM (SELECT upper(trim(channel)) AS channel, account_id FROM b_transactions)
  GROUP BY channel""")
def stored_sketches(t: Tables) -> DataFrame:
    """Sketches stored by day, merged by channel over all days, against the exact answers."""
    rows = t.typed_transactions.select("transaction_date", "channel", "account_id", "amount")
    path = new_folder(t.spark, "sketches")
    sketches.store_daily(rows, path, "transaction_date", ["channel"], ["account_id"], ["amount"])
    merged = sketches.merged(t.spark.read.parquet(path), ["channel"]).select(
        "channel", sketches.distinct_of("account_id").alias("distinct"),
        sketches.quantiles_of("amount", _SHARES).alias("quantiles"))
    return sketches.within_bounds(merged, rows, ["channel"], "account_id", "amount", _SHARES)


@query("agg_derived_ratio", f"""
  SELECT branch_id, count(*) AS accounts, count(*) FILTER (WHERE status = 'CLOSED') AS closed,
    {cents("(count(*) FILTER (WHERE status = 'CLOSED')) * 10000", 'count(*)')} AS closed_pct,
    {share("count(*) FILTER (WHERE status = 'ACTIVE')",
           "count(*) FILTER (WHERE status = 'DORMANT')")} AS active_per_dormant
  FROM s_dim_account GROUP BY branch_id""")
def agg_derived_ratio(t: Tables) -> DataFrame:
    counted = t.accounts.groupBy("branch_id").agg(
        F.count("*").alias("accounts"), F.count_if(F.col("status") == "CLOSED").alias("closed"),
        F.count_if(F.col("status") == "ACTIVE").alias("active"),
        F.count_if(F.col("status") == "DORMANT").alias("dormant"))
    return counted.select(
        "branch_id", "accounts", "closed",
        C.percent(F.col("closed"), F.col("accounts")).alias("closed_pct"),
        C.share(F.col("active"), F.col("dormant")).alias("active_per_dormant"))


@query("agg_share_of_total", """
  SELECT transaction_type, n, round(cast(n as double) / sum(n) OVER () * 100, 6) AS share_pct
  FROM (SELECT transaction_type, count(*) AS n FROM b_transactions GROUP BY transaction_type)""")
def agg_share(t: Tables) -> DataFrame:
    return rows.share_of_total(t.raw("transactions"), "transaction_type")


@query("date_bounds", """
  SELECT cast(cast(min(l_shipdate) as date) as varchar) AS first_day,
    cast(cast(max(l_shipdate) as date) as varchar) AS last_day FROM lineitem""")
def bounds(t: Tables) -> DataFrame:
    return date_bounds(
        t.given("lineitem").select(F.col("l_shipdate").cast("date").alias("d")), "d")


@query("top_k", """
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15""")
def top_k(t: Tables) -> DataFrame:
    return rows.top_k(t.given("orders").select("o_orderkey", "o_totalprice"), 15,
                      F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("preview_limit", """
  SELECT transaction_id, account_id, amount FROM b_transactions ORDER BY transaction_id, amount
  LIMIT 10""")
def preview(t: Tables) -> DataFrame:
    return rows.preview(t.raw("transactions").select("transaction_id", "account_id", "amount"),
                        10, F.col("transaction_id"), F.col("amount"))
