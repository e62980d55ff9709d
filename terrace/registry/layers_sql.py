"""The layers in plain SQL for the checking engine, as common table expressions."""

from __future__ import annotations

import re

from terrace.schemas import BRONZE_COLUMNS, TRACKED_CUSTOMER, table_schema
from terrace.sources import given

AS_OF = "2002-01-01"  # the day ages and recency are measured at
FIRST_DAY = "1995-01-01"  # effective day of the first customer load
SECOND_DAY = "1998-07-01"  # effective day of the second customer load


def initcap(x: str) -> str:
    """Whitespace-delimited title case."""
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def title(c: str) -> str:
    return initcap(f"trim({c})")


def sk(*parts: str) -> str:
    key = " || '|' || ".join(parts)
    return f"cast('0x' || substring(md5({key}), 1, 15) as bigint)"


def day(c: str) -> str:
    return f"try_cast(nullif(trim({c}), '') as date)"


def dec(c: str, p: int = 15, s: int = 2) -> str:
    return f"try_cast(trim({c}) as decimal({p},{s}))"


def cents(total: str, n: str) -> str:
    """total / n half-up to two places; total in hundredths, both non-negative integers."""
    return f"(cast(({total} * 2 + {n}) // (2 * {n}) as double) / 100)"


def share(part: str, whole: str) -> str:
    return f"coalesce(cast({part} as double) / cast(nullif({whole}, 0) as double), 0e0)"


def columns_of(table: str, prefix: str = "") -> str:
    """Select list with dates as text and decimals as doubles, without the load time."""
    items = []
    for f in table_schema(table).fields:
        kind = f.dataType.simpleString()
        if f.name == "_etl_loaded_ts":
            continue
        name = prefix + f.name
        if kind == "date":
            items.append(f"cast({name} as varchar) AS {f.name}")
        elif kind.startswith("decimal"):
            items.append(f"cast({name} as double) AS {f.name}")
        else:
            items.append(f"{name} AS {f.name}")
    return ", ".join(items)


def newest(view: str, key: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in columns if c != key)
    return (f"(SELECT * FROM {view} QUALIFY row_number() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) = 1)")


def conformed_customers(view: str) -> str:
    return f"""
  SELECT customer_id, {title('first_name')} AS first_name, {title('last_name')} AS last_name,
    {title('first_name')} || ' ' || {title('last_name')} AS full_name,
    {day('date_of_birth')} AS date_of_birth,
    cast(floor((date '{AS_OF}' - {day('date_of_birth')}) / 365e0) as int) AS age,
    CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Other' END AS gender,
    trim(phone) AS phone, lower(trim(email)) AS email, upper(trim(pan_number)) AS pan_number,
    trim(aadhar_number) AS aadhar_number, {title('city')} AS city, {title('state')} AS state,
    trim(pin_code) AS pin_code, {day('customer_since')} AS customer_since, is_active
  FROM {newest(view, 'customer_id', BRONZE_COLUMNS['customers'])}"""


def first_versions(view: str) -> str:
    return f"""
  SELECT {sk('customer_id', f"'{FIRST_DAY}'")} AS customer_sk, *,
    date '{FIRST_DAY}' AS effective_date, date '9999-12-31' AS expiry_date, 'Y' AS is_current
  FROM {view}"""


_CHANGED = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in TRACKED_CUSTOMER)
_ATTRIBUTES = [c for c in table_schema("dim_customer").names if c not in (
    "customer_sk", "effective_date", "expiry_date", "is_current", "_etl_loaded_ts")]


def transaction_fact(view: str) -> str:
    return f"""
  SELECT {sk('t.transaction_id')} AS transaction_sk, t.transaction_id, a.account_sk, c.customer_sk,
    b.branch_sk,
    cast(year({day('transaction_date')}) * 10000 + month({day('transaction_date')}) * 100
      + day({day('transaction_date')}) as int) AS date_sk,
    {day('transaction_date')} AS transaction_date, transaction_time,
    upper(trim(transaction_type)) AS transaction_type, {dec('amount')} AS amount, t.currency,
    upper(trim(channel)) AS channel, upper(trim(t.status)) AS status, description, beneficiary_acc,
    reference_number
  FROM {view} t LEFT JOIN s_dim_account a ON a.account_id = t.account_id
    LEFT JOIN s_dim_customer c ON c.customer_id = a.customer_id AND c.is_current = 'Y'
    LEFT JOIN s_dim_branch b ON b.branch_id = a.branch_id"""


LAYERS: dict[str, str] = {
    **{f"b_{name}": given.view_sql(name) for name in given.VIEWS},
    "s_customers": conformed_customers("b_customers"),
    "s_dim_customer": first_versions("s_customers"),
    "b_first_load": f"SELECT * FROM b_customers WHERE customer_since < '{given.FIRST_LOAD}'",
    "s_first_load": conformed_customers("b_first_load"),
    "v_first": first_versions("s_first_load"),
    "s_second_load": conformed_customers("b_customers_day2"),
    "v_merged": f"""
  SELECT o.customer_sk, {', '.join('o.' + c for c in _ATTRIBUTES)}, o.effective_date,
    CASE WHEN n.customer_id IS NOT NULL AND ({_CHANGED}) THEN date '{SECOND_DAY}' - 1
         ELSE o.expiry_date END AS expiry_date,
    CASE WHEN n.customer_id IS NOT NULL AND ({_CHANGED}) THEN 'N' ELSE 'Y' END AS is_current
  FROM v_first o LEFT JOIN s_second_load n ON n.customer_id = o.customer_id
  UNION ALL
  SELECT {sk('n.customer_id', f"'{SECOND_DAY}'")}, {', '.join('n.' + c for c in _ATTRIBUTES)},
    date '{SECOND_DAY}', date '9999-12-31', 'Y'
  FROM s_second_load n LEFT JOIN v_first o ON n.customer_id = o.customer_id
  WHERE o.customer_id IS NULL OR {_CHANGED}""",
    "s_dim_account": f"""
  SELECT {sk('account_id')} AS account_sk, account_id, customer_id, account_number,
    upper(trim(account_type)) AS account_type, product_id, branch_id,
    upper(trim(ifsc_code)) AS ifsc_code, {dec('balance')} AS balance, currency,
    {day('open_date')} AS open_date, {day('close_date')} AS close_date,
    upper(trim(status)) AS status, {title('nominee_name')} AS nominee_name
  FROM {newest('b_accounts', 'account_id', BRONZE_COLUMNS['accounts'])}""",
    "s_dim_branch": f"""
  SELECT {sk('branch_id')} AS branch_sk, branch_id, trim(branch_name) AS branch_name, branch_code,
    upper(trim(ifsc_code)) AS ifsc_code, {title('city')} AS city, {title('state')} AS state,
    trim(pin_code) AS pin_code, trim(phone) AS phone, {title('manager_name')} AS manager_name,
    {day('established_date')} AS established_date, is_active
  FROM {newest('b_branches', 'branch_id', BRONZE_COLUMNS['branches'])}""",
    "s_dim_product": f"""
  SELECT {sk('product_id')} AS product_sk, product_id, trim(product_name) AS product_name,
    upper(trim(product_category)) AS product_category, {dec('interest_rate', 5)} AS interest_rate
  FROM {newest('b_product_types', 'product_id', BRONZE_COLUMNS['product_types'])}""",
    "s_dim_date": """
  SELECT cast(strftime(d, '%Y%m%d') as int) AS date_sk, d AS full_date,
    cast(year(d) as int) AS year, cast(quarter(d) as int) AS quarter,
    cast(month(d) as int) AS month, monthname(d) AS month_name,
    cast(weekofyear(d) as int) AS week_of_year, cast(day(d) as int) AS day_of_month,
    cast(isodow(d) as int) AS day_of_week, dayname(d) AS day_name,
    CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS is_weekend, 'N' AS is_holiday,
    cast(CASE WHEN month(d) >= 4 THEN year(d) ELSE year(d) - 1 END as int) AS fiscal_year,
    cast(CASE WHEN month(d) >= 4 THEN quarter(d) - 1 ELSE 4 END as int) AS fiscal_quarter
  FROM (SELECT cast(unnest(generate_series(
      cast(date_trunc('year', min(l_shipdate)) as timestamp),
      cast(date_trunc('year', max(l_shipdate)) + interval 1 year - interval 1 day as timestamp),
      interval 1 day)) as date) AS d FROM lineitem)""",
    "s_fact_transaction": transaction_fact("b_transactions"),
    "s_fact_dirty": transaction_fact("b_transactions_dirty"),
    "s_fact_loan": f"""
  SELECT {sk('l.loan_id')} AS loan_sk, l.loan_id, c.customer_sk, b.branch_sk, p.product_sk,
    upper(trim(loan_type)) AS loan_type, {dec('principal_amount')} AS principal_amount,
    {dec('l.interest_rate', 5)} AS interest_rate, try_cast(tenure_months as int) AS tenure_months,
    {dec('emi_amount')} AS emi_amount, {day('disburse_date')} AS disburse_date,
    {day('maturity_date')} AS maturity_date, {dec('outstanding_amount')} AS outstanding_amount,
    upper(trim(l.status)) AS status, upper(trim(collateral_type)) AS collateral_type
  FROM {newest('b_loans', 'loan_id', BRONZE_COLUMNS['loans'])} l
    LEFT JOIN s_dim_customer c ON c.customer_id = l.customer_id AND c.is_current = 'Y'
    LEFT JOIN s_dim_branch b ON b.branch_id = l.branch_id
    LEFT JOIN s_dim_product p ON p.product_id = l.product_id""",
    "g_accounts": f"""
  SELECT customer_id, count(account_id) AS total_accounts,
    count(*) FILTER (WHERE status = 'ACTIVE') AS active_accounts,
    coalesce(sum(balance) FILTER (WHERE status = 'ACTIVE'), 0) AS total_balance,
    coalesce({cents("sum(cast(balance * 100 as bigint)) FILTER (WHERE status = 'ACTIVE')",
                    "nullif(count(balance) FILTER (WHERE status = 'ACTIVE'), 0)")}, 0)
      AS avg_balance
  FROM s_dim_account GROUP BY customer_id""",
    "g_transactions": """
  SELECT a.customer_id, count(transaction_id) AS total_transactions,
    sum(CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END) AS total_credit_amount,
    sum(CASE WHEN transaction_type = 'DEBIT' THEN amount ELSE 0 END) AS total_debit_amount,
    max(transaction_date) AS last_transaction_date,
    count(*) FILTER (WHERE t.status IN ('FAILED', 'REVERSED')) AS unsuccessful
  FROM s_fact_transaction t JOIN s_dim_account a ON a.account_sk = t.account_sk
  GROUP BY a.customer_id""",
    "g_loans": """
  SELECT c.customer_id, count(*) AS loans,
    count(*) FILTER (WHERE status = 'ACTIVE') AS active_loans,
    count(*) FILTER (WHERE status = 'DEFAULT') AS default_loans,
    sum(outstanding_amount) AS outstanding, sum(principal_amount) AS principal
  FROM s_fact_loan l JOIN s_dim_customer c ON c.customer_sk = l.customer_sk
  GROUP BY c.customer_id""",
    "g_customer_360": f"""
  SELECT c.customer_id, full_name, city, state, customer_since,
    coalesce(total_accounts, 0) AS total_accounts, coalesce(active_accounts, 0) AS active_accounts,
    coalesce(total_balance, 0) AS total_balance, coalesce(avg_balance, 0) AS avg_balance,
    coalesce(total_transactions, 0) AS total_transactions,
    coalesce(total_credit_amount, 0) AS total_credit_amount,
    coalesce(total_debit_amount, 0) AS total_debit_amount,
    cast(coalesce(active_loans, 0) as bigint) AS active_loans,
    coalesce(outstanding, 0) AS total_loan_outstanding, last_transaction_date,
    CASE WHEN total_balance >= 1000000 THEN 'PLATINUM' WHEN total_balance >= 500000 THEN 'GOLD'
         WHEN total_balance >= 100000 THEN 'SILVER' ELSE 'BASIC' END AS customer_segment,
    round(cast(100e0 * (0.5e0 * {share('default_loans', 'loans')}
      + 0.3e0 * {share('unsuccessful', 'total_transactions')}
      + 0.2e0 * least(1e0, {share('outstanding', 'principal')})) as decimal(28,10)), 2)
      AS risk_score
  FROM s_dim_customer c LEFT JOIN g_accounts a ON a.customer_id = c.customer_id
    LEFT JOIN g_transactions t ON t.customer_id = c.customer_id
    LEFT JOIN g_loans l ON l.customer_id = c.customer_id
  WHERE is_current = 'Y'""",
    "g_branch_performance": """
  SELECT b.branch_id, branch_name, city, report_month,
    coalesce(total_customers, 0) AS total_customers, coalesce(total_accounts, 0) AS total_accounts,
    total_deposits, total_withdrawals, total_deposits - total_withdrawals AS net_flow,
    coalesce(total_loans_disbursed, 0) AS total_loans_disbursed,
    coalesce(active_loans, 0) AS active_loans, coalesce(npa_amount, 0) AS npa_amount
  FROM (SELECT branch_sk, cast(date_trunc('month', transaction_date) as date) AS report_month,
          sum(CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END) AS total_deposits,
          sum(CASE WHEN transaction_type = 'DEBIT' THEN amount ELSE 0 END) AS total_withdrawals
        FROM s_fact_transaction GROUP BY ALL) t
    LEFT JOIN s_dim_branch b ON b.branch_sk = t.branch_sk
    LEFT JOIN (SELECT branch_id, count(DISTINCT customer_id) AS total_customers,
                 count(account_id) AS total_accounts FROM s_dim_account GROUP BY branch_id) a
      ON a.branch_id = b.branch_id
    LEFT JOIN (SELECT branch_sk, sum(principal_amount) AS total_loans_disbursed,
                 count(*) FILTER (WHERE status = 'ACTIVE') AS active_loans,
                 sum(CASE WHEN status = 'DEFAULT' THEN outstanding_amount ELSE 0 END) AS npa_amount
               FROM s_fact_loan GROUP BY branch_sk) l ON l.branch_sk = t.branch_sk""",
    "g_daily_txn_summary": f"""
  SELECT transaction_date, channel, transaction_type, count(*) AS total_count,
    count(*) FILTER (WHERE status = 'SUCCESS') AS success_count,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_count,
    sum(amount) AS total_amount,
    {cents('sum(cast(amount * 100 as bigint))', 'count(amount)')} AS avg_amount,
    max(amount) AS max_amount, min(amount) AS min_amount
  FROM s_fact_transaction GROUP BY ALL""",
    "g_loan_portfolio": f"""
  SELECT loan_type, cast(date_trunc('month', disburse_date) as date) AS report_month,
    count(*) AS total_loans, count(*) FILTER (WHERE status = 'ACTIVE') AS active_loans,
    count(*) FILTER (WHERE status = 'DEFAULT') AS defaulted_loans,
    sum(principal_amount) AS total_principal, sum(outstanding_amount) AS total_outstanding,
    {cents('sum(cast(interest_rate * 100 as bigint))', 'count(*)')} AS avg_interest_rate,
    cast((sum(tenure_months) * 20 + count(*)) // (2 * count(*)) as double) / 10
      AS avg_tenure_months,
    {cents("(count(*) FILTER (WHERE status = 'DEFAULT')) * 10000", 'count(*)')} AS npa_ratio
  FROM s_fact_loan GROUP BY ALL""",
}


def with_layers(sql: str) -> str:
    """Prefix the query with the layers it refers to, directly or through others."""
    needed: set[str] = set()
    open_names = set(re.findall(r"\b[bsvg]_\w+", sql)) & set(LAYERS)
    while open_names:
        name = open_names.pop()
        needed.add(name)
        open_names |= (set(re.findall(r"\b[bsvg]_\w+", LAYERS[name])) & set(LAYERS)) - needed
    if not needed:
        return sql
    chain = ",\n".join(f"{n} AS ({LAYERS[n]})" for n in LAYERS if n in needed)
    return f"WITH {chain}\n{sql}" if not sql.lstrip().upper().startswith("WITH ") else (
        f"WITH {chain},\n{sql.lstrip()[5:]}")
