"""The generated test tables seen through the raw-layer contract.

Each view is one SELECT in the SQL that Spark and the checking engine share, with
`{table}` where a test table goes. Some values are dirty on purpose (blanks, wrong case,
empty text, malformed dates) so that the cleansing operators have work to do. Keys are
padded to twelve digits, which keeps them unique far beyond 100 TB of orders.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Customers opened on or after this day are unknown to the first load.
FIRST_LOAD = "2012-01-01"
# Transactions on or after this day belong to the second load.
TRANSACTION_CUTOFF = "2001-01-01"

_CUSTOMER_COLUMNS = """
    'CUST' || lpad(cast(c_custkey as string), 12, '0') AS customer_id,
    '  ' || lower(substring(c_name, 1, 8)) AS first_name,
    c_mktsegment AS last_name,
    cast(date '1960-01-01' + cast(c_custkey % 15000 as int) as string) AS date_of_birth,
    CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'X' END AS gender,
    '+91' || cast(6 + c_custkey % 4 as string) || lpad(cast(c_custkey as string), 9, '0') AS phone,
    upper(c_mktsegment) || '.' || cast(c_custkey as string) || '@' ||
      CASE c_custkey % 4 WHEN 0 THEN 'alpha.example' WHEN 1 THEN 'beta.example'
                         WHEN 2 THEN 'gamma.example' ELSE 'delta.example' END AS email,
    'abcde' || lpad(cast(c_custkey % 10000 as string), 4, '0') || 'f' AS pan_number,
    lpad(cast(c_custkey as string), 12, '0') AS aadhar_number,
    cast(c_custkey as string) || ' main road' AS address"""

_CUSTOMER_TAIL = """
    r_name AS state,
    cast(100000 + c_custkey % 900000 as string) AS pin_code,
    cast(date '2008-01-01' + cast(c_custkey % 5000 as int) as string) AS customer_since,
    CASE WHEN c_custkey % 5 = 4 THEN 'N' ELSE 'Y' END AS is_active
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
                  JOIN {region} ON n_regionkey = r_regionkey"""

_TRANSACTION_ID = """
    'TXN' || lpad(cast(l_orderkey as string), 12, '0') || '-' || cast(l_linenumber as string)
      || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) AS transaction_id"""

_TRANSACTION_TAIL = """
    'INR' AS currency,
    CASE l_partkey % 8 WHEN 0 THEN 'NEFT' WHEN 1 THEN 'rtgs' WHEN 2 THEN 'IMPS' WHEN 3 THEN 'UPI'
         WHEN 4 THEN ' ATM' WHEN 5 THEN 'BRANCH' WHEN 6 THEN 'NET_BANKING'
         ELSE 'MOBILE_BANKING' END AS channel,
    CASE l_returnflag WHEN 'N' THEN 'SUCCESS' WHEN 'A' THEN 'FAILED' ELSE 'REVERSED' END AS status,
    'line ' || cast(l_linenumber as string) AS description,
    CASE WHEN l_linestatus = 'O' THEN '' ELSE 'BEN' || cast(l_suppkey as string)
         END AS beneficiary_acc,
    'REF' || lpad(cast(l_partkey as string), 10, '0') AS reference_number
  FROM {lineitem}"""

_LOAN_RATE = "cast(7.50 + cast(o_orderkey % 76 as int) * 0.10 as decimal(5,2))"
_LOAN_TENURE = """CASE o_orderkey % 8 WHEN 0 THEN 12 WHEN 1 THEN 24 WHEN 2 THEN 36 WHEN 3 THEN 60
                       WHEN 4 THEN 84 WHEN 5 THEN 120 WHEN 6 THEN 180 ELSE 240 END"""

VIEWS: dict[str, str] = {
    "customers": f"""
  SELECT {_CUSTOMER_COLUMNS},
    n_name AS city, {_CUSTOMER_TAIL}""",
    # The second day's file: every customer again, those with a negative balance have moved,
    # and the BUILDING segment is sent twice.
    "customers_day2": f"""
  SELECT {_CUSTOMER_COLUMNS},
    CASE WHEN c_acctbal < 0 THEN 'new ' || n_name ELSE n_name END AS city, {_CUSTOMER_TAIL}
  UNION ALL
  SELECT {_CUSTOMER_COLUMNS},
    CASE WHEN c_acctbal < 0 THEN 'new ' || n_name ELSE n_name END AS city, {_CUSTOMER_TAIL}
  WHERE c_mktsegment = 'BUILDING'""",
    "accounts": """
  SELECT
    'ACC' || lpad(cast(o_orderkey as string), 12, '0') AS account_id,
    'CUST' || lpad(cast(o_custkey as string), 12, '0') AS customer_id,
    cast(o_orderkey as string) AS account_number,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'savings' WHEN '2-HIGH' THEN 'CURRENT '
         WHEN '3-MEDIUM' THEN 'SALARY' WHEN '4-NOT SPECIFIED' THEN 'NRI' ELSE 'FD'
         END AS account_type,
    'PRD' || lpad(cast(o_orderkey % (SELECT count(*) FROM {part}) as string), 9, '0') AS product_id,
    'BR' || lpad(cast(o_orderkey % (SELECT count(*) FROM {supplier}) as string), 9, '0')
      AS branch_id,
    'sbin0' || lpad(cast(o_orderkey % (SELECT count(*) FROM {supplier}) as string), 6, '0')
      AS ifsc_code,
    cast(cast(o_totalprice as decimal(15,2)) as string) AS balance,
    'INR' AS currency,
    cast(cast(o_orderdate as date) as string) AS open_date,
    CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate as date) + 365 as string)
         ELSE '' END AS close_date,
    CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'DORMANT' ELSE 'CLOSED' END AS status,
    'nominee ' || cast(o_custkey as string) AS nominee_name
  FROM {orders}""",
    "transactions": f"""
  SELECT {_TRANSACTION_ID},
    'ACC' || lpad(cast(l_orderkey as string), 12, '0') AS account_id,
    cast(cast(l_shipdate as date) as string) AS transaction_date,
    lpad(cast(l_linenumber * 3 as string), 2, '0') || ':00:00' AS transaction_time,
    CASE WHEN l_linestatus = 'O' THEN 'credit' ELSE 'DEBIT' END AS transaction_type,
    cast(cast(l_extendedprice as decimal(15,2)) as string) AS amount, {_TRANSACTION_TAIL}""",
    # The same rows as a careless source would send them.
    "transactions_dirty": f"""
  SELECT {_TRANSACTION_ID},
    CASE WHEN l_quantity = 7 AND l_linenumber = 1 THEN ' '
         WHEN l_quantity = 8 AND l_linenumber = 1 THEN 'ACC-UNKNOWN'
         ELSE 'ACC' || lpad(cast(l_orderkey as string), 12, '0') END AS account_id,
    CASE WHEN l_quantity = 9 AND l_linenumber = 1 THEN '31-12-2025'
         WHEN l_quantity = 10 AND l_linenumber = 1 THEN '2030-12-31'
         ELSE cast(cast(l_shipdate as date) as string) END AS transaction_date,
    lpad(cast(l_linenumber * 3 as string), 2, '0') || ':00:00' AS transaction_time,
    CASE WHEN l_linestatus = 'O' THEN 'credit' ELSE 'DEBIT' END AS transaction_type,
    CASE WHEN l_quantity = 11 AND l_linenumber = 1 THEN '0.00'
         WHEN l_quantity = 12 AND l_linenumber = 1 THEN 'n/a'
         WHEN l_quantity = 13 AND l_linenumber = 1
           THEN '-' || cast(cast(l_extendedprice as decimal(15,2)) as string)
         ELSE cast(cast(l_extendedprice as decimal(15,2)) as string) END AS amount,
    {_TRANSACTION_TAIL}""",
    "loans": f"""
  SELECT loan_id, customer_id, loan_type, product_id,
    cast(principal as string) AS principal_amount,
    cast(rate as string) AS interest_rate,
    cast(tenure as string) AS tenure_months,
    cast(cast(round(principal_d * r * power(1 + r, tenure) / (power(1 + r, tenure) - 1), 2)
         as decimal(15,2)) as string) AS emi_amount,
    cast(disbursed as string) AS disburse_date,
    cast(disbursed + cast(30 * tenure as int) as string) AS maturity_date,
    cast(cast(principal * outstanding_pct * 0.01 as decimal(15,2)) as string) AS outstanding_amount,
    status, branch_id, collateral_type
  FROM (
    SELECT
      'LN' || lpad(cast(o_orderkey as string), 12, '0') AS loan_id,
      'CUST' || lpad(cast(o_custkey as string), 12, '0') AS customer_id,
      CASE o_orderkey % 6 WHEN 0 THEN 'home' WHEN 1 THEN 'PERSONAL' WHEN 2 THEN 'CAR'
           WHEN 3 THEN 'EDUCATION' WHEN 4 THEN ' GOLD' ELSE 'BUSINESS' END AS loan_type,
      'PRD' || lpad(cast(o_orderkey % (SELECT count(*) FROM {{part}}) as string), 9, '0')
        AS product_id,
      'BR' || lpad(cast(o_orderkey % (SELECT count(*) FROM {{supplier}}) as string), 9, '0')
        AS branch_id,
      cast(o_totalprice as decimal(15,2)) AS principal,
      cast(o_totalprice as double) AS principal_d,
      {_LOAN_RATE} AS rate,
      cast({_LOAN_RATE} as double) / 1200e0 AS r,
      {_LOAN_TENURE} AS tenure,
      cast(o_orderkey % 100 as int) AS outstanding_pct,
      cast(o_orderdate as date) AS disbursed,
      CASE WHEN o_orderstatus = 'O' THEN 'ACTIVE' WHEN o_orderstatus = 'P' THEN 'RESTRUCTURED'
           WHEN o_orderkey % 2 = 0 THEN 'CLOSED' ELSE 'default' END AS status,
      CASE WHEN o_orderkey % 6 = 0 THEN 'property' WHEN o_orderkey % 6 = 2 THEN 'vehicle'
           ELSE 'none' END AS collateral_type
    FROM {{orders}} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS terms""",
    "branches": """
  SELECT
    'BR' || lpad(cast(s_suppkey as string), 9, '0') AS branch_id,
    s_name || ' ' AS branch_name,
    'C' || cast(s_suppkey as string) AS branch_code,
    'sbin0' || lpad(cast(s_suppkey as string), 6, '0') AS ifsc_code,
    cast(s_suppkey as string) || ' high street' AS address,
    n_name AS city, r_name AS state,
    cast(200000 + s_suppkey % 700000 as string) AS pin_code,
    '+917' || lpad(cast(s_suppkey as string), 9, '0') AS phone,
    ' manager ' AS manager_name,
    cast(date '1990-01-01' + cast(s_suppkey % 10000 as int) as string) AS established_date,
    'Y' AS is_active
  FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
                  JOIN {region} ON n_regionkey = r_regionkey""",
    "product_types": """
  SELECT
    'PRD' || lpad(cast(p_partkey as string), 9, '0') AS product_id,
    p_name AS product_name,
    lower(p_type) AS product_category,
    cast(cast(p_size as decimal(5,2)) as string) AS interest_rate
  FROM {part}""",
    # gypsum_feed has no reading while the sensor reports an error; mill_feed_rate can be zero.
    "sensor_readings": """
  SELECT
    user_id AS series_id, event_id AS reading_id, ts AS reading_ts,
    value AS sound_level,
    cast(length(event_type) as double) AS production_rate,
    CASE WHEN event_type = 'error' THEN NULL ELSE (event_id % 7) * 0.25e0 END AS gypsum_feed,
    (event_id % 13) * 1.0e0 AS sepol_drive_speed,
    (event_id % 11) * 0.5e0 AS separator_fan,
    (event_id % 17) * 1.0e0 AS mill_feed_rate,
    (event_id % 19) * 0.75e0 AS bucket_elev,
    (event_id % 23) * 2.0e0 AS main_motor,
    5.0e0 + value * 0.0625e0 + (event_id % 17) * 0.125e0 AS fineness
  FROM {events}""",
    "sales": """
  SELECT
    p_brand AS brand, p_type AS category, n_name AS branch_city,
    cast(l_shipdate as date) AS transaction_date,
    cast(l_quantity as int) AS units_sold,
    cast(p_retailprice as decimal(12,2)) AS unit_price,
    cast(l_discount * 100 as decimal(5,2)) AS margin_pct,
    CASE WHEN l_returnflag = 'A' THEN 'floor_stock' WHEN l_returnflag = 'N' THEN 'warehouse'
         WHEN l_linestatus = 'O' THEN 'in_transit' ELSE 'consignment' END AS inventory_type
  FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
                  JOIN {supplier} ON l_suppkey = s_suppkey
                  JOIN {nation} ON s_nationkey = n_nationkey""",
}


def view_sql(name: str) -> str:
    """The view for an engine in which the test tables go by their own names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])


# Fixed schemas of the test tables, so that reading one starts no job to look at its footer.
TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                 "c_mktsegment string"),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
               "value double, props string"),
}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, view: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """A raw-layer view over the test tables, as one lazy plan."""
    text = VIEWS[view]
    return spark.sql(text, **{t: table(t) for t in sorted(set(re.findall(r"\{(\w+)\}", text)))})
