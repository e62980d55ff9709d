"""Registered queries: sources, sinks, catalogue, jobs and streams.

Each writes whole tables to a new folder under the shared folder and reads them back.
JDBC is not registered: it needs a database that executors can reach.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.plans import mart_mapping
from terrace.plans.facts import FactStore
from terrace.plans.jobs import Landing, bronze_to_silver, fact_store, source_to_bronze, update_silver
from terrace.plans.refresh import mart, refresh_gold
from terrace.registry.common import CONFORMED, Tables, query
from terrace.registry.layers_sql import AS_OF, FIRST_DAY, LAYERS, SECOND_DAY, columns_of
from terrace.schemas import BRONZE_COLUMNS, GOLD_DDL, SILVER_DDL
from terrace.session import new_folder
from terrace.sources import files, history, tables
from terrace.sources.given import FIRST_LOAD, TRANSACTION_CUTOFF
from terrace.streaming import streams


def _to_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    (df.write.mode(mode).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _text_columns(entity: str) -> str:
    """Columns of a raw table with empty fields as null, as a text file keeps them."""
    return ", ".join(f"nullif({c}, '') AS {c}" for c in BRONZE_COLUMNS[entity])


@query("src_csv_scan", f"SELECT {_text_columns('transactions')} FROM b_transactions")
def csv_scan(t: Tables) -> DataFrame:
    path = _to_csv(t.raw("transactions"), new_folder(t.spark, "csv"))
    return files.scan_csv(t.spark, path, "transactions")


@query("src_csv_header_scan", f"SELECT {_text_columns('product_types')} FROM b_product_types")
def csv_header_scan(t: Tables) -> DataFrame:
    return files.scan_csv_header(
        t.spark, _to_csv(t.raw("product_types"), new_folder(t.spark, "csv")))


@query("src_json_scan", f"""
  SELECT {', '.join(c for c in BRONZE_COLUMNS['branches'] if c != 'branch_code')},
    cast(substring(branch_code, 2) as varchar) AS branch_code FROM b_branches""")
def json_scan(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "json")
    # The branch code is written as a number and must come back as text.
    t.raw("branches").withColumn(
        "branch_code", F.substring("branch_code", 2, 20).cast("bigint")).write.json(path)
    return files.scan_json(t.spark, path, "branches")


@query("src_parquet_scan", """
  SELECT loan_id, status, principal_amount FROM b_loans WHERE status = 'default'""")
def parquet_scan(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "raw")
    tables.write_table(t.raw("loans"), f"{root}/bronze_loans")
    return files.scan_parquet(t.spark, root, "bronze_loans").filter(
        "status = 'default'").select("loan_id", "status", "principal_amount")


@query("sink_parquet_overwrite", f"""
  SELECT {columns_of('dim_account')}, (SELECT count(*) FROM s_dim_account) AS reported_rows
  FROM s_dim_account""")
def parquet_overwrite(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "sink")
    tables.write_table(t.accounts.limit(0), path)
    reported = tables.write_table(t.accounts, path)
    return t.spark.read.parquet(path).withColumn("reported_rows", F.lit(reported).cast("bigint"))


@query("sink_parquet_append", """
  SELECT customer_id, city FROM b_customers UNION ALL SELECT customer_id, city
  FROM b_customers_day2""")
def parquet_append(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "sink")
    tables.write_table(t.raw("customers").select("customer_id", "city"), path)
    tables.write_table(t.raw("customers_day2").select("customer_id", "city"), path, "append")
    return t.spark.read.parquet(path)


@query("sink_partitioned_dynamic", f"""
  SELECT transaction_month, count(*) AS n, cast(sum(amount) as double) AS amount FROM (
    SELECT substring(transaction_date, 1, 7) AS transaction_month,
      CASE WHEN transaction_date >= '{TRANSACTION_CUTOFF}' THEN 2 ELSE 1 END
        * cast(amount as decimal(15,2)) AS amount FROM b_transactions)
  GROUP BY transaction_month""")
def partitioned_dynamic(t: Tables) -> DataFrame:
    """Months from the cutoff on are replaced by rows with doubled amounts; others stay."""
    path = new_folder(t.spark, "sink")
    all_rows = t.typed_transactions.select("transaction_id", "transaction_date", "amount")
    tables.write_by_month(all_rows, path, "transaction_date")
    newer = all_rows.filter(F.col("transaction_date") >= F.lit(TRANSACTION_CUTOFF).cast("date"))
    tables.write_by_month(
        newer.withColumn("amount", (F.col("amount") * 2).cast("decimal(15,2)")), path,
        "transaction_date")
    return t.spark.read.parquet(path).groupBy(
        F.col("transaction_month").cast("string").alias("transaction_month")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query("ddl_create_table", f"SELECT {columns_of('gold_loan_portfolio')} FROM g_loan_portfolio")
def create_table(t: Tables) -> DataFrame:
    location = new_folder(t.spark, "table")
    name = "loan_portfolio_" + location[-32:]
    tables.create_table(t.spark, name, "gold_loan_portfolio", location)
    tables.create_table(t.spark, name, "gold_loan_portfolio", location)  # a no-op by contract
    t.loan_portfolio.write.insertInto(name, overwrite=True)
    return t.spark.table(name)


_GIVEN = ["customer", "orders", "lineitem"]
_TYPES = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END"""


def _catalog_sql() -> str:
    columns = {
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "lineitem": ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                     "l_discount l_tax l_returnflag l_linestatus l_shipdate"),
    }
    counts = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS known_values "
        f"FROM {table}" for table, names in columns.items() for c in names.split())
    return f"""
  SELECT c.table_name, cast(column_index as int) AS position, c.column_name,
    {_TYPES} AS data_type, known_values
  FROM duckdb_columns() c JOIN ({counts}) k ON k.table_name = c.table_name
    AND k.column_name = c.column_name"""


@query("catalog_columns", _catalog_sql())
def catalog_columns(t: Tables) -> DataFrame:
    return tables.catalog_columns({name: t.given(name) for name in _GIVEN})


_LOADED = {
    "first": ("SELECT * FROM orders", "SELECT * FROM nation"),
    "second": ("SELECT o_orderkey, o_orderdate, cast(o_totalprice as varchar) AS o_totalprice, o_custkey, "
               "o_orderstatus, o_orderkey % 7 AS o_channel FROM orders", "SELECT * FROM nation")}
_KINDS = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END"""


def _history_sql() -> str:
    known = {"first": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
             "second": "o_orderkey o_orderdate o_totalprice o_custkey o_orderstatus o_channel"}
    parts = []
    for load, (sql, _) in _LOADED.items():
        counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS known_values FROM ({sql})"
                                    for c in known[load].split())
        parts.append(f"""{load}_load AS (
    SELECT column_name, row_number() OVER () AS position, {_KINDS} AS data_type, known_values
    FROM (SELECT column_name, column_type FROM (DESCRIBE {sql})) JOIN ({counts}) USING (column_name))""")
    # DESCRIBE keeps the order of the columns, but a join need not: positions come from the list.
    order = {load: "list_position([" + ", ".join(f"'{c}'" for c in names.split()) + "], column_name)"
             for load, names in known.items()}
    return f"""
  WITH {', '.join(parts)}, o AS (SELECT * REPLACE ({order['first']} AS position) FROM first_load),
  n AS (SELECT * REPLACE ({order['second']} AS position) FROM second_load),
  both_loads AS (
    SELECT coalesce(o.column_name, n.column_name) AS column_name,
      CASE WHEN o.column_name IS NULL THEN 'added' WHEN n.column_name IS NULL THEN 'dropped'
        WHEN o.data_type <> n.data_type THEN 'retyped' WHEN o.position <> n.position THEN 'moved' END AS change,
      o.data_type AS ot, n.data_type AS nt, o.position AS op, n.position AS np,
      coalesce(n.known_values, o.known_values) AS known_values
    FROM o FULL JOIN n ON o.column_name = n.column_name)
  SELECT 'orders' AS table_name, column_name, change,
    CASE WHEN change = 'moved' THEN cast(op as varchar) ELSE ot END AS old,
    CASE WHEN change = 'moved' THEN cast(np as varchar) ELSE nt END AS new, known_values, 'second' AS load_id
  FROM both_loads WHERE change IS NOT NULL"""


@query("dq_schema_history", _history_sql())
def schema_history(t: Tables) -> DataFrame:
    """Two loads of two tables; of one, columns have been added, dropped, retyped and moved."""
    path = new_folder(t.spark, "schemas")
    orders, nation = t.given("orders"), t.given("nation")
    later = orders.select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_custkey",
        "o_orderstatus", (F.col("o_orderkey") % 7).alias("o_channel"))
    history.store_schema({"orders": orders, "nation": nation}, path, "first")
    history.store_schema({"orders": later, "nation": nation}, path, "second")
    return history.drift_over(t.spark.read.parquet(path), ["first", "second"])


_COUNTED = {
    "bronze_customers": "b_customers", "bronze_transactions": "b_transactions",
    "dim_customer": "s_dim_customer", "fact_transaction": "s_fact_transaction",
    "gold_daily_txn_summary": "g_daily_txn_summary", "gold_loan_portfolio": "g_loan_portfolio"}


@query("layer_row_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
    for name, source in _COUNTED.items()))
def layer_row_counts(t: Tables) -> DataFrame:
    return tables.row_counts({
        "bronze_customers": t.raw("customers"), "bronze_transactions": t.raw("transactions"),
        "dim_customer": t.customers, "fact_transaction": t.transactions,
        "gold_daily_txn_summary": t.daily_summary, "gold_loan_portfolio": t.loan_portfolio})


_ALL_COUNTED = {
    **{f"bronze_{e}": f"b_{e}" for e in BRONZE_COLUMNS}, **{name: f"s_{name}" for name in SILVER_DDL},
    **{name: name.replace("gold_", "g_") for name in GOLD_DDL}}


@query("layer_row_counts_all", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
    for name, source in _ALL_COUNTED.items()))
def layer_row_counts_all(t: Tables) -> DataFrame:
    """Layers are stored one after the other, as a warehouse has them, and counted from there."""
    t = t.keeping(*BRONZE_COLUMNS, *CONFORMED)
    return tables.row_counts({
        **{f"bronze_{e}": t.raw(e) for e in BRONZE_COLUMNS},
        "dim_customer": t.customers, "dim_account": t.accounts, "dim_branch": t.branches,
        "dim_product": t.products, "dim_date": t.calendar, "fact_transaction": t.transactions,
        "fact_loan": t.loans, "gold_customer_360": t.customer_360,
        "gold_branch_performance": t.branch_performance, "gold_daily_txn_summary": t.daily_summary,
        "gold_loan_portfolio": t.loan_portfolio})


# --- jobs and streams ----------------------------------------------------------------------


@query("job_source_to_bronze", " UNION ALL ".join(
    f"SELECT 'bronze_{e}' AS table_name, count(*) AS row_count, 1 AS batches FROM b_{e}"
    for e in BRONZE_COLUMNS))
def job_source_to_bronze(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "job")
    landing = []
    for entity in BRONZE_COLUMNS:
        path = f"{root}/landing/{entity}"
        if entity == "branches":
            t.raw(entity).write.json(path)
        else:
            _to_csv(t.raw(entity), path)
        kind = {"branches": "json", "product_types": "csv_header"}.get(entity, "csv")
        landing.append(Landing(entity, path, kind))
    source_to_bronze(t.spark, landing, f"{root}/bronze")
    stored = [
        t.spark.read.parquet(f"{root}/bronze/bronze_{e}").agg(
            F.count("*").alias("row_count"),
            F.count_distinct("_batch_id").cast("int").alias("batches"))
        .withColumn("table_name", F.lit(f"bronze_{e}")) for e in BRONZE_COLUMNS]
    merged = stored[0]
    for part in stored[1:]:
        merged = merged.unionByName(part)
    return merged


@query("job_incremental_silver", f"""
  SELECT {columns_of('dim_customer')},
    (SELECT count(DISTINCT transaction_id) FROM b_transactions) AS n_facts,
    (SELECT count(DISTINCT transaction_id) FROM b_transactions) AS n_fact_ids
  FROM v_merged""")
def job_incremental_silver(t: Tables) -> DataFrame:
    """Day one, day two with all transactions sent again and late ones, and day two once more."""
    root = new_folder(t.spark, "daily")
    facts = f"{root}/fact_transaction"
    first = {"customers": t.raw("customers").filter(F.col("customer_since") < FIRST_LOAD),
             "transactions": t.raw("transactions").filter(
                 F.col("transaction_date") < TRANSACTION_CUTOFF)}
    second = {"customers": t.raw("customers_day2")}
    for day, changed in (("one", first), ("two", second)):
        for entity in BRONZE_COLUMNS:
            tables.write_table(changed.get(entity, t.raw(entity)), f"{root}/{day}/bronze_{entity}")
    bronze_to_silver(t.spark, f"{root}/one", f"{root}/silver1", AS_OF, FIRST_DAY, facts=facts)
    for known, new in (("silver1", "silver2"), ("silver2", "silver3")):
        update_silver(t.spark, f"{root}/two", f"{root}/{known}", f"{root}/{new}", facts, AS_OF, SECOND_DAY)
    stored = t.spark.read.parquet(facts)
    customers = files.scan_parquet(t.spark, f"{root}/silver3", "dim_customer")
    return customers.withColumns({
        "n_facts": stored.select(F.count("*")).scalar(),
        "n_fact_ids": stored.select(F.count_distinct("transaction_id")).scalar()})


_MARTS = {
    "gold_customer_360": (
        "customer_id full_name city state customer_since last_transaction_date customer_segment",
        "total_accounts active_accounts total_balance avg_balance total_transactions total_credit_amount "
        "total_debit_amount active_loans total_loan_outstanding risk_score"),
    "gold_branch_performance": (
        "branch_id branch_name city report_month",
        "total_customers total_accounts total_deposits total_withdrawals net_flow total_loans_disbursed "
        "active_loans npa_amount"),
    "gold_daily_txn_summary": (
        "transaction_date channel transaction_type",
        "total_count success_count failed_count total_amount avg_amount max_amount min_amount"),
    "gold_loan_portfolio": (
        "loan_type report_month",
        "total_loans active_loans defaulted_loans total_principal total_outstanding avg_interest_rate "
        "avg_tenure_months npa_ratio")}


def _tall_sql(mart: str, source: str) -> str:
    keys, measures = (part.split() for part in _MARTS[mart])
    return f"""
  SELECT '{mart}' AS mart, concat_ws('|', {', '.join(f"cast({k} as varchar)" for k in keys)}) AS row_key,
    unnest([{', '.join(f"'{m}'" for m in measures)}]) AS measure,
    unnest([{', '.join(f"cast({m} as double)" for m in measures)}]) AS value FROM {source}"""


def _tall(df: DataFrame, mart: str) -> DataFrame:
    keys, measures = (part.split() for part in _MARTS[mart])
    pairs = ", ".join(f"'{m}', cast({m} as double)" for m in measures)
    return df.selectExpr(
        f"'{mart}' AS mart", f"concat_ws('|', {', '.join(f'cast({k} as string)' for k in keys)}) AS row_key",
        f"stack({len(measures)}, {pairs}) AS (measure, value)")


_ONCE = {"s_fact_transaction": "once", "g_transactions": "once_by_customer", "s_dim_customer": "v_merged"}


def _of_once(layer: str) -> str:
    text = LAYERS[layer]
    for name, other in _ONCE.items():
        text = text.replace(name, other)
    return text


@query("job_incremental_gold", f"""
  WITH once AS (SELECT * FROM s_fact_transaction QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY transaction_date < date '{TRANSACTION_CUTOFF}' DESC, transaction_date DESC) = 1),
  once_by_customer AS ({_of_once('g_transactions')}), people AS ({_of_once('g_customer_360')}),
  offices AS ({_of_once('g_branch_performance')}), days AS ({_of_once('g_daily_txn_summary')})
  {_tall_sql('gold_customer_360', 'people')} UNION ALL {_tall_sql('gold_branch_performance', 'offices')}
  UNION ALL {_tall_sql('gold_daily_txn_summary', 'days')}
  UNION ALL {_tall_sql('gold_loan_portfolio', 'g_loan_portfolio')}""")
def job_incremental_gold(t: Tables) -> DataFrame:
    """Marts of day one, brought up to day two, which adds transactions, late ones among them, and loans."""
    root = new_folder(t.spark, "refresh")
    facts = fact_store(t.spark, f"{root}/fact_transaction")
    first = {"customers": t.raw("customers").filter(F.col("customer_since") < FIRST_LOAD),
             "transactions": t.raw("transactions").filter(F.col("transaction_date") < TRANSACTION_CUTOFF),
             "loans": t.raw("loans").filter(F.col("disburse_date") < TRANSACTION_CUTOFF)}
    for day, changed in (("one", first), ("two", {"customers": t.raw("customers_day2")})):
        for entity in BRONZE_COLUMNS:
            tables.write_table(changed.get(entity, t.raw(entity)), f"{root}/{day}/bronze_{entity}")
    silver = [f"{root}/silver1", f"{root}/silver2"]
    bronze_to_silver(t.spark, f"{root}/one", silver[0], AS_OF, FIRST_DAY, facts=facts.path, load="one")
    refresh_gold(t.spark, silver[0], facts, f"{root}/state", f"{root}/gold1")
    update_silver(t.spark, f"{root}/two", silver[0], silver[1], facts.path, AS_OF, SECOND_DAY, load="two")
    refresh_gold(t.spark, silver[1], facts, f"{root}/state", f"{root}/gold2", ["two"], silver[0])
    marts = [_tall(mart(t.spark, f"{root}/state", f"{root}/gold2", name), name) for name in _MARTS]
    return reduce(DataFrame.unionByName, marts)


@query("mapping_marts", " UNION ALL ".join(
    _tall_sql(name, name.replace("gold_", "g_")) for name in _MARTS))
def mapping_marts(t: Tables) -> DataFrame:
    """All marts, built from their mappings over the conformed tables, which are stored once for them."""
    t = t.keeping(*CONFORMED)
    built = {"dim_customer": t.customers, "dim_account": t.accounts, "dim_branch": t.branches,
             "fact_transaction": t.transactions, "fact_loan": t.loans}
    return reduce(DataFrame.unionByName, (
        _tall(mart_mapping.build(m, built.__getitem__), name) for name, m in mart_mapping.MARTS.items()))


@query("mapping_raw", f"""
  SELECT {', '.join(BRONZE_COLUMNS['loans'])}, 'loans.csv' AS _source_file, 'b7' AS _batch_id FROM b_loans""")
def mapping_raw(t: Tables) -> DataFrame:
    return mart_mapping.apply_raw(t.raw("loans"), "loans", "b7", "loans.csv").drop("_ingestion_ts")


@query("ingest_incremental_stream", f"""
  SELECT {_text_columns('transactions')},
    CASE WHEN transaction_date >= '{TRANSACTION_CUTOFF}' THEN 'second' ELSE 'first' END AS _batch_id
  FROM b_transactions""")
def ingest_incremental(t: Tables) -> DataFrame:
    """Files land in two lots; the second call takes only what is new."""
    root = new_folder(t.spark, "ingest")
    landing, target, marks = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    rows = t.raw("transactions")
    newer = F.col("transaction_date") >= TRANSACTION_CUTOFF
    for batch, lot in (("first", rows.filter(~newer)), ("second", rows.filter(newer))):
        _to_csv(lot, landing, "append")
        streams.finish(streams.ingest_new_files(
            t.spark, landing, "transactions", target, marks, batch))
    return t.spark.read.parquet(target).drop("_ingestion_ts", "_source_file")


@query("stream_dedup_watermark", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """Every event is sent, then those of two types again; the stream keeps one of each."""
    root = new_folder(t.spark, "dedup")
    events = t.given("events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(f"{root}/arriving")
    events.filter(F.col("event_type").isin("click", "purchase")).write.mode("append").parquet(
        f"{root}/arriving")
    arriving = streams.read_stream(t.spark, f"{root}/arriving", events.schema)
    streams.store_all_available(
        streams.drop_resent(arriving, ["event_id"], "ts", "60 days", streams.file_block()),
        f"{root}/kept", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/kept").select(
        "event_id", "user_id", "event_type", "value")


_LATE = "12 days"
_FIRST_LOTS = "2024-01-10", "2024-01-20"


@query("stream_late_rows", f"""
  SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 10 = 0 AND ts < (
      SELECT max(ts) - INTERVAL {_LATE} FROM events
      WHERE event_id % 10 <> 0 AND ts < timestamp '{_FIRST_LOTS[1]}') THEN 'late' ELSE 'kept' END AS side
  FROM events""")
def stream_late_rows(t: Tables) -> DataFrame:
    """Three lots by time; every tenth event comes with the last one, which also repeats all clicks."""
    root = new_folder(t.spark, "late")
    events = t.given("events").withColumn("ts", F.col("ts").cast("timestamp")).select(
        "event_id", "user_id", "event_type", "value", "ts")
    kept, late = (FactStore(t.spark, f"{root}/{n}", events.schema, "event_id", "ts") for n in ("kept", "late"))
    tenth, before = F.col("event_id") % 10 == 0, [F.col("ts") < d for d in _FIRST_LOTS]
    lots = [events.filter(~tenth & before[0]), events.filter(~tenth & ~before[0] & before[1]),
            events.filter(tenth | ~before[1]).unionByName(events.filter("event_type = 'click'"))]
    for lot in lots:
        lot.write.mode("append").parquet(f"{root}/arriving")
        arriving = streams.read_stream(t.spark, f"{root}/arriving", events.schema)
        streams.finish(streams.store_with_late(
            arriving, kept, late, "ts", _LATE, f"{root}/progress", f"{root}/checkpoint"))
    sides = [store.rows().withColumn("side", F.lit(name)) for store, name in ((kept, "kept"), (late, "late"))]
    return sides[0].unionByName(sides[1]).select("event_id", "user_id", "event_type", "value", "side")


@query("stream_decision_rule", """
  SELECT series_id, reading_id, CASE WHEN fineness > 8.0 THEN 'increase separator speed'
    WHEN fineness < 6.5 THEN 'decrease separator fan' ELSE 'hold' END AS advice
  FROM b_sensor_readings""")
def stream_decision(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "advice")
    scored = t.readings.select("series_id", "reading_id", "fineness")
    scored.write.parquet(f"{root}/scored")
    arriving = streams.read_stream(t.spark, f"{root}/scored", scored.schema)
    streams.store_all_available(
        streams.advise(arriving, "fineness").drop("fineness"),
        f"{root}/advice", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/advice")


