import json
from datetime import datetime

from pyspark.sql import functions as F

from terrace import session
from terrace.operators.compare import (compare_files, file_pair, header_findings, wrong_extension)
from terrace.plans import jobs
from terrace.plans.mapping import mapping_conformance
from terrace.schemas import ALL_TABLES, BRONZE_COLUMNS, table_schema
from terrace.sources import files, jdbc, tables
from terrace.streaming import streams
from tests.conftest import SMALL, rows_of
from terrace.registry.common import Tables
from terrace.registry.layers_sql import AS_OF, FIRST_DAY, SECOND_DAY
from terrace.sources.given import FIRST_LOAD, TRANSACTION_CUTOFF


def text_file(path, text):
    path.write_text(text)
    return str(path)


def test_csv_empty_fields_are_null(spark, tmp_path):
    path = text_file(tmp_path / "p.csv", 'product_id,product_name,product_category,interest_rate\n'
                     'P1,,"",3.5\nP2, x ,"a,b",\n')
    assert rows_of(files.scan_csv(spark, path, "product_types")) == [
        ("P1", None, None, "3.5"), ("P2", " x ", "a,b", None)]
    assert rows_of(files.scan_csv_header(spark, path)) == rows_of(
        files.scan_csv(spark, path, "product_types"))
    bars = text_file(tmp_path / "p2.csv", "product_id|product_name|product_category|interest_rate\n"
                     "P1|a|b|1\n")
    assert rows_of(files.scan_csv(spark, bars, "product_types", "|")) == [("P1", "a", "b", "1")]


def test_json_array_becomes_text(spark, tmp_path):
    path = text_file(tmp_path / "b.json", json.dumps(
        [{"branch_id": "B1", "pin_code": 600001, "is_active": True}, {"branch_id": "B2"}], indent=1))
    got = files.scan_json(spark, path, "branches", multi_line=True)
    assert got.columns == BRONZE_COLUMNS["branches"]
    assert rows_of(got.fillna("-"), "branch_id", "pin_code", "is_active") == [
        ("B1", "600001", "true"), ("B2", "-", "-")]


def test_audit_takes_the_file_name_from_the_row(spark, tmp_path):
    path = text_file(tmp_path / "p.csv", "product_id,product_name,product_category,interest_rate\na,b,c,1\n")
    row = files.add_audit(files.scan_csv(spark, path, "product_types"), "b1",
                          ingested_at=datetime(2024, 1, 1)).first()
    assert (row._source_file, row._batch_id, row._ingestion_ts) == (
        "p.csv", "b1", datetime(2024, 1, 1))


def test_file_pair_compares_by_position(spark, tmp_path):
    csv = text_file(tmp_path / "a.csv", "c1,c2\n1,x\n2,y\n3,z\n")
    objects = [{"c1": "1", "c2": "x"}, {"c1": "2", "c2": "Y"}, {"c1": "3"}, {"c1": "4", "c2": "w"}]
    array = text_file(tmp_path / "a.json", json.dumps(objects))
    lines = text_file(tmp_path / "b.json", "\n".join(map(json.dumps, objects)))
    expected = {(1, "c2", "y", "Y", "different"), (2, "c2", "z", None, "different"),
                (3, "*", None, None, "missing on left")}
    assert {tuple(r) for r in compare_files(spark, csv, array).collect()} == expected
    assert {tuple(r) for r in compare_files(spark, csv, lines, multi_line=False).collect()} == expected
    assert wrong_extension(csv, "json") and not wrong_extension(array, "JSON")
    assert header_findings(spark.createDataFrame([], "a int, b int"),
                           spark.createDataFrame([], "b int, c int")) == [
        ("a", "missing on right"), ("c", "missing on left")]


def test_all_findings_on_a_file_pair(spark, tmp_path):
    csv = text_file(tmp_path / "a.txt", "c1,c2\n1,x\n2,y\n3,z\n")
    lines = text_file(tmp_path / "b.json", "\n".join(map(json.dumps, [
        {"c1": "1", "c3": 5}, {"c1": "2"}, {"c1": "9"}, {"c1": "4"}])))
    assert {tuple(r) for r in file_pair(spark, csv, lines).collect()} == {
        ("extension", None, "*", csv, "csv", "different"), ("header", None, "c2", None, None, "missing on right"),
        ("header", None, "c3", None, None, "missing on left"), ("row_count", None, "*", "3", "4", "different"),
        ("cell", 2, "c1", "3", "9", "different"), ("cell", 3, "*", None, None, "missing on left")}
    same = text_file(tmp_path / "c.json", "\n".join(map(json.dumps, [{"c1": "1", "c2": "x"}, {"c1": "2", "c2": "y"}, {"c1": "3", "c2": "z"}])))
    right = text_file(tmp_path / "c.csv", "c1,c2\n1,x\n2,y\n3,z\n")
    assert [tuple(r) for r in file_pair(spark, right, same).collect()] == [("row_count", None, "*", "3", "3", "equal")]


def test_positions_run_on_over_many_blocks(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 5000, numPartitions=3).write.option("header", True).csv(path)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        placed = files.with_row_position(files.scan_csv_header(spark, path))
        assert [r[0] for r in rows_of(placed, "row_position")] == list(range(5000))
        # Files are numbered one after the other, each in its own order.
        assert placed.filter("row_position <> cast(id as int)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_write_counts_and_months(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("id int, d string", (1, "2024-01-05"), (2, "2024-02-05")).withColumn(
        "d", F.col("d").cast("date"))
    assert tables.write_by_month(df, path, "d") == 2
    assert tables.write_by_month(df.filter("id = 2").withColumn("id", F.lit(20)), path, "d") == 1
    stored = spark.read.parquet(path)
    assert rows_of(stored, "id") == [(1,), (20,)]
    one_month = stored.filter("transaction_month = '2024-01'")
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_month" in plan
    assert tables.write_table(df, str(tmp_path / "p")) == 2


def test_every_contract_can_be_created(spark, tmp_path):
    for table in ALL_TABLES:
        name = f"made_{table}"
        tables.create_table(spark, name, table, str(tmp_path / table))
        assert spark.table(name).schema == table_schema(table)
        spark.sql(f"DROP TABLE {name}")


def test_mappings_conform(spark):
    assert mapping_conformance(spark).filter("NOT in_contract OR NOT in_mapping").count() == 0


def test_jdbc_options():
    db = jdbc.Database("jdbc:x://host/db", "x.Driver", {"user": "u"})
    assert jdbc.query_options(db, "SELECT 1")["query"] == "SELECT 1"
    options = jdbc.table_options(db, "t", jdbc.Slices("id", "0", "100", 4))
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert options["dbtable"] == "t" and options["user"] == "u"
    assert jdbc.write_options(db, "t")["batchsize"] == "10000"


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    target, marks = str(tmp_path / "bronze"), str(tmp_path / "marks")
    header = ",".join(BRONZE_COLUMNS["product_types"]) + "\n"

    def ingest(batch):
        streams.finish(streams.ingest_new_files(
            spark, str(landing), "product_types", target, marks, batch), timeout=120)
        return rows_of(spark.read.parquet(target), "product_id", "_source_file", "_batch_id")

    text_file(landing / "a.csv", header + "p1,a,b,1\n")
    assert ingest("b1") == [("p1", "a.csv", "b1")]
    assert ingest("b2") == [("p1", "a.csv", "b1")]
    text_file(landing / "b.csv", header + "p2,a,b,1\n")
    assert ingest("b3") == [("p1", "a.csv", "b1"), ("p2", "b.csv", "b3")]


def test_jobs_build_all_layers(spark, tmp_path):
    t = Tables(spark, SMALL)
    root = str(tmp_path)
    landing = []
    for entity in BRONZE_COLUMNS:
        path = f"{root}/landing/{entity}"
        if entity == "branches":
            t.raw(entity).write.json(path)
        else:
            t.raw(entity).write.option("header", True).csv(path)
        landing.append(jobs.Landing(entity, path, "json" if entity == "branches" else "csv"))
    batch, bronze = jobs.source_to_bronze(spark, landing, f"{root}/bronze")
    assert len(batch) == 8 and len(bronze) == 6
    assert bronze["bronze_transactions"] == t.raw("transactions").count()
    silver = jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver", "2002-01-01")
    assert set(silver) == {"dim_customer", "dim_account", "dim_branch", "dim_product",
                           "fact_transaction", "quarantine_transaction", "fact_loan", "dim_date"}
    assert silver["quarantine_transaction"] == 0
    ids = t.raw("transactions").select("transaction_id").distinct().count()
    resent = bronze["bronze_transactions"] - ids
    assert silver["fact_transaction"] == ids
    gold = jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold")
    assert gold["gold_customer_360"] == silver["dim_customer"]
    for table in ("gold_customer_360", "gold_branch_performance", "gold_daily_txn_summary",
                  "gold_loan_portfolio"):
        stored = spark.read.parquet(f"{root}/gold/{table}")
        assert stored.schema.names == table_schema(table).names
        assert [f.dataType for f in stored.schema] == [f.dataType for f in table_schema(table)]
    # Stored tables and lazily composed ones agree, but for customers with a transaction sent twice,
    # which the job stores once.
    mart = spark.read.parquet(f"{root}/gold/gold_customer_360").drop("_etl_loaded_ts")
    stored, lazy = rows_of(mart), rows_of(t.customer_360.drop("_etl_loaded_ts"))
    assert len(stored) == len(lazy) and len(set(stored) - set(lazy)) <= resent


def test_loading_again_changes_nothing(spark, tmp_path):
    t, root = Tables(spark, SMALL), str(tmp_path)
    day_one = {"customers": t.raw("customers").filter(F.col("customer_since") < FIRST_LOAD),
               "transactions": t.raw("transactions").filter(F.col("transaction_date") < TRANSACTION_CUTOFF)}
    broken = t.raw("transactions").limit(3).withColumn("amount", F.lit("none")).withColumn(
        "transaction_id", F.concat(F.lit("x"), "transaction_id"))
    day_two = {"customers": t.raw("customers_day2"), "transactions": t.raw("transactions").unionByName(broken)}
    for day, changed in (("one", day_one), ("two", day_two)):
        for entity in BRONZE_COLUMNS:
            tables.write_table(changed.get(entity, t.raw(entity)), f"{root}/{day}/bronze_{entity}")
    facts = f"{root}/facts"
    jobs.bronze_to_silver(spark, f"{root}/one", f"{root}/s1", AS_OF, FIRST_DAY, facts=facts, years=(1990, 1999))
    assert spark.read.parquet(f"{root}/s1/dim_date").count() == 3652
    first = jobs.update_silver(spark, f"{root}/two", f"{root}/s1", f"{root}/s2", facts, AS_OF, SECOND_DAY)
    again = jobs.update_silver(spark, f"{root}/two", f"{root}/s2", f"{root}/s3", facts, AS_OF, SECOND_DAY)
    assert first["quarantine_transaction"] == again["quarantine_transaction"] == 3
    assert first["fact_transaction"] > 0 and again["fact_transaction"] == 0
    stored = spark.read.parquet(facts)
    assert stored.count() == stored.select("transaction_id").distinct().count() == t.raw(
        "transactions").select("transaction_id").distinct().count()

    def customers(layer):
        return rows_of(spark.read.parquet(f"{root}/{layer}/dim_customer").drop("_etl_loaded_ts").fillna("-"))
    assert customers("s2") == customers("s3")
    # Every version of the first day is still there under its key, whatever became of it.
    keys = [{r.customer_sk for r in spark.read.parquet(f"{root}/{s}/dim_customer").collect()} for s in ("s1", "s3")]
    assert keys[0] <= keys[1] and len(keys[1]) > len(keys[0])
    gold = jobs.silver_to_gold(spark, f"{root}/s3", f"{root}/gold", facts=facts)
    assert gold["gold_daily_txn_summary"] > 0


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_folder_beside_the_warehouse_without_a_setting():
    class Context:
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "hdfs:///lake/warehouse/"}
    assert session.shared_root(Session()).startswith("hdfs:///lake/warehouse/_terrace-")
