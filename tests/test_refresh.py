"""Facts stored once by id, and marts refreshed by the months that a load has touched."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from terrace import registry
from terrace.plans import facts as F_
from terrace.plans import gold, jobs, refresh
from terrace.plans.facts import MONTH, FactStore
from terrace.registry.common import CONFORMED, Tables
from terrace.registry.layers_sql import AS_OF, FIRST_DAY, SECOND_DAY
from terrace.schemas import BRONZE_COLUMNS
from terrace.session import folders, shared_root
from terrace.sources import tables
from terrace.sources.given import FIRST_LOAD, TRANSACTION_CUTOFF
from tests.conftest import SMALL, day, plan_of, rows_of

DDL = "id string, d date, amount int"


@pytest.fixture
def store(spark, frame, tmp_path):
    return FactStore(spark, str(tmp_path / "facts"), frame(DDL).schema, "id", "d", buckets=8, merge_after=2)


def batch(frame, *rows):
    return frame(DDL, *((i, day(d), n) for i, d, n in rows))


def stored(store):
    return rows_of(store.rows(), "id", MONTH, "amount")


def test_an_id_is_stored_once_whatever_its_month(store, frame):
    assert store.add(batch(frame, ("a", "2024-01-05", 1), ("b", "2024-02-01", 2)), "one") == 2
    again = batch(frame, ("a", "2024-03-09", 9), ("c", "2024-01-31", 3), ("c", "2024-04-01", 4))
    assert store.add(again, "two", [F.col("d").desc()]) == 1
    assert stored(store) == [("a", "2024-01", 1), ("b", "2024-02", 2), ("c", "2024-04", 4)]
    assert store.add(again, "two") == store.add(again, "three") == 0
    assert store.months_of(["two"]) == ["2024-04"] and store.months_of() == ["2024-01", "2024-02", "2024-04"]
    assert store.months_of(["three"]) == [] and store.add(batch(frame), "four") == 0


def test_only_touched_buckets_and_months_are_read(store, frame):
    store.add(batch(frame, *((f"k{i}", f"2024-{1 + i % 12:02}-03", i) for i in range(200))), "one")
    some = store.index([3])
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(some)
    files = lambda df: {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    assert all("bucket=3" in f for f in files(some)) and len(files(some)) < len(files(store.index()))
    assert all("transaction_month=2024-05" in f for f in files(store.rows(["2024-05"])))
    one = store.unseen(batch(frame, ("k1", "2025-01-01", 0), ("new", "2025-01-01", 0)))
    assert rows_of(one, "id") == [("new",)]


def test_only_new_rows_are_resolved_and_only_repeated_ids_sorted(store, frame):
    seen = []

    def resolve(df):
        seen.append(rows_of(df, "id", "amount"))
        return df
    store.add(batch(frame, ("a", "2024-01-05", 1), ("b", "2024-02-01", 2)), "one", (), resolve)
    sent = batch(frame, ("a", "2024-01-05", 1), ("b", "2024-02-01", 2), ("c", "2024-03-01", 3), ("c", "2024-03-02", 4))
    assert store.add(sent, "two", [F.col("d").desc()], resolve) == 1
    assert seen == [[("a", 1), ("b", 2)], [("c", 4)]]
    assert store.add(sent, "three", [F.col("d").desc()], resolve) == 0 and seen[2:] == [[]]
    without = batch(frame, (None, "2024-01-05", 1), (None, "2024-01-06", 2), ("b", "2024-01-06", 2))
    assert rows_of(store.unseen(without, [F.col("d").desc()]), "amount") == [(2,)]


def test_tables_are_built_once_for_all_that_is_read_from_them(spark):
    scans = lambda name: plan_of(registry.QUERIES[name](Tables(spark, SMALL))).split("Initial Plan")[0].count(
        "/lineitem.parquet")
    assert scans("mapping_marts") == 0 and scans("layer_row_counts_all") <= 1  # the calendar's bounds
    assert scans("dq_lineage_bits") == 1
    kept = Tables(spark, SMALL).keeping(*CONFORMED)
    assert all("lineitem" not in plan_of(df) for df in (kept.customer_360, kept.branch_performance, kept.daily_summary))


def test_many_loads_are_merged_by_bucket(store, frame):
    for load in range(6):
        store.add(batch(frame, *((f"{load}-{i}", "2024-01-01", i) for i in range(20))), f"l{load}")
    loads = store.index().groupBy("bucket").agg(F.count_distinct("load_id").alias("n")).agg(F.max("n")).first()[0]
    assert loads <= 3
    ids = rows_of(store.index(), "id")
    assert len(ids) == len(set(ids)) == 120
    assert store.add(batch(frame, *((f"{load}-{i}", "2025-01-01", i) for load in range(6) for i in range(20))), "x") == 0


def test_a_load_that_was_interrupted_is_finished_by_the_next(store, frame, monkeypatch):
    store.add(batch(frame, ("a", "2024-01-05", 1)), "one")
    whole = F_.replace_partitions

    def lost(df, path, *by):
        if path.endswith("_ids"):
            raise RuntimeError("the driver is gone")
        whole(df, path, *by)
    monkeypatch.setattr(F_, "replace_partitions", lost)
    with pytest.raises(RuntimeError):
        store.add(batch(frame, ("b", "2024-01-06", 2)), "two")
    monkeypatch.setattr(F_, "replace_partitions", whole)
    assert store.add(batch(frame, ("b", "2024-02-06", 3), ("c", "2024-02-06", 3)), "three") == 1
    assert stored(store) == [("a", "2024-01", 1), ("b", "2024-01", 2), ("c", "2024-02", 3)]
    # One that was interrupted while it was staged leaves nothing behind.
    store.spark.range(1).write.parquet(f"{store.staging}/four")
    F_.remove(store.spark, f"{store.staging}/four/_SUCCESS")
    assert store.finish_staged() == [] and not F_.exists(store.spark, f"{store.staging}/four")


def test_a_load_leaves_no_copies_of_its_rows(spark, store, frame):
    kept = lambda: {n for n in folders(spark, shared_root(spark)) if n.startswith(("cut-", "scratch-"))}
    before = kept()
    store.add(batch(frame, ("a", "2024-01-05", 1), ("a", "2024-01-06", 2), ("b", "2024-02-01", 3)), "one", [F.col("d").desc()])
    assert kept() == before and folders(spark, store.staging) == ["one.done"]
    assert rows_of(store.staged("one"), "id", "amount") == [("a", 2), ("b", 3)]
    # One that was interrupted after it was stored loses its copy with the next.
    spark.range(1).write.parquet(f"{store.staging}/one")
    assert store.add(batch(frame, ("a", "2024-03-05", 1)), "one") == 0
    assert folders(spark, store.staging) == ["one.done"]


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """Two days of loads and both refreshes."""
    t, root = Tables(spark, SMALL), str(tmp_path_factory.mktemp("refresh"))
    one = {"customers": t.raw("customers").filter(F.col("customer_since") < FIRST_LOAD),
           "transactions": t.raw("transactions").filter(F.col("transaction_date") < TRANSACTION_CUTOFF),
           "loans": t.raw("loans").filter(~F.col("disburse_date").startswith("1996-0"))}
    late = t.raw("transactions").filter("transaction_date < '1996-03-01'").withColumn(
        "transaction_id", F.concat("transaction_id", F.lit("-late"))).limit(5)
    beyond = t.raw("transactions").limit(2).withColumns({
        "transaction_id": F.concat("transaction_id", F.lit("-far")), "transaction_date": F.lit("2011-07-01")})
    resent = t.raw("transactions").filter(F.col("transaction_date") < TRANSACTION_CUTOFF).limit(4).withColumn("transaction_date", F.lit("2003-01-01"))
    two = {"customers": t.raw("customers_day2"), "transactions": late.unionByName(beyond).unionByName(resent),
           "loans": t.raw("loans").filter(F.col("disburse_date").startswith("1996-"))}
    for name, changed in (("one", one), ("two", two)):
        for entity in BRONZE_COLUMNS:
            tables.write_table(changed.get(entity, t.raw(entity)), f"{root}/{name}/bronze_{entity}")
    store = jobs.fact_store(spark, f"{root}/facts")
    jobs.bronze_to_silver(spark, f"{root}/one", f"{root}/s1", AS_OF, FIRST_DAY, facts=store.path, load="one")
    first = refresh.refresh_gold(spark, f"{root}/s1", store, f"{root}/state", f"{root}/g1")
    jobs.update_silver(spark, f"{root}/two", f"{root}/s1", f"{root}/s2", store.path, AS_OF, SECOND_DAY, load="two")
    second = refresh.refresh_gold(
        spark, f"{root}/s2", store, f"{root}/state", f"{root}/g2", ["two"], f"{root}/s1")
    return root, store, first, second


def test_a_refresh_touches_what_the_load_did(spark, layers):
    root, store, first, second = layers
    late = store.staged("two").select(MONTH).distinct()
    assert second["transactions"] == sorted(r[0] for r in late.collect()) and "2011-07" in second["transactions"]
    assert 0 < len(second["transactions"]) < len(first["transactions"]) / 3
    assert "2003-01" not in second["transactions"]  # ids sent again under another month
    # loans sent again count where their customer has a new version
    assert {"1996-01", "1996-09"} <= set(second["loans"]) and all(m.startswith("1996-") for m in second["loans"])
    assert refresh.refresh_gold(spark, f"{root}/s2", store, f"{root}/state", f"{root}/g3", [], f"{root}/s2") == {
        "transactions": [], "loans": []}


@pytest.mark.parametrize("name", ["gold_customer_360", "gold_branch_performance", "gold_daily_txn_summary",
                                  "gold_loan_portfolio"])
def test_refreshed_marts_equal_a_full_rebuild(spark, layers, name):
    root, store, _, _ = layers
    jobs.silver_to_gold(spark, f"{root}/s2", f"{root}/full", facts=store.path)
    plain = lambda df: rows_of(df.drop("_etl_loaded_ts").selectExpr(*(
        f"cast({f.name} as string)" for f in df.schema.fields if f.name != "_etl_loaded_ts")).fillna("-"))
    assert plain(refresh.mart(spark, f"{root}/state", f"{root}/g2", name)) == plain(
        spark.read.parquet(f"{root}/full/{name}"))


def test_the_calendar_grows_with_the_facts(spark, layers):
    root, store, _, _ = layers
    days = {s: rows_of(spark.read.parquet(f"{root}/{s}/dim_date"), "full_date") for s in ("s1", "s2")}
    assert set(days["s1"]) < set(days["s2"]) and days["s2"][-1] == (date(2011, 12, 31),)
    assert (days["s2"][-1][0] - days["s2"][0][0]).days + 1 == len(days["s2"])
    calendar = spark.read.parquet(f"{root}/s2/dim_date")
    assert store.rows().join(calendar, "date_sk", "left_anti").count() == 0


def test_parts_add_up_to_the_marts(spark):
    t = Tables(spark, SMALL)
    months = t.transactions.withColumn(MONTH, F.date_format("transaction_date", "yyyy-MM"))
    parts = refresh.activity(months)
    assert parts.count() < months.count()
    whole, added = (rows_of(gold.account_measures(t.accounts, df).fillna(0)) for df in (t.transactions, parts))
    assert whole == added
