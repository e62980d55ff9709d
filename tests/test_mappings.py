"""Marts from mappings against the marts that are written out, and paths on small frames."""

import pytest
from pyspark.sql import functions as F

from terrace.plans import mart_mapping as M
from terrace.plans.mart_mapping import Hop, Mart, Measure, Side
from terrace.registry.common import Tables
from terrace.schemas import BRONZE_COLUMNS, table_schema
from tests.conftest import SMALL, rows_of


@pytest.mark.parametrize("name,written", [
    ("gold_customer_360", "customer_360"), ("gold_branch_performance", "branch_performance"),
    ("gold_daily_txn_summary", "daily_summary"), ("gold_loan_portfolio", "loan_portfolio")])
def test_marts_from_mappings_equal_the_written_ones(spark, name, written):
    t = Tables(spark, SMALL)
    built = {"dim_customer": t.versions, "dim_account": t.accounts, "dim_branch": t.branches,
             "fact_transaction": t.transactions, "fact_loan": t.loans}
    if name != "gold_customer_360":
        built["dim_customer"] = t.customers
        want = getattr(t, written)
    else:  # over several versions of a customer
        from terrace.plans import gold
        want = gold.customer_360(t.versions, t.accounts, t.transactions, t.loans)
    plain = lambda df: rows_of(df.select(*(F.col(c).cast("string") for c in df.columns if c != "_etl_loaded_ts")).fillna("-"))
    got = M.build(M.MARTS[name], built.__getitem__)
    kinds = lambda schema: [(f.name, f.dataType) for f in schema]
    assert kinds(got.schema) == kinds(table_schema(name)) and plain(got) == plain(want)


def test_mappings_conform(spark):
    found = M.conformance(spark)
    assert found.filter("NOT in_contract OR NOT in_mapping").count() == 0
    assert found.select("table_name").distinct().count() == len(BRONZE_COLUMNS) + 4


def test_measures_add_up_over_hops(frame):
    tables = {
        "sale": frame("till int, amount int, ok string", (1, 2, "y"), (1, 4, "n"), (2, 9, "y"), (None, 1, "y")),
        "till": frame("till int, shop string", (1, "a"), (2, "a"), (3, "b")),
        "shop": frame("shop string, town string", ("a", "x"), ("b", "x"), ("c", "z")),
        "town": frame("town string", ("x",), ("z",), ("q",))}
    hops = [Hop("till", "till", "shop"), Hop("shop", "shop", "town")]
    side = Side("sale", "town", hops, [
        Measure("n", "count"), Measure("good", "count", "1", "ok = 'y'"), Measure("total", "sum", "amount"),
        Measure("mean", "avg", "amount"), Measure("least", "min", "amount"), Measure("most", "max", "amount")])
    got = M._side(side, tables.__getitem__)
    assert [tuple(map(float, r[1:])) for r in got.collect()] == [(3, 2, 15, 5, 2, 9)]
    assert rows_of(M._side(Side("till", "shop", measures=[Measure("tills", "count_distinct", "till"), Measure("n", "count")]),
                           tables.__getitem__)) == [("a", 2, 2), ("b", 1, 1)]
    with pytest.raises(ValueError):
        M._side(Side("sale", "town", hops, [Measure("d", "count_distinct", "till")]), tables.__getitem__)
    mart = Mart("m", "town", ["town"], sides=[side], derived={"half": "n / 2", "whole": "half * 2"})
    assert {"town", "n", "half"} <= set(mart.targets())


def test_raw_mapping(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("product_id,product_name,product_category,interest_rate\na,b,c,1\n")
    row = M.apply_raw(spark.read.option("header", True).csv(str(path)), "product_types", "b1").first()
    assert (row._source_file, row._batch_id, row.interest_rate) == ("p.csv", "b1", "1") and row._ingestion_ts
