"""Checks planned together: the results of single checks, and how often inputs are read."""

import re

import pytest
from pyspark.sql import functions as F

from terrace import registry
from terrace.operators import quality as Q
from terrace.operators.check_plan import CheckPlan
from tests.conftest import SMALL, plan_of, rows_of


def results(df):
    return {(r.check_name, r.table_name, r.column_name): (r.metric, r.failed_rows, r.passed) for r in df.collect()}


def test_planned_checks_equal_single_ones(frame):
    child = frame("id int, k string, d int", (1, "a", 1), (1, "b", 2), (2, "z", None), (3, None, 9), (4, "z", 9))
    parent = frame("k string, d int", ("a", 1), ("a", 2), ("b", 4), ("c", 5))
    plan = CheckPlan().input("child", child).input("parent", parent)
    plan.rules("child", [Q.not_null("k"), Q.in_range("d", 0, 5)])
    plan.unique("child", ["id"]).unique("child", ["id", "k"]).unique("parent", ["k"])
    plan.referential("child", "k", "parent", "k", 0.6)
    plan.same_rows("child", "parent").same_rows("child", "parent", ["id"])
    plan.min_distinct("child", "k", 4).covered("child", "k", "parent", "k", "missing", "parent")
    plan.equal(("child", F.sum("d")), ("parent", F.sum("d")), "sum", "both", "d", 0.5, relative=True)
    single = Q.combine([
        Q.apply_rules(child, "child", [Q.not_null("k"), Q.in_range("d", 0, 5)]),
        Q.unique(child, "child", ["id"]), Q.unique(child, "child", ["id", "k"]), Q.unique(parent, "parent", ["k"]),
        Q.referential(child, parent, "k", "k", "child", 0.6),
        Q.row_count_match(child, parent, ("child", "parent")), Q.row_count_match(child, parent, ("child", "parent"), ["id"]),
        Q.min_distinct(child, "child", "k", 4),
        Q.equal_measure(child, parent, F.sum("d"), F.sum("d"), "sum", "both", "d", 0.5, relative=True)])
    planned, wanted = plan.run(), single
    assert planned.schema == wanted.schema or [f.name for f in planned.schema] == [f.name for f in wanted.schema]
    got = results(planned)
    assert got.pop(("missing", "parent", "k")) == (1.0, 1, False)
    assert got == results(wanted)
    assert got["referential", "child", "k"] == (0.5, 2, True)


def test_empty_inputs_and_weights(frame):
    none = frame("k string, n int")
    plan = CheckPlan().input("a", none).input("b", frame("k string, n int", ("x", 3), ("y", 1)), weight="n")
    plan.unique("a", ["k"]).unique("b", ["k"]).referential("b", "k", "a", "k").same_rows("a", "a")
    got = results(plan.run())
    assert got["unique", "a", "k"] == (0.0, 0, True) and got["unique", "b", "k"] == (1.0, 2, False)
    assert got["referential", "b", "k"] == (1.0, 4, False) and got["row_count_match", "a/a", "*"] == (0.0, 0, True)


def test_calendars(frame):
    days = frame("d string", ("2024-01-01",), ("2024-01-02",), ("2024-01-05",)).withColumn("d", F.col("d").cast("date"))
    plan = CheckPlan().input("c", days).no_gaps("c", "d")
    assert results(plan.run())["date_gaps", "c", "d"] == (2.0, 2, False)


def test_an_input_of_several_passes_is_stored_once(frame):
    df = frame("a int, b int", (1, 2), (1, 3))
    plan = CheckPlan().input("x", df.filter("a > 0")).unique("x", ["a"]).unique("x", ["b"]).rules("x", [Q.not_null("a")])
    assert plan.passes() == {"x": 2}
    text = plan_of(plan.run())
    assert "ExistingRDD" not in text and "LocalTableScan" not in text.split("Initial Plan")[-1].replace("LocalTableScan <empty>", "")
    with pytest.raises(ValueError):
        plan.input("x", df)


#: Checks of one table of each layer; a test table stands behind several of them.
PLANNED = ["dq_rowcount_match", "dq_unique", "dq_referential", "dq_sum_reconcile", "dq_agg_reconcile", "dq_date_gaps",
           "dq_empty_groups", "dq_distribution", "dq_conditional", "dq_date_validity"]


@pytest.mark.parametrize("name", PLANNED)
def test_a_layer_is_read_once(spark, name):
    """The largest table, from which the facts, marts and calendars come, once for each view of it."""
    old = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    try:
        text = plan_of(registry.runnable(name)(spark, SMALL)).split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.maxPlanStringLength", old)
    scans = re.findall(r"sf0\.001/(\w+)\.parquet", text)
    # clean and dirty transactions, the raw and the typed fact, the daily mart, the calendar's bounds
    assert scans.count("lineitem") <= {"dq_sum_reconcile": 4, "dq_agg_reconcile": 2,
                                       "dq_rowcount_match": 2, "dq_referential": 3}.get(name, 1)
    assert scans.count("customer") <= 1


def test_failing_rows_are_counted(spark):
    found = results(registry.runnable("dq_referential")(spark, SMALL))
    assert any(not passed and failed for _, failed, passed in found.values())
    assert rows_of(registry.runnable("dq_unique")(spark, SMALL).filter("passed").select("table_name"))
