import shutil
from itertools import permutations

from pyspark.sql import functions as F

from terrace.operators import history, rows
from terrace.operators.quality import version_invariants
from terrace.plans import gold
from tests.conftest import day, plan_of, rows_of

ATTRIBUTES = "customer_id string, city string, phone string"
TRACKED = ["city", "phone"]


def merge(versions, incoming, on):
    return history.scd2_merge(versions, incoming, "customer_id", "customer_sk", TRACKED, on)


def spans(versions):
    return rows_of(versions.select(
        "customer_id", "city", F.col("effective_date").cast("string"),
        F.col("expiry_date").cast("string"), "is_current"))


def start(frame, *rows):
    return history.open_versions(
        frame(ATTRIBUTES, *rows), "customer_id", "customer_sk", "2024-01-01")


def test_merge_over_several_days(frame):
    versions = start(frame, ("a", "Rome", "1"), ("b", "Oslo", "2"))
    second = frame(ATTRIBUTES, ("a", "Paris", "1"), ("c", "Bonn", "3"))
    versions = merge(versions, second, "2024-02-01")
    expected = [
        ("a", "Paris", "2024-02-01", "9999-12-31", "Y"),
        ("a", "Rome", "2024-01-01", "2024-01-31", "N"),
        ("b", "Oslo", "2024-01-01", "9999-12-31", "Y"),
        ("c", "Bonn", "2024-02-01", "9999-12-31", "Y"),
    ]
    assert spans(versions) == expected
    # The same input again, the same day or later, changes nothing.
    assert spans(merge(versions, second, "2024-02-01")) == expected
    assert spans(merge(versions, second, "2024-03-01")) == expected
    # A second change on the same day replaces the open version.
    corrected = merge(versions, frame(ATTRIBUTES, ("a", "Nice", "1")), "2024-02-01")
    assert [r for r in spans(corrected) if r[0] == "a"] == [
        ("a", "Nice", "2024-02-01", "9999-12-31", "Y"),
        ("a", "Rome", "2024-01-01", "2024-01-31", "N")]
    later = merge(corrected, frame(ATTRIBUTES, ("a", "Rome", "1")), "2024-05-01")
    assert len([r for r in spans(later) if r[0] == "a"]) == 3
    assert history.version_gaps(later, "customer_id").count() == 0
    keys = [r[0] for r in rows_of(later, "customer_sk")]
    assert len(set(keys)) == len(keys) and min(keys) > 0


def test_merge_sees_null_changes(frame):
    versions = start(frame, ("a", None, "1"), ("b", "Oslo", None), ("c", None, None))
    changed = merge(versions, frame(
        ATTRIBUTES, ("a", "", "1"), ("b", None, "Oslo"), ("c", None, None)), "2024-02-01")
    current = changed.filter("effective_date = date '2024-02-01'")
    assert [r[0] for r in rows_of(current, "customer_id")] == ["a", "b"]


def test_merge_takes_one_of_repeated_rows(frame):
    versions = merge(start(frame, ("a", "Rome", "1")), frame(
        ATTRIBUTES, ("a", "Paris", "1"), ("a", "Paris", "1")), "2024-02-01")
    assert versions.count() == 2


def test_gap_is_found(frame):
    versions = frame(
        "customer_id string, effective_date date, expiry_date date",
        ("a", day("2024-01-01"), day("2024-01-30")), ("a", day("2024-02-01"), day("9999-12-31")),
        ("b", day("2024-01-01"), day("2024-01-31")), ("b", day("2024-02-01"), day("9999-12-31")))
    assert rows_of(history.version_gaps(versions, "customer_id"), "customer_id") == [("a",)]


def test_as_of_picks_the_version_of_the_day(frame):
    versions = merge(start(frame, ("a", "Rome", "1")), frame(
        ATTRIBUTES, ("a", "Paris", "1")), "2024-02-01")
    facts = frame("id int, customer_id string, on_day date", (1, "a", day("2024-01-31")),
                  (2, "a", day("2024-02-01")), (3, "a", day("2023-01-01")), (4, None, None))
    joined = history.version_as_of(facts, versions, "customer_id", "on_day", ["city"])
    assert sorted((r.id, r.city) for r in joined.collect()) == [
        (1, "Rome"), (2, "Paris"), (3, None), (4, None)]


def test_upsert_classify_and_append(frame):
    old = frame("id string, v string", ("a", "1"), ("b", "1"), ("d", None))
    new = frame("id string, v string", ("b", "2"), ("c", "1"), ("c", "1"), ("d", None))
    assert rows_of(history.scd1_upsert(old, new.dropDuplicates(), ["id"]).filter("v IS NOT NULL")) \
        == [("a", "1"), ("b", "2"), ("c", "1")]
    classified = history.classify_changes(old, new, "id", ["v"])
    assert rows_of(classified) == [
        ("a", "MISSING", 0), ("b", "CHANGED", 0), ("c", "NEW", 1), ("d", "UNCHANGED", 0)]
    assert rows_of(history.append_unseen(old, new, "id")) == [("c", "1")]


def test_append_reads_touched_partitions_only(frame, spark, tmp_path):
    ddl = "id string, month string"
    path = str(tmp_path / "stored")
    frame(ddl, ("a", "01"), ("b", "02"), ("c", "03")).write.partitionBy("month").parquet(path)
    stored = spark.read.schema(ddl).parquet(path)
    batch = frame(ddl, ("a", "01"), ("x", "01"))
    added = history.append_unseen(stored, batch, "id", "month")
    assert rows_of(added) == [("x", "01")]
    assert "PartitionFilters: [isnotnull(month" in plan_of(added)


def test_append_opens_no_file_of_other_partitions(frame, spark, tmp_path):
    ddl = "id string, month string"
    path = tmp_path / "stored"
    frame(ddl, ("a", "01"), ("b", "02"), ("c", "03")).write.partitionBy("month").parquet(str(path))
    stored = spark.read.schema(ddl).parquet(str(path))
    for month in ("02", "03"):  # reading these would now fail
        shutil.rmtree(path / f"month={month}")
    added = history.append_unseen(stored, frame(ddl, ("a", "01"), ("x", "01")), "id", "month")
    assert rows_of(added) == [("x", "01")]


def test_days_in_any_order_leave_a_valid_history(frame, spark):
    ddl = "id string, city string, name string"
    days = {"2024-03-01": [("a", "Rome", "x"), ("b", "Bonn", "y")],
            "2024-04-01": [("a", "Oslo", "x"), ("c", "Kyiv", "z")],
            "2024-05-01": [("a", "Rome", "x"), ("b", "Graz", "y")]}
    start = frame(ddl, ("a", "Nice", "x"), ("d", "Linz", "w"))
    for order in permutations(days):
        versions = history.open_versions(start, "id", "sk", "2024-03-15")
        for day_ in order:
            versions = history.scd2_merge(versions, frame(ddl, *days[day_]), "id", "sk", ["city"], day_)
        again = history.scd2_merge(versions, frame(ddl, *days[order[-1]]), "id", "sk", ["city"], order[-1])
        rows = sorted(tuple(r) for r in again.select("id", "effective_date", "expiry_date", "city").collect())
        assert rows == sorted(tuple(r) for r in versions.select("id", "effective_date", "expiry_date", "city").collect())
        checks = version_invariants(versions, "t", "id", "sk").collect()
        assert all(r.passed for r in checks), (order, [r.asDict() for r in checks if not r.passed], rows)


def test_quarantine_names_all_reasons(frame):
    df = frame("id int, amount int, account string", (1, 5, "x"), (2, -1, None), (3, None, "x"))
    valid, rejected = history.quarantine(df, {
        "negative": F.col("amount") < 0, "no_account": F.col("account").isNull()})
    assert rows_of(valid, "id") == [(1,), (3,)]
    assert [(r.id, r.reasons) for r in rejected.collect()] == [(2, ["negative", "no_account"])]


def test_dedup_keeps_newest_and_limits_before_the_shuffle(frame):
    df = frame("k string, ts int, v string", ("a", 1, "x"), ("a", 2, "y"), ("a", 2, None),
               ("b", 1, None))
    kept = rows.dedup_latest(df, ["k"], [F.col("ts").desc()])
    assert [r[:2] for r in rows_of(kept.select("k", "ts"))] == [("a", 2), ("b", 1)]
    plan = plan_of(kept)
    assert plan.count("WindowGroupLimit") == 2  # in the map tasks and after the shuffle


def test_loan_of_an_expired_version_counts_for_the_customer(frame):
    versions = merge(start(frame, ("a", "Rome", "1")), frame(
        ATTRIBUTES, ("a", "Paris", "1")), "2024-02-01")
    old = versions.filter("is_current = 'N'").first().customer_sk
    loans = frame("customer_sk bigint, status string, outstanding_amount decimal(15,2), "
                  "principal_amount decimal(15,2)", (old, "ACTIVE", None, None))
    assert rows_of(gold.loan_measures(loans, versions), "customer_id", "active_loans") == [("a", 1)]


def test_symmetric_difference_and_changed_values(frame):
    left = frame("id int, v string", (1, "a"), (2, None), (3, "c"))
    right = frame("id int, v string", (2, None), (3, "d"), (4, "e"))
    assert rows_of(rows.symmetric_difference(left, right, ["id"], ("l", "r"))) == [
        (1, "l"), (4, "r")]
    assert rows_of(rows.changed_values(left, right, ["id"], ["v"])) == [(3, "c", "d")]
