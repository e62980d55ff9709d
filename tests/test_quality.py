"""Every check has a frame it passes and a frame it fails."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators import quality as Q
from terrace.schemas import PAN_PATTERN, PHONE_PATTERN
from tests.conftest import day

NOW = datetime(2024, 1, 2)


def verdicts(df):
    return [(r.check_name, r.passed, r.failed_rows) for r in df.collect()]


RULES = {
    "not_null": ("v string", "x", None, lambda: Q.not_null("v")),
    "not_blank": ("v string", "x", "  ", lambda: Q.not_null("v", blank=True)),
    "range": ("v int", 50, 51, lambda: Q.in_range("v", 0, 50)),
    "strict_range": ("v int", 1, 0, lambda: Q.in_range("v", 0, strict_low=True)),
    "domain": ("v string", "a", "b", lambda: Q.in_domain("v", ["a"])),
    "phone": ("v string", "+919876543210", "+915876543210", lambda: Q.matches("v", PHONE_PATTERN)),
    "pan": ("v string", "ABCDE1234F", "abcde1234f", lambda: Q.matches("v", PAN_PATTERN)),
    "length": ("v string", "123456", "12345", lambda: Q.length_is("v", 6)),
    "holds": ("v int", 1, 3, lambda: Q.holds("small", "v", F.col("v") < 2)),
    "implies": ("v int", 1, 3, lambda: Q.implies("few", "v", F.col("v") > 0, F.col("v") < 2)),
    "implies_null": ("v string", "x", None, lambda: Q.implies(
        "known", "v", F.lit(True), F.col("v") == "x")),
    "transform": ("v string", "a", "A", lambda: Q.equals_own("v", F.lower("v"))),
    "null_rate": ("v int", 1, None, lambda: Q.null_rate("v", 0.5)),
    "not_after": ("v date", day("2024-01-01"), day("2025-01-01"),
                  lambda: Q.not_after("v", "2024-06-01")),
    "not_before": ("v date", day("2024-01-01"), day("2007-12-31"),
                   lambda: Q.not_before("v", "2008-01-01")),
    "recency": ("v date", day("2024-01-01"), day("2023-01-01"),
                lambda: Q.newest_within_days("v", "2024-01-02", 30)),
    "recency_future": ("v date", day("2024-01-01"), day("2025-01-01"),
                       lambda: Q.newest_within_days("v", "2024-01-02", 30)),
    "freshness": ("v timestamp", datetime(2024, 1, 1, 12), datetime(2023, 12, 31),
                  lambda: Q.fresh_within_hours("v", NOW, 24)),
    "min_rows": ("v int", 1, None, lambda: Q.metric_at_least("known", "v", F.count("v"), 1)),
    "profile": ("v int", 5, 500, lambda: Q.profile_bounds("v", {"max": (0, 10)})[0]),
    "empty": ("v int", 5, 0, lambda: Q.none_broken("empty_group", "v", F.col("v") == 0)),
}


@pytest.mark.parametrize("name", RULES)
def test_rule_passes_and_fails(frame, name):
    ddl, good, bad, rule = RULES[name]
    (good_result,) = verdicts(Q.apply_rules(frame(ddl, (good,)), "t", [rule()]))
    (bad_result,) = verdicts(Q.apply_rules(frame(ddl, (bad,)), "t", [rule()]))
    assert good_result[1] is True and good_result[2] == 0
    assert bad_result[1] is False and bad_result[2] >= 1


def test_result_schema_and_empty_table(frame, spark):
    empty = frame("v int")
    result = Q.apply_rules(empty, "t", [Q.not_null("v"), Q.min_rows(1), Q.null_rate("v", 0.1),
                                        *Q.profile_bounds("v", {"avg": (0, 1)})])
    assert [(f.name, f.dataType) for f in result.schema] == [
        (f.name, f.dataType) for f in spark.createDataFrame([], Q.RESULT).schema]
    assert [p for _, p, _ in verdicts(result)] == [True, False, True, False]


def test_unique_and_composite(frame):
    df = frame("a int, b int", (1, 1), (1, 2), (1, 2), (2, 1))
    assert verdicts(Q.unique(df, "t", ["a"])) == [("unique", False, 2)]
    assert verdicts(Q.unique(df, "t", ["a", "b"])) == [("unique", False, 1)]
    assert verdicts(Q.unique(df.distinct(), "t", ["a", "b"])) == [("unique", True, 0)]


def test_referential_and_coverage(frame):
    child = frame("k int", (1,), (1,), (2,), (9,), (None,))
    parent = frame("id int", (1,), (2,), (3,))
    assert verdicts(Q.referential(child, parent, "k", "id", "t")) == [("referential", False, 1)]
    assert verdicts(Q.referential(child, parent, "k", "id", "t", 0.25)) == [
        ("referential", True, 1)]
    assert verdicts(Q.referential(parent, parent, "id", "id", "t")) == [("referential", True, 0)]
    pair = Q.key_coverage(child, parent.withColumnRenamed("id", "k"), "k", ("l", "r"))
    assert [(r.table_name, r.passed, r.failed_rows) for r in pair.collect()] == [
        ("r", False, 1), ("l", False, 1)]
    same = Q.key_coverage(parent, parent, "id", ("l", "r"))
    assert all(r.passed for r in same.collect())


def test_counts_sums_and_ratios(frame):
    a, b = frame("v int", (1,), (2,)), frame("v int", (1,), (2,), (2,))
    assert verdicts(Q.row_count_match(a, b, ("a", "b")))[0][1] is False
    assert verdicts(Q.row_count_match(b, a, ("b", "a"), ["v"]))[0][1] is True
    total = F.sum("v")
    assert verdicts(Q.equal_measure(a, b, total, total, "s", "t", "v", 2.0))[0][1] is True
    assert verdicts(Q.equal_measure(a, b, total, total, "s", "t", "v", 1.9))[0][1] is False
    assert verdicts(Q.equal_measure(a, b, total, total, "s", "t", "v", 0.7, True))[0][1] is True
    assert verdicts(Q.equal_measure(a, b, total, total, "s", "t", "v", 0.6, True))[0][1] is False
    nothing = frame("v int")
    assert verdicts(Q.equal_measure(nothing, a, total, total, "s", "t", "v", 0.6, True))[0][1] is False
    assert verdicts(Q.volume_ratio(b, a, ("b", "a"), 1, 2))[0][1] is True
    assert verdicts(Q.volume_ratio(b, a, ("b", "a"), 2, 3))[0][1] is False
    assert verdicts(Q.volume_ratio(b, nothing, ("b", "n"), 0, 3))[0][1] is False


def test_calendar(frame):
    whole = frame("d date", (day("2024-01-01"),), (day("2024-01-02"),), (day("2024-01-03"),))
    holed = whole.filter("d <> date '2024-01-02'")
    assert [p for _, p, _ in verdicts(Q.calendar_complete(whole, "d", holed, "d", "t"))] == [
        True, True]
    assert [p for _, p, _ in verdicts(Q.calendar_complete(holed, "d", whole, "d", "t"))] == [
        False, False]


def test_distribution_and_outliers(frame):
    df = frame("g string, v double", *[("a", float(i)) for i in range(20)], ("b", 1000.0))
    assert verdicts(Q.share_bounds(df, "t", "g", {"a": (0.9, 1.0), "b": (0.5, 1.0)})) == [
        ("share_a", True, 0), ("share_b", False, 1)]
    assert verdicts(Q.min_distinct(df, "t", "g", 2))[0][1] is True
    assert verdicts(Q.min_distinct(df, "t", "g", 3))[0][1] is False
    assert verdicts(Q.iqr_outliers(df, "t", "v", 0.05)) == [("iqr_outliers", True, 1)]
    assert verdicts(Q.iqr_outliers(df, "t", "v", 0.01)) == [("iqr_outliers", False, 1)]
    domain = F.substring_index("g", "@", -1)
    assert verdicts(Q.expected_present(df, "t", domain, "g", ["a", "b"]))[0][1] is True
    assert verdicts(Q.expected_present(df, "t", domain, "g", ["a", "z"])) == [
        ("expected_present", False, 1)]
    assert verdicts(Q.empty_groups(frame("n int", (0,), (1,)), "t", "n"))[0][1] is False


def test_schema_checks(frame):
    df = frame("a int, b string", (1, "x"), (2, "y"))
    good = Q.schema_types(df, "t", df.schema)
    assert all(r.passed for r in good.collect())
    other = frame("a string, c string").schema
    assert [p for _, p, _ in verdicts(Q.schema_types(df, "t", other))] == [False, False]
    drift = Q.schema_drift(df, "t", ["a", "c"]).collect()
    assert [(r.column_name, r.passed, r.failed_rows) for r in drift[:2]] == [
        ("c", False, 2), ("b", False, 2)]
    assert all(r.passed for r in Q.schema_drift(df, "t", ["a", "b"]).collect())


def test_audit(frame):
    ddl = "_ingestion_ts timestamp, _source_file string, _batch_id string"
    good = frame(ddl, (NOW, "f", "b1"), (datetime(2024, 1, 2, 0, 4), "f", "b1"))
    assert all(p for _, p, _ in verdicts(Q.audit(good, "t")))
    bad = frame(ddl, (NOW, None, "b1"), (datetime(2024, 1, 2, 0, 6), "f", "b2"))
    assert [p for _, p, _ in verdicts(Q.audit(bad, "t"))] == [True, False, True, False, False]


VERSIONS = "k string, sk bigint, effective_date date, expiry_date date, is_current string"
FIRST, LAST, END = day("2024-01-01"), day("2024-01-31"), day("9999-12-31")


@pytest.mark.parametrize("rows, broken", [
    ([("a", 1, FIRST, LAST, "N"), ("a", 2, day("2024-02-01"), END, "Y")], set()),
    ([("a", 1, FIRST, END, "N")], {"open_end_iff_current", "has_current"}),
    ([("a", 1, FIRST, LAST, "Y")], {"open_end_iff_current"}),
    ([("a", 1, FIRST, END, "Y"), ("a", 2, LAST, END, "Y")], {"only_one_current", "contiguous"}),
    ([("a", 1, FIRST, LAST, "N"), ("a", 2, day("2024-02-02"), END, "Y")], {"contiguous"}),
    ([("a", -1, FIRST, END, "Y")], {"positive_key"}),
    ([("a", 1, FIRST, END, "Y"), ("b", 1, FIRST, END, "Y")], {"unique"}),
    ([("a", 1, LAST, FIRST, "N"), ("a", 2, day("2024-02-01"), END, "Y")],
     {"effective_before_expiry", "contiguous"}),
])
def test_version_invariants(frame, rows, broken):
    result = Q.version_invariants(frame(VERSIONS, *rows), "t", "k", "sk").collect()
    assert len(result) == 7
    assert {r.check_name for r in result if not r.passed} == broken


def test_lineage_and_suite(frame, spark):
    source, middle, last = (frame("k int", *[(i,) for i in range(n)]) for n in (3, 2, 1))
    trace = Q.lineage_trace([("s", source), ("m", middle), ("l", last)], "k")
    assert sorted(tuple(r) for r in trace.collect()) == [
        (0, True, True, True), (1, True, False, False), (2, False, False, False)]
    suite = Q.Suite(spark)
    suite.add({"a", "x"}, lambda: Q.unique(source, "s", ["k"]))
    suite.add({"a", "y"}, lambda: Q.unique(middle, "m", ["k"]))
    assert [r.table_name for r in suite.run("a").collect()] == ["s", "m"]
    assert [r.table_name for r in suite.run("a", "y").collect()] == ["m"]
    assert suite.run("z").count() == 0


def test_rules_of_one_table_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id AS a", "id AS b", "id AS unused").write.parquet(path)
    df = spark.read.parquet(path)
    checked = Q.apply_rules(df, "t", [Q.not_null("a"), Q.in_range("b", 0), Q.null_rate("a", 0.1)])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "unused" not in plan


@pytest.mark.parametrize("text, value", [
    ("2024-02-29", day("2024-02-29")), (" 2024-01-05 ", day("2024-01-05")), ("2023-02-29", None),
    ("31-12-2025", None), ("2024-1-05", None), ("12024-1-01", None), ("", None), (None, None),
    ("2024-01-05T00", None), ("2024/01/05", None)])
def test_tolerant_date(frame, text, value):
    df = frame("d string", (text,))
    assert df.select(C.tolerant_date("d")).first()[0] == value
    if text is not None:
        assert df.select(C.tolerant_date("d", "dd-MM-yyyy")).first()[0] == (
            day("2025-12-31") if text == "31-12-2025" else None)


def test_fiscal_calendar_and_cast(frame):
    df = frame("d date", (day("2024-01-15"),), (day("2024-04-01"),), (day("2024-12-31"),))
    got = df.select(C.fiscal_year(F.col("d")), C.fiscal_quarter(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(2023, 4), (2024, 1), (2024, 3)]
    df = frame("v string", ("12.345",), ("n/a",), (" 7 ",), ("",))
    typed = [r[0] for r in df.select(C.tolerant_cast("v", "decimal(15,2)")).collect()]
    assert [None if v is None else float(v) for v in typed] == [12.35, None, 7.0, None]


def test_tracked_hash_marks_nulls(frame):
    df = frame("a string, b string", ("x", None), (None, "x"), ("x", ""), ("n", None), (None, "n"))
    assert df.select(C.tracked_hash(["a", "b"])).distinct().count() == 5
