"""Data-quality checks as DataFrames.

Every check returns rows of one schema (`RESULT`). Rules on one table are evaluated in a
single aggregation pass over it; checks between tables aggregate each side and combine
one-row results by scalar subquery. Nothing is asserted or collected here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.functions import columns as C
from terrace.operators.history import version_gaps
from terrace.operators.rows import exact_quantiles
from terrace.schemas import OPEN_END

RESULT = (
    "check_name string, table_name string, column_name string, severity string, "
    "metric double, threshold string, failed_rows bigint, passed boolean"
)


@dataclass(frozen=True)
class Rule:
    """One check on one table: two aggregate expressions and a verdict on the first."""

    name: str
    column: str
    metric: Column
    failed: Column
    threshold: str
    passes: Callable[[Column], Column]
    severity: str = "error"


# --- rule constructors ---------------------------------------------------------------------


def none_broken(name: str, column: str, broken: Column, severity: str = "error") -> Rule:
    count = F.count_if(broken)
    return Rule(name, column, count, count, "= 0", lambda m: m == 0, severity)


def rate_at_most(
    name: str, column: str, broken: Column, limit: float, severity: str = "error"
) -> Rule:
    count = F.count_if(broken)
    return Rule(name, column, C.share(count, F.count("*")), count, f"<= {limit}",
                lambda m: m <= limit, severity)


def metric_between(
    name: str, column: str, metric: Column, low: float, high: float, severity: str = "error"
) -> Rule:
    value = metric.cast("double")
    return Rule(name, column, value,
                F.when(value.between(low, high), 0).otherwise(1), f"{low} to {high}",
                lambda m: F.coalesce(m.between(low, high), F.lit(False)), severity)


def metric_at_least(
    name: str, column: str, metric: Column, low: float, severity: str = "error"
) -> Rule:
    value = metric.cast("double")
    return Rule(name, column, value, F.when(value >= low, 0).otherwise(1), f">= {low}",
                lambda m: F.coalesce(m >= low, F.lit(False)), severity)


def not_null(column: str, blank: bool = False, severity: str = "error") -> Rule:
    broken = C.null_or_blank(column) if blank else F.col(column).isNull()
    return none_broken("not_blank" if blank else "not_null", column, broken, severity)


def in_range(
    column: str, low: float | None = None, high: float | None = None,
    strict_low: bool = False, severity: str = "error",
) -> Rule:
    value = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | ((value <= low) if strict_low else (value < low))
    if high is not None:
        broken = broken | (value > high)
    return none_broken("range", column, broken, severity)


def in_domain(column: str, values: Sequence[str], severity: str = "error") -> Rule:
    return none_broken("domain", column, ~F.col(column).isin(list(values)), severity)


def matches(column: str, pattern: str, severity: str = "error") -> Rule:
    return none_broken("format", column, ~F.col(column).rlike(pattern), severity)


def length_is(column: str, length: int, severity: str = "error") -> Rule:
    return none_broken("length", column, F.length(column) != length, severity)


def holds(name: str, column: str, condition: Column, severity: str = "error") -> Rule:
    """Cross-column condition; a null condition is not a violation."""
    return none_broken(name, column, ~condition, severity)


def implies(
    name: str, column: str, when: Column, then: Column, severity: str = "error"
) -> Rule:
    return none_broken(name, column, when & ~F.coalesce(then, F.lit(False)), severity)


def equals_own(column: str, expected: Column, severity: str = "error") -> Rule:
    """The stored value is what the transformation yields when applied again."""
    return none_broken("transform", column, ~F.col(column).eqNullSafe(expected), severity)


def null_rate(column: str, limit: float, severity: str = "error") -> Rule:
    return rate_at_most("null_rate", column, F.col(column).isNull(), limit, severity)


def not_after(column: str, day: str, severity: str = "error") -> Rule:
    return none_broken("not_after", column, F.col(column) > F.lit(day).cast("date"), severity)


def not_before(column: str, day: str, severity: str = "error") -> Rule:
    return none_broken("not_before", column, F.col(column) < F.lit(day).cast("date"), severity)


def newest_within_days(
    column: str, as_of: str, days: int, severity: str = "error"
) -> Rule:
    age = F.datediff(F.lit(as_of).cast("date"), F.max(column))
    return metric_between("recency_days", column, age, 0, days, severity)


def fresh_within_hours(
    column: str, as_of: datetime, hours: float, severity: str = "error"
) -> Rule:
    newest = F.unix_micros(F.max(F.col(column).cast("timestamp")))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - newest) / F.lit(3_600_000_000.0)
    return metric_between("freshness_hours", column, age, 0, hours, severity)


def load_window_within_minutes(column: str, minutes: float, severity: str = "error") -> Rule:
    moment = F.unix_micros(F.col(column).cast("timestamp"))
    window = (F.max(moment) - F.min(moment)) / F.lit(60_000_000.0)
    return metric_between("load_window_minutes", column, window, 0, minutes, severity)


def row_count_between(low: int, high: int, severity: str = "error") -> Rule:
    return metric_between("row_count", "*", F.count("*"), low, high, severity)


def min_rows(low: int, severity: str = "error") -> Rule:
    return metric_at_least("min_rows", "*", F.count("*"), low, severity)


def profile_bounds(column: str, bounds: Mapping[str, tuple[float, float]]) -> list[Rule]:
    """Bounds on any of min, max, avg, stddev of a numeric column."""
    value = F.col(column).cast("double")
    measures = {"min": F.min(value), "max": F.max(value), "avg": F.avg(value),
                "stddev": F.stddev_samp(value)}
    return [metric_between(f"profile_{m}", column, measures[m], low, high)
            for m, (low, high) in bounds.items()]


# --- evaluation ----------------------------------------------------------------------------


def apply_rules(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one pass over the table."""
    measured = df.agg(
        *(r.metric.cast("double").alias(f"m{i}") for i, r in enumerate(rules)),
        *(r.failed.cast("bigint").alias(f"f{i}") for i, r in enumerate(rules)))
    verdicts = [
        _verdict(r.name, table, r.column, r.severity, F.col(f"m{i}"), r.threshold,
                 F.col(f"f{i}"), r.passes(F.col(f"m{i}")))
        for i, r in enumerate(rules)]
    return measured.select(F.inline(F.array(*verdicts)))


def _verdict(name: str, table: str, column: str, severity: str, metric: Column, threshold: str,
             failed: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
        metric.cast("double").alias("metric"),
        F.lit(threshold).alias("threshold"),
        F.coalesce(failed.cast("bigint"), F.lit(0).cast("bigint")).alias("failed_rows"),
        F.coalesce(passed, F.lit(False)).alias("passed"))


def _result(df: DataFrame, name: str, table: str, column: str, severity: str, metric: Column,
            threshold: str, failed: Column, passed: Column) -> DataFrame:
    """One result row from a one-row frame."""
    return df.select(F.inline(F.array(
        _verdict(name, table, column, severity, metric, threshold, failed, passed))))


def combine(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


# --- keys and relations --------------------------------------------------------------------


def unique(df: DataFrame, table: str, keys: Sequence[str], severity: str = "error") -> DataFrame:
    """Repeated keys and the rows beyond the first of each."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    measured = repeated.agg(F.count("*").alias("keys"), F.sum(F.col("n") - 1).alias("rows"))
    return _result(measured, "unique", table, ",".join(keys), severity, F.col("keys"), "= 0",
                   F.col("rows"), F.col("keys") == 0)


def referential(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, table: str,
    max_rate: float = 0.0, severity: str = "error",
) -> DataFrame:
    """Share of child rows whose non-null key the parent lacks.

    The child is counted per key before the join, so a key carried by a third of all rows
    crosses the shuffle as one row per task.
    """
    per_key = child.filter(F.col(child_key).isNotNull()).groupBy(
        F.col(child_key).alias("k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("k"), F.lit(1).alias("found")).distinct()
    measured = per_key.join(known, "k", "left").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("found").isNull(), F.col("n"))).alias("orphans"))
    rate = C.share(F.coalesce("orphans", F.lit(0)), F.coalesce("total", F.lit(0)))
    return _result(measured, "referential", table, child_key, severity, rate,
                   f"<= {max_rate}", F.col("orphans"), rate <= max_rate)


def key_coverage(
    left: DataFrame, right: DataFrame, key: str, tables: tuple[str, str],
    severity: str = "error",
) -> DataFrame:
    """Keys missing on either side, one result row per direction, from one full join."""
    a = left.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("l", F.lit(1))
    b = right.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("r", F.lit(1))
    measured = a.join(b, key, "full_outer").agg(
        F.count_if(F.col("r").isNull()).alias("missing_right"),
        F.count_if(F.col("l").isNull()).alias("missing_left"))
    rows = [
        _verdict("key_coverage", tables[1], key, severity, F.col("missing_right"), "= 0",
                 F.col("missing_right"), F.col("missing_right") == 0),
        _verdict("key_coverage", tables[0], key, severity, F.col("missing_left"), "= 0",
                 F.col("missing_left"), F.col("missing_left") == 0)]
    return measured.select(F.inline(F.array(*rows)))


def expected_present(
    df: DataFrame, table: str, value: Column, label: str, expected: Sequence[str],
    severity: str = "error",
) -> DataFrame:
    """Every expected value occurs at least once."""
    counts = [F.count_if(value == v) for v in expected]
    absent = reduce(lambda a, b: a + b, [F.when(c == 0, 1).otherwise(0) for c in counts])
    return _result(df.agg(absent.alias("absent")), "expected_present", table, label, severity,
                   F.col("absent"), "= 0", F.col("absent"), F.col("absent") == 0)


# --- reconciliation ------------------------------------------------------------------------


def equal_measure(
    left: DataFrame, right: DataFrame, left_measure: Column, right_measure: Column,
    name: str, table: str, column: str, tolerance: float = 0.0, relative: bool = False,
    severity: str = "error",
) -> DataFrame:
    """|left - right|, absolute or relative to the left side, within a tolerance."""
    # A sum over no rows is null: nothing on either side is equal, nothing on one side is not.
    a = F.coalesce(left_measure.cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)"))
    b = F.coalesce(right_measure.cast("decimal(38,4)"), F.lit(0).cast("decimal(38,4)"))
    both = left.agg(a.alias("l")).withColumn("r", right.agg(b.alias("r")).scalar())
    gap = F.abs(F.col("l") - F.col("r")).cast("double")
    if relative:
        base = F.abs(F.col("l")).cast("double")
        gap = F.when(gap == 0, 0.0).otherwise(F.coalesce(F.try_divide(gap, base), F.lit(1.0)))
    return _result(both, name, table, column, severity, gap,
                   f"<= {tolerance}{' of left' if relative else ''}",
                   F.when(gap <= tolerance, 0).otherwise(1), gap <= tolerance)


def row_count_match(
    left: DataFrame, right: DataFrame, tables: tuple[str, str], left_keys: Sequence[str] = (),
    severity: str = "error",
) -> DataFrame:
    """Equal row counts; with `left_keys`, the left side counts distinct keys."""
    counted = F.count_distinct(*left_keys) if left_keys else F.count("*")
    return equal_measure(left, right, counted, F.count("*"),
                         "distinct_count_match" if left_keys else "row_count_match",
                         f"{tables[0]}/{tables[1]}", ",".join(left_keys) or "*",
                         severity=severity)


def volume_ratio(
    many: DataFrame, few: DataFrame, tables: tuple[str, str], low: float, high: float,
    severity: str = "error",
) -> DataFrame:
    both = many.agg(F.count("*").alias("l")).withColumn(
        "r", few.agg(F.count("*").alias("r")).scalar())
    ratio = F.try_divide(F.col("l").cast("double"), F.col("r").cast("double"))
    fine = F.coalesce(ratio.between(low, high), F.lit(False))
    return _result(both, "volume_ratio", f"{tables[0]}/{tables[1]}", "*", severity, ratio,
                   f"{low} to {high}", F.when(fine, 0).otherwise(1), fine)


# --- calendar, distribution, outliers ------------------------------------------------------


def calendar_complete(
    calendar: DataFrame, day: str, facts: DataFrame, fact_day: str, table: str,
    severity: str = "error",
) -> DataFrame:
    """No missing day between first and last, and every fact date is in the calendar."""
    spread = calendar.agg(
        (F.datediff(F.max(day), F.min(day)) + 1 - F.count_distinct(day)).alias("gaps"))
    uncovered = (
        facts.select(F.col(fact_day).alias("d")).filter("d IS NOT NULL").distinct()
        .join(calendar.select(F.col(day).alias("d")).distinct(), "d", "left_anti")
        .agg(F.count("*").alias("uncovered")))
    gaps = _result(spread, "date_gaps", table, day, severity, F.col("gaps"), "= 0",
                   F.col("gaps"), F.col("gaps") == 0)
    covered = _result(uncovered, "date_coverage", table, day, severity, F.col("uncovered"),
                      "= 0", F.col("uncovered"), F.col("uncovered") == 0)
    return gaps.unionByName(covered)


def share_bounds(
    df: DataFrame, table: str, column: str, bounds: Mapping[str, tuple[float, float]],
    severity: str = "warn",
) -> DataFrame:
    """Share of each named category lies in its bounds."""
    return apply_rules(df, table, share_rules(column, bounds, severity))


def share_rules(column: str, bounds: Mapping[str, tuple[float, float]], severity: str = "warn") -> list[Rule]:
    return [
        metric_between(f"share_{value}", column,
                       C.share(F.count_if(F.col(column) == value), F.count("*")),
                       low, high, severity)
        for value, (low, high) in bounds.items()]


def min_distinct(
    df: DataFrame, table: str, column: str, low: int, severity: str = "error"
) -> DataFrame:
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    measured = values.agg(F.count("*").alias("n"))
    return _result(measured, "min_distinct", table, column, severity, F.col("n"), f">= {low}",
                   F.when(F.col("n") >= low, 0).otherwise(1), F.col("n") >= low)


def empty_groups(
    mart: DataFrame, table: str, count_column: str, severity: str = "error"
) -> DataFrame:
    return apply_rules(mart, table, [none_broken(
        "empty_group", count_column, F.col(count_column) == 0, severity)])


def iqr_outliers(
    df: DataFrame, table: str, column: str, max_share: float, factor: float = 1.5,
    severity: str = "warn",
) -> DataFrame:
    """Share of values beyond factor * IQR outside the exact quartiles."""
    quartiles = exact_quantiles(df, [], column, [0.25, 0.75]).select(F.array("q0", "q1")).scalar()
    value, q1, q3 = F.col(column).cast("double"), F.col("_q")[0], F.col("_q")[1]
    reach = F.lit(factor) * (q3.cast("double") - q1.cast("double"))
    outside = (value < q1.cast("double") - reach) | (value > q3.cast("double") + reach)
    return apply_rules(df.select(column).withColumn("_q", quartiles), table,
                       [rate_at_most("iqr_outliers", column, outside, max_share, severity)])


# --- schema --------------------------------------------------------------------------------


def schema_types(df: DataFrame, table: str, expected: StructType) -> DataFrame:
    """Per expected column: rows held in a column of another type (or lacking the column)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rules = []
    for f in expected.fields:
        wanted = f.dataType.simpleString()
        bad = F.lit(actual.get(f.name) != wanted)
        rules.append(Rule("schema_type", f.name, F.when(bad, 1).otherwise(0) * F.lit(1.0),
                          F.when(bad, F.count("*")).otherwise(0), wanted, lambda m: m == 0))
    return apply_rules(df, table, rules)


def schema_drift(df: DataFrame, table: str, expected: Sequence[str]) -> DataFrame:
    """One row for missing and one for unexpected columns, with the rows concerned."""
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in set(expected)]
    rules = [
        Rule(name, ",".join(found) or "*", F.lit(float(len(found))),
             F.count("*") if found else F.lit(0), "= 0", lambda m: m == 0, severity)
        for name, found, severity in (
            ("missing_columns", missing, "error"), ("unexpected_columns", extra, "warn"))]
    # The count keeps a scan in the plan even when nothing drifted.
    return apply_rules(df, table, [*rules, metric_at_least(
        "rows_seen", "*", F.count("*"), 0, "info")])


# --- audit, history, lineage ---------------------------------------------------------------


def audit(df: DataFrame, table: str, max_minutes: float = 5.0) -> DataFrame:
    """Audit columns filled, one load id, and a short load window."""
    columns = ["_ingestion_ts", "_source_file", "_batch_id"]
    batches = metric_between("single_batch", "_batch_id", F.count_distinct("_batch_id"), 1, 1)
    return apply_rules(df, table, [
        *(not_null(c) for c in columns), batches,
        load_window_within_minutes("_ingestion_ts", max_minutes)])


def version_invariants(versions: DataFrame, table: str, key: str, sk: str) -> DataFrame:
    """Row rules in one pass, key rules in one grouping, plus unique keys and date gaps."""
    open_end = F.lit(OPEN_END).cast("date")
    current = F.col("is_current") == "Y"
    rows = apply_rules(versions, table, [
        none_broken("open_end_iff_current", "expiry_date",
                    current != (F.col("expiry_date") == open_end)),
        none_broken("effective_before_expiry", "effective_date",
                    F.col("effective_date") > F.col("expiry_date")),
        none_broken("positive_key", sk, F.col(sk).isNull() | (F.col(sk) <= 0)),
    ])
    per_key = versions.groupBy(key).agg(
        F.count_if(current).alias("open"), F.count("*").alias("n"))
    keys = apply_rules(per_key, table, [
        none_broken("has_current", key, F.col("open") == 0),
        none_broken("only_one_current", key, F.col("open") > 1),
    ])
    gaps = version_gaps(versions, key).agg(F.count("*").alias("n"))
    no_gaps = _result(gaps, "contiguous", table, "effective_date", "error", F.col("n"), "= 0",
                      F.col("n"), F.col("n") == 0)
    return combine([rows, keys, no_gaps, unique(versions, table, [sk])])


def lineage_trace(hops: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Presence of every key of the first table in each later one: (key, in_<name>..., complete)."""
    (_, first), *later = hops
    trace = first.select(key).distinct()
    for name, df in later:
        found = df.select(key).distinct().withColumn(f"in_{name}", F.lit(True))
        trace = trace.join(found, key, "left")
    flags = {f"in_{name}": F.coalesce(f"in_{name}", F.lit(False)) for name, _ in later}
    complete = reduce(lambda a, b: a & b, flags.values())
    return trace.select(key, *(c.alias(n) for n, c in flags.items()), complete.alias("complete"))


# --- suite ---------------------------------------------------------------------------------


@dataclass
class Suite:
    """Named checks with tags; `run` evaluates those that carry all requested tags."""

    spark: SparkSession
    checks: list[tuple[frozenset[str], Callable[[], DataFrame]]] = field(default_factory=list)

    def add(self, tags: Iterable[str], check: Callable[[], DataFrame]) -> Suite:
        self.checks.append((frozenset(tags), check))
        return self

    def run(self, *tags: str) -> DataFrame:
        chosen = [check() for have, check in self.checks if set(tags) <= have]
        return combine(chosen) if chosen else self.spark.createDataFrame([], RESULT)
