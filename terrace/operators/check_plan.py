"""Checks planned together: one pass over each input for its numbers, and one grouping for all keys.

Checks are asked for first and run at the end. Everything that aggregates an input - row rules,
counts, sums - goes into one aggregation of it. Keys that are compared with each other form a
domain. One grouping by domain and key, over one reading of each input, counts the rows of every
input, which then tells repeated keys, orphans, missing keys and distinct counts at once. Keys are
combined in the map tasks, so a key with a third of all rows crosses the shuffle as one row per task.

An input that both passes read is stored once, as it was given: give inputs with the columns
that their checks need. All measures, a few numbers each, meet in one row, from which the verdicts are
taken.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.operators.quality import Rule, _verdict
from terrace.session import cut_lineage

EXACT = "decimal(38,4)"


@dataclass
class _Key:
    """The keys of an input that take part in a domain."""

    source: str
    columns: tuple[str, ...]


@dataclass
class CheckPlan:
    """Collects checks over named inputs; `run` returns their results."""

    inputs: dict[str, DataFrame] = field(default_factory=dict)
    weights: dict[str, str] = field(default_factory=dict)
    _scalars: dict[str, dict[str, Column]] = field(default_factory=dict)
    _keys: list[_Key] = field(default_factory=list)
    _domain: list[int] = field(default_factory=list)
    _measures: list[tuple[int, str, Callable[[Callable[[int], Column]], Column]]] = field(default_factory=list)
    _verdicts: list[Callable[[Callable[[str], Column]], Column]] = field(default_factory=list)

    def input(self, name: str, df: DataFrame, weight: str | None = None) -> CheckPlan:
        """An input; with `weight`, a row stands for as many rows where keys are counted."""
        if weight:
            self.weights[name] = weight
        if self.inputs.setdefault(name, df) is not df:
            raise ValueError(f"another input is called {name}")
        return self

    # --- one aggregation of each input ---

    def _scalar(self, source: str, value: Column) -> str:
        held = self._scalars.setdefault(source, {})
        name = f"{list(self.inputs).index(source)}s{len(held)}"
        held[name] = value
        return name

    def rules(self, source: str, rules: Sequence[Rule], table: str | None = None) -> CheckPlan:
        for rule in rules:
            m, f = self._scalar(source, rule.metric), self._scalar(source, rule.failed)
            self._verdicts.append(lambda of, r=rule, m=m, f=f: _verdict(
                r.name, table or source, r.column, r.severity, of(m), r.threshold, of(f), r.passes(of(m))))
        return self

    def equal(self, left: tuple[str, Column], right: tuple[str, Column], name: str, table: str, column: str,
              tolerance: float = 0.0, relative: bool = False, severity: str = "error") -> CheckPlan:
        """|left - right|, absolute or relative to the left side, within a tolerance."""
        return self._equal(self._scalar(*left), self._scalar(*right), name, table, column, tolerance, relative, severity)

    def _equal(self, a: str, b: str, name: str, table: str, column: str, tolerance: float, relative: bool,
               severity: str) -> CheckPlan:
        def verdict(of) -> Column:
            l, r = (F.coalesce(of(x, True), F.lit(0).cast(EXACT)) for x in (a, b))
            gap = F.abs(l - r).cast("double")
            if relative:
                gap = F.when(gap == 0, 0.0).otherwise(F.coalesce(F.try_divide(gap, F.abs(l).cast("double")), F.lit(1.0)))
            return _verdict(name, table, column, severity, gap, f"<= {tolerance}{' of left' if relative else ''}",
                            F.when(gap <= tolerance, 0).otherwise(1), gap <= tolerance)
        self._verdicts.append(verdict)
        return self

    def same_rows(self, left: str, right: str, distinct: Sequence[str] = (), severity: str = "error") -> CheckPlan:
        """Equal row counts; with `distinct`, the left side counts distinct keys."""
        if distinct:
            a = self._measure(self._key(left, distinct), lambda n: F.count_if(n(0) > 0))
        else:
            a = self._scalar(left, F.count("*"))
        name = "distinct_count_match" if distinct else "row_count_match"
        return self._equal(a, self._scalar(right, F.count("*")), name, f"{left}/{right}", ",".join(distinct) or "*",
                           0.0, False, severity)

    # --- one grouping of each domain of keys ---

    def _key(self, source: str, columns: Sequence[str]) -> int:
        wanted = _Key(source, tuple(columns))
        if wanted not in self._keys:
            self._keys.append(wanted)
            self._domain.append(len(self._keys) - 1)
        return self._keys.index(wanted)

    def _relate(self, a: int, b: int) -> None:
        old, new = self._domain[b], self._domain[a]
        self._domain = [new if d == old else d for d in self._domain]

    def _measure(self, *parts) -> str:
        """A measure over a domain's keys; its function is given the row counts of the named participants."""
        *keys, build = parts
        name = f"k{len(self._measures)}"
        self._measures.append((keys[0], name, lambda count: build(lambda i: count(keys[i]))))
        return name

    def unique(self, source: str, columns: Sequence[str], severity: str = "error", table: str | None = None) -> CheckPlan:
        """Repeated keys and the rows beyond the first of each."""
        key = self._key(source, columns)
        keys = self._measure(key, lambda n: F.count_if(n(0) > 1))
        rows = self._measure(key, lambda n: F.sum(F.when(n(0) > 1, n(0) - 1)))
        self._verdicts.append(lambda of: _verdict(
            "unique", table or source, ",".join(columns), severity, of(keys), "= 0", of(rows), of(keys) == 0))
        return self

    def referential(self, child: str, child_key: str, parent: str, parent_key: str, max_rate: float = 0.0,
                    severity: str = "error", table: str | None = None) -> CheckPlan:
        """Share of child rows whose non-null key the parent lacks."""
        a, b = self._key(child, [child_key]), self._key(parent, [parent_key])
        self._relate(a, b)
        total = self._measure(a, b, lambda n: F.sum(F.when(F.col("k").isNotNull(), n(0))))
        orphans = self._measure(a, b, lambda n: F.sum(F.when(F.col("k").isNotNull() & (n(1) == 0), n(0))))

        def verdict(of) -> Column:
            rate = C.share(F.coalesce(of(orphans), F.lit(0.0)), F.coalesce(of(total), F.lit(0.0)))
            return _verdict("referential", table or child, child_key, severity, rate, f"<= {max_rate}",
                            of(orphans), rate <= max_rate)
        self._verdicts.append(verdict)
        return self

    def covered(self, rows: str, column: str, by: str, by_column: str, name: str, table: str,
                severity: str = "error") -> CheckPlan:
        """Distinct non-null values of one input that another lacks."""
        a, b = self._key(rows, [column]), self._key(by, [by_column])
        self._relate(a, b)
        missing = self._measure(a, b, lambda n: F.count_if(F.col("k").isNotNull() & (n(0) > 0) & (n(1) == 0)))
        self._verdicts.append(lambda of: _verdict(
            name, table, by_column, severity, of(missing), "= 0", of(missing), of(missing) == 0))
        return self

    def no_gaps(self, calendar: str, day: str, severity: str = "error") -> CheckPlan:
        """No day is missing between the first and the last one."""
        span = self._scalar(calendar, F.datediff(F.max(day), F.min(day)) + 1)
        days = self._measure(self._key(calendar, [day]), lambda n: F.count_if(F.col("k").isNotNull() & (n(0) > 0)))
        self._verdicts.append(lambda of: _verdict(
            "date_gaps", calendar, day, severity, of(span) - of(days), "= 0", of(span) - of(days), of(span) == of(days)))
        return self

    def min_distinct(self, source: str, column: str, low: int, severity: str = "error") -> CheckPlan:
        n = self._measure(self._key(source, [column]), lambda n: F.count_if(F.col("k").isNotNull() & (n(0) > 0)))
        self._verdicts.append(lambda of: _verdict(
            "min_distinct", source, column, severity, of(n), f">= {low}", F.when(of(n) >= low, 0).otherwise(1), of(n) >= low))
        return self

    # --- the plan ---

    def passes(self) -> dict[str, int]:
        """How many passes read each input."""
        read = {name: int(name in self._scalars) for name in self.inputs}
        for source in {key.source for key in self._keys}:
            read[source] += 1
        return read

    def _numbers(self, measured: DataFrame, names: Sequence[str]) -> DataFrame:
        """(name, value, exact) rows of a one-row frame."""
        rows = [F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"),
                         F.col(n).try_cast(EXACT).alias("exact")) for n in names]
        return measured.select(F.inline(F.array(*rows)))

    def run(self) -> DataFrame:
        stored = {name: cut_lineage(df) if self.passes()[name] > 1 else df for name, df in self.inputs.items()}
        parts = []
        for source, scalars in self._scalars.items():
            parts.append(self._numbers(stored[source].agg(*(v.alias(n) for n, v in scalars.items())), list(scalars)))
        if self._keys:
            parts.append(self._numbers(self._counted(stored), [name for _, name, _ in self._measures]))
        numbers = reduce(DataFrame.unionByName, parts)
        names = [n for scalars in self._scalars.values() for n in scalars] + [n for _, n, _ in self._measures]
        pick = lambda n, c: F.max(F.when(F.col("name") == n, F.col(c)))
        row = numbers.agg(*(x for n in names for x in (pick(n, "value").alias(n), pick(n, "exact").alias(f"{n}e"))))

        def of(name: str, exact: bool = False) -> Column:
            return F.col(f"{name}e" if exact else name)
        return row.select(F.inline(F.array(*(verdict(of) for verdict in self._verdicts))))

    def _counted(self, stored: dict[str, DataFrame]) -> DataFrame:
        """All measures over keys, as one row. Keys are compared as text."""
        sides = []
        for source in dict.fromkeys(key.source for key in self._keys):
            tagged = [F.struct(F.lit(self._domain[i]).alias("domain"), F.lit(i).alias("side"), _text(key.columns).alias("k"))
                      for i, key in enumerate(self._keys) if key.source == source]
            weight = F.col(self.weights[source]) if source in self.weights else F.lit(1)
            sides.append(stored[source].select(weight.cast("long").alias("w"), F.inline(F.array(*tagged))))
        per_key = reduce(DataFrame.unionByName, sides).groupBy("domain", "k").agg(
            *(F.sum(F.when(F.col("side") == i, F.col("w")).otherwise(0)).alias(f"n{i}") for i in range(len(self._keys))))
        # An input's count is 0 in the groups of other domains, so no measure needs to ask for its domain.
        return per_key.agg(*(build(lambda i: F.col(f"n{i}")).alias(name) for _, name, build in self._measures))


def _text(columns: Sequence[str]) -> Column:
    return F.col(columns[0]).cast("string") if len(columns) == 1 else F.to_json(F.struct(*columns))
