"""Marts and raw tables from mappings that are data: what each column comes from, and by which path.

A mart starts from a base: rows of a table that are kept as they are, or grouped. Sides are joined to
it, each either looked up by a key or added up by it. A side whose rows don't hold the key themselves reaches
it over hops, from one table's key to the next; its measures are then added up on its own foreign key
first, and again after each hop, so that joins see one row per key. Conditions and derived columns are
SQL expressions; measures name one of the functions that add up in parts.

    Side("fact_transaction", "customer_id", [Hop("account_sk", "dim_account", "customer_id")],
         [Measure("total_credit_amount", "sum", "amount", "transaction_type = 'CREDIT'")])
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.schemas import BRONZE_COLUMNS, table_schema

#: Sums are added and divided as decimals, so that exact halves round up.
SUM = "decimal(25,2)"


@dataclass(frozen=True)
class Measure:
    """A column that adds up: `count`, `count_distinct`, `sum`, `avg`, `min` or `max` of an expression."""

    target: str
    function: str
    expression: str = "1"
    where: str | None = None

    def _value(self) -> Column:
        value = F.expr(self.expression)
        return value if self.where is None else F.when(F.expr(self.where), value)

    def parts(self) -> dict[str, Column]:
        """What is kept of a group of rows."""
        value = self._value()
        if self.function == "count":
            return {self.target: F.count(value)}
        if self.function == "avg":
            return {f"{self.target}_sum": F.sum(value).cast(SUM), f"{self.target}_n": F.count(value)}
        if self.function == "sum" and self.where is not None:
            value = F.when(F.expr(self.where), F.expr(self.expression)).otherwise(F.lit(0))
        return {self.target: {"sum": F.sum, "min": F.min, "max": F.max}[self.function](value)}

    def together(self) -> dict[str, Column]:
        """What is kept of groups of parts."""
        add = {"min": F.min, "max": F.max}.get(self.function, F.sum)
        return {name: add(name) for name in self.names()}

    def names(self) -> list[str]:
        return [f"{self.target}_sum", f"{self.target}_n"] if self.function == "avg" else [self.target]

    def result(self) -> Column:
        if self.function == "avg":
            return F.try_divide(F.col(f"{self.target}_sum").cast(SUM), F.col(f"{self.target}_n")).alias(self.target)
        return F.col(self.target)


@dataclass(frozen=True)
class Hop:
    """From a key, through the table that knows it, to another column of that table."""

    key: str
    table: str
    column: str


@dataclass(frozen=True)
class Side:
    """A table's contribution: columns looked up by `key`, or measures added up by it over `hops`."""

    table: str
    key: str
    hops: Sequence[Hop] = ()
    measures: Sequence[Measure] = ()
    columns: Sequence[str] = ()
    where: str | None = None


@dataclass(frozen=True)
class Mart:
    """A mart's mapping. `group` maps the base's group columns to expressions; without it rows are kept."""

    table: str
    base: str
    columns: Sequence[str] = ()
    where: str | None = None
    group: Mapping[str, str] = field(default_factory=dict)
    measures: Sequence[Measure] = ()
    sides: Sequence[Side] = ()
    derived: Mapping[str, str] = field(default_factory=dict)
    fill: bool = False

    def targets(self) -> list[str]:
        """Columns that the mapping can fill."""
        named = [*self.columns, *self.group, *(m.target for m in self.measures), *self.derived]
        return named + [c for s in self.sides for c in (*s.columns, *(m.target for m in s.measures))]


def _filtered(df: DataFrame, where: str | None) -> DataFrame:
    return df if where is None else df.filter(where)


def _added_up(rows: DataFrame, keys: Sequence[Column], measures: Sequence[Measure]) -> DataFrame:
    """Parts of all measures by the keys; distinct values are first made single, in groups of their own."""
    names = [k for k in rows.select(*keys).columns]
    distinct = [m for m in measures if m.function == "count_distinct"]
    plain = [m for m in measures if m.function != "count_distinct"]
    out = None
    if plain or not distinct:
        out = rows.groupBy(*keys).agg(*(c.alias(n) for m in plain for n, c in m.parts().items())) if plain else (
            rows.select(*keys).distinct())
    for m in distinct:
        single = rows.select(*keys, m._value().alias("_value")).groupBy(*names, "_value").agg(F.count("*"))
        counted = single.groupBy(*names).agg(F.count("_value").alias(m.target))
        out = counted if out is None else out.join(counted, names, "left")
    return out


def _side(side: Side, table: Callable[[str], DataFrame]) -> DataFrame:
    """One row per key of a side, with its columns."""
    rows = _filtered(table(side.table), side.where)
    if not side.measures:
        return rows.select(side.key, *side.columns)
    if side.hops and any(m.function == "count_distinct" for m in side.measures):
        raise ValueError("distinct counts do not add up over hops")
    first = side.hops[0].key if side.hops else side.key
    added = _added_up(rows, [F.col(first)], side.measures)
    for i, hop in enumerate(side.hops):
        known = table(hop.table).select(hop.key, hop.column)
        together = [c.alias(n) for m in side.measures for n, c in m.together().items()]
        added = added.join(known, hop.key).groupBy(hop.column).agg(*together)
    reached = side.hops[-1].column if side.hops else side.key
    return added.select(F.col(reached).alias(side.key), *(m.result() for m in side.measures))


def build(mart: Mart, table: Callable[[str], DataFrame], loaded_at: datetime | None = None) -> DataFrame:
    """The mart by its contract; `table` gives the conformed tables by name."""
    rows = _filtered(table(mart.base), mart.where)
    if mart.group:
        keys = [F.expr(e).alias(n) for n, e in mart.group.items()]
        rows = _added_up(rows, keys, mart.measures).select(*mart.group, *(m.result() for m in mart.measures))
    else:
        rows = rows.select(*mart.columns)
    for side in mart.sides:
        rows = rows.join(_side(side, table), side.key, "left")
    if mart.fill:
        rows = rows.fillna(0)
    for target, expression in mart.derived.items():  # one may build on another
        rows = rows.withColumn(target, F.expr(expression))
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return rows.withColumn("_etl_loaded_ts", stamp).to(table_schema(mart.table))


def conformance(spark: SparkSession) -> DataFrame:
    """(table_name, column_name, in_contract, in_mapping) of the raw tables and the marts."""
    rows = []
    for table, mapped in {**{f"bronze_{e}": list(m) for e, m in RAW.items()},
                          **{n: [*m.targets(), "_etl_loaded_ts"] for n, m in MARTS.items()}}.items():
        contract = set(table_schema(table).names)
        hidden = {c for c in mapped if c not in contract and table in MARTS}  # serve derived columns and joins
        rows += [(table, c, c in contract, c in mapped) for c in sorted(contract | (set(mapped) - hidden))]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, in_contract boolean, in_mapping boolean")


#: Raw tables are copies, with the load's own columns; `{batch}`, `{file}` and `{time}` are the load's.
RAW: dict[str, dict[str, str]] = {
    entity: {**{c: f"cast({c} as string)" for c in columns},
             "_ingestion_ts": "{time}", "_source_file": "{file}", "_batch_id": "{batch}"}
    for entity, columns in BRONZE_COLUMNS.items()}


def apply_raw(df: DataFrame, entity: str, batch: str, file: str | None = None, time: datetime | None = None) -> DataFrame:
    """A raw table by its mapping; without a file name, each row's own."""
    load = {"{batch}": F.lit(batch), "{file}": F.col("_metadata.file_name") if file is None else F.lit(file),
            "{time}": F.current_timestamp() if time is None else F.lit(time).cast("timestamp")}
    return df.select(*((load[e] if e in load else F.expr(e)).alias(c) for c, e in RAW[entity].items()))


_BY_STATUS = "status = '{}'".format
_MONTH = "cast(trunc({}, 'month') as date)".format
_SHARE = "coalesce(try_divide(cast({} as double), cast({} as double)), 0e0)".format

MARTS: dict[str, Mart] = {m.table: m for m in (
    Mart("gold_customer_360", "dim_customer",
         ["customer_id", "full_name", "city", "state", "customer_since"], "is_current = 'Y'", sides=[
             Side("dim_account", "customer_id", measures=[
                 Measure("total_accounts", "count", "account_id"),
                 Measure("active_accounts", "count", "account_id", _BY_STATUS("ACTIVE")),
                 Measure("total_balance", "sum", "balance", _BY_STATUS("ACTIVE")),
                 Measure("avg_balance", "avg", "balance", _BY_STATUS("ACTIVE"))]),
             Side("fact_transaction", "customer_id", [Hop("account_sk", "dim_account", "customer_id")], [
                 Measure("total_transactions", "count", "transaction_id"),
                 Measure("total_credit_amount", "sum", "amount", "transaction_type = 'CREDIT'"),
                 Measure("total_debit_amount", "sum", "amount", "transaction_type = 'DEBIT'"),
                 Measure("last_transaction_date", "max", "transaction_date"),
                 Measure("unsuccessful", "count", "1", "status IN ('FAILED', 'REVERSED')")]),
             Side("fact_loan", "customer_id", [Hop("customer_sk", "dim_customer", "customer_id")], [
                 Measure("loans", "count"),
                 Measure("active_loans", "count", "1", _BY_STATUS("ACTIVE")),
                 Measure("default_loans", "count", "1", _BY_STATUS("DEFAULT")),
                 Measure("total_loan_outstanding", "sum", "outstanding_amount"),
                 Measure("principal", "sum", "principal_amount")])],
         fill=True, derived={
             "customer_segment": "CASE WHEN total_balance >= 1000000 THEN 'PLATINUM' WHEN total_balance >= 500000 "
                                 "THEN 'GOLD' WHEN total_balance >= 100000 THEN 'SILVER' ELSE 'BASIC' END",
             "risk_score": "round(cast(100e0 * (0.5e0 * " + _SHARE("default_loans", "loans") + " + 0.3e0 * "
                           + _SHARE("unsuccessful", "total_transactions") + " + 0.2e0 * least(1e0, "
                           + _SHARE("total_loan_outstanding", "principal") + ")) as decimal(28,10)), 2)"}),
    Mart("gold_branch_performance", "fact_transaction",
         group={"branch_sk": "branch_sk", "report_month": _MONTH("transaction_date")},
         measures=[Measure("total_deposits", "sum", "amount", "transaction_type = 'CREDIT'"),
                   Measure("total_withdrawals", "sum", "amount", "transaction_type = 'DEBIT'")],
         sides=[
             Side("dim_branch", "branch_sk", columns=["branch_id", "branch_name", "city"]),
             Side("dim_account", "branch_id", measures=[
                 Measure("total_customers", "count_distinct", "customer_id"),
                 Measure("total_accounts", "count", "account_id")]),
             Side("fact_loan", "branch_sk", measures=[
                 Measure("total_loans_disbursed", "sum", "principal_amount"),
                 Measure("active_loans", "count", "1", _BY_STATUS("ACTIVE")),
                 Measure("npa_amount", "sum", "outstanding_amount", _BY_STATUS("DEFAULT"))])],
         fill=True, derived={"net_flow": "total_deposits - total_withdrawals"}),
    Mart("gold_daily_txn_summary", "fact_transaction",
         group={c: c for c in ("transaction_date", "channel", "transaction_type")}, measures=[
             Measure("total_count", "count"),
             Measure("success_count", "count", "1", _BY_STATUS("SUCCESS")),
             Measure("failed_count", "count", "1", _BY_STATUS("FAILED")),
             Measure("total_amount", "sum", "amount"), Measure("avg_amount", "avg", "amount"),
             Measure("max_amount", "max", "amount"), Measure("min_amount", "min", "amount")]),
    Mart("gold_loan_portfolio", "fact_loan",
         group={"loan_type": "loan_type", "report_month": _MONTH("disburse_date")}, measures=[
             Measure("total_loans", "count"),
             Measure("active_loans", "count", "1", _BY_STATUS("ACTIVE")),
             Measure("defaulted_loans", "count", "1", _BY_STATUS("DEFAULT")),
             Measure("total_principal", "sum", "principal_amount"),
             Measure("total_outstanding", "sum", "outstanding_amount"),
             Measure("avg_interest_rate", "avg", "interest_rate"),
             Measure("avg_tenure_months", "avg", "tenure_months")],
         derived={"npa_ratio": "cast(defaulted_loans * 100 as decimal(20,0)) / total_loans"}))}
