"""Registration of queries with their checking SQL, and the tables queries start from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from terrace.functions import columns as C
from terrace.plans import gold, silver
from terrace.registry.layers_sql import AS_OF, FIRST_DAY, SECOND_DAY, with_layers
from terrace.session import cut_lineage, side_by_side
from terrace.sources import given


#: Conformed tables and the attributes that build them.
CONFORMED = {"dim_customer": "customers", "dim_account": "accounts", "dim_branch": "branches", "dim_product": "products",
             "fact_transaction": "transactions", "fact_loan": "loans"}
FACTS = ("fact_transaction", "fact_loan")


@dataclass(frozen=True)
class Tables:
    """Lazy plans of every layer over one folder of test tables."""

    spark: SparkSession
    sf_dir: str
    stored: Mapping[str, DataFrame] = field(default_factory=dict)

    def keeping(self, *views: str) -> Tables:
        """The same layers over tables that are stored first, for plans that use them more than once.

        Names are those of raw views, or of conformed tables, which are built from what is stored before:
        raw views first, then dimensions, then facts, those of a level side by side.
        """
        tables = self
        facts = [n for n in views if n in FACTS]
        dimensions = [n for n in views if n in CONFORMED and n not in FACTS]
        for level in ([n for n in views if n not in CONFORMED], dimensions, facts):
            frames = {n: getattr(tables, CONFORMED[n]) if n in CONFORMED else tables.raw(n) for n in level}
            kept: dict[str, DataFrame] = {}
            side_by_side(self.spark, [lambda n=n, df=df: kept.update({n: cut_lineage(df)}) for n, df in frames.items()])
            tables = Tables(self.spark, self.sf_dir, {**tables.stored, **kept})
        return tables

    def given(self, name: str) -> DataFrame:
        return given.given_table(self.spark, self.sf_dir, name)

    def raw(self, view: str) -> DataFrame:
        return self.stored[view] if view in self.stored else given.raw(self.spark, view, self.given)

    @cached_property
    def customers(self) -> DataFrame:
        return self.stored["dim_customer"] if "dim_customer" in self.stored else silver.dim_customer(self.raw("customers"), AS_OF, FIRST_DAY)

    @cached_property
    def first_load(self) -> DataFrame:
        known = self.raw("customers").filter(F.col("customer_since") < given.FIRST_LOAD)
        return silver.dim_customer(known, AS_OF, FIRST_DAY)

    @cached_property
    def versions(self) -> DataFrame:
        return silver.merge_dim_customer(
            self.first_load, self.raw("customers_day2"), AS_OF, SECOND_DAY)

    @cached_property
    def accounts(self) -> DataFrame:
        return self.stored["dim_account"] if "dim_account" in self.stored else silver.dim_account(self.raw("accounts"))

    @cached_property
    def branches(self) -> DataFrame:
        return self.stored["dim_branch"] if "dim_branch" in self.stored else silver.dim_branch(self.raw("branches"))

    @cached_property
    def products(self) -> DataFrame:
        return self.stored["dim_product"] if "dim_product" in self.stored else silver.dim_product(self.raw("product_types"))

    @cached_property
    def transactions(self) -> DataFrame:
        return self.stored["fact_transaction"] if "fact_transaction" in self.stored else self.transactions_from("transactions")

    @cached_property
    def typed_transactions(self) -> DataFrame:
        """For marts and checks that need no resolved key, and so no join of the largest table."""
        if "typed_transactions" in self.stored:
            return self.stored["typed_transactions"]
        return self.typed_from("transactions")

    def typed_from(self, view: str) -> DataFrame:
        return silver.typed_transactions(self.raw(view)).withColumn(
            "date_sk", C.date_key(F.col("transaction_date")))

    @cached_property
    def typed_loans(self) -> DataFrame:
        return silver.typed_loans(self.raw("loans"))

    def transactions_from(self, view: str) -> DataFrame:
        return silver.fact_transaction(
            self.raw(view), self.accounts, self.customers, self.branches)

    @cached_property
    def loans(self) -> DataFrame:
        return self.stored["fact_loan"] if "fact_loan" in self.stored else silver.fact_loan(self.raw("loans"), self.customers, self.branches, self.products)

    @cached_property
    def calendar(self) -> DataFrame:
        return silver.dim_date(silver.date_bounds(
            self.given("lineitem").select(F.col("l_shipdate").cast("date").alias("d")), "d"))

    @cached_property
    def _facts(self) -> tuple[DataFrame, DataFrame]:
        """What marts start from: facts that are stored, else typed rows."""
        return (self.stored["fact_transaction"] if "fact_transaction" in self.stored else self.typed_transactions,
                self.stored["fact_loan"] if "fact_loan" in self.stored else self.typed_loans)

    @cached_property
    def customer_360(self) -> DataFrame:
        return gold.customer_360(self.customers, self.accounts, *self._facts)

    @cached_property
    def branch_performance(self) -> DataFrame:
        return gold.branch_performance(self.branches, self.accounts, *self._facts)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return gold.daily_txn_summary(self._facts[0])

    @cached_property
    def loan_portfolio(self) -> DataFrame:
        return gold.loan_portfolio(self._facts[1])

    @cached_property
    def readings(self) -> DataFrame:
        return self.raw("sensor_readings")


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with SQL giving the same rows where SQL can."""
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = with_layers(sql)
        return build
    return register


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, which print alike in every engine."""
    as_type = {DateType: "string", DecimalType: "double"}
    return df.selectExpr(*(
        f"cast(`{f.name}` as {as_type[type(f.dataType)]}) AS `{f.name}`"
        if type(f.dataType) in as_type else f"`{f.name}`"
        for f in df.schema.fields if f.name != "_etl_loaded_ts"))


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(QUERIES[name](Tables(spark, sf_dir)))
    run.__name__ = name
    return run
