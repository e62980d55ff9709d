"""Table sinks, table definitions and catalogue queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.schemas import table_schema


#: Of stored tables: a good deal smaller than the default, for little time.
COMPRESSION = "zstd"


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write Parquet and return the rows written, counted by the write job itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", COMPRESSION).parquet(path)
    return int(seen.get["rows"])


def write_by_month(df: DataFrame, path: str, day: str, month: str = "transaction_month") -> int:
    """Replace the months present in `df` and leave all others as they are.

    The rebalance hint gathers a month into few files and splits a month that is much larger
    than the rest, so neither thousands of small files nor one huge task results.
    """
    if df.isEmpty():  # an empty write reports no count
        return 0
    seen = Observation()
    keyed = df.withColumn(month, F.date_format(F.trunc(day, "month"), "yyyy-MM"))
    (keyed.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", month)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month).parquet(path))
    return int(seen.get["rows"])


def append_by_month(df: DataFrame, path: str, day: str, month: str = "transaction_month") -> int:
    """Add rows to a table stored by month; what is there stays as it is."""
    if df.isEmpty():  # an empty write reports no count
        return 0
    seen = Observation()
    keyed = df.withColumn(month, F.date_format(F.trunc(day, "month"), "yyyy-MM"))
    (keyed.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", month)
     .write.mode("append").partitionBy(month).parquet(path))
    return int(seen.get["rows"])


def create_table(spark: SparkSession, name: str, table: str, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS from the contract of `table`."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(table).fields)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def catalog_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Ordered columns and types of each table, with the number of values each holds."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(*(F.count(c).alias(c) for c in df.columns))
        rows = [
            F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("position"),
                     F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"),
                     F.col(f.name).alias("known_values"))
            for i, f in enumerate(df.schema.fields, 1)]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, each counted by its own partial aggregation."""
    parts = [df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
