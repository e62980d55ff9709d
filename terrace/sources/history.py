"""Schema history: the columns of every load as rows, and what has changed between loads.

Each load adds a few rows to a stored table. Drift is a join of two loads, or of a load and a contract,
so that it is found by Spark over all tables at once, however long the history is.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.sources.tables import catalog_columns

CONTRACT = "contract"


def schema_rows(tables: Mapping[str, DataFrame], load: str) -> DataFrame:
    """(load_id, table_name, position, column_name, data_type, known_values) of each column as it was loaded."""
    return catalog_columns(tables).select(F.lit(load).alias("load_id"), "*")


def contract_rows(like: DataFrame, contracts: Mapping[str, StructType]) -> DataFrame:
    """Contracts in the form of a load, without counts."""
    rows = [(CONTRACT, table, i, f.name, f.dataType.simpleString(), None)
            for table, schema in contracts.items() for i, f in enumerate(schema.fields, 1)]
    return like.sparkSession.createDataFrame(rows, like.schema)


def store_schema(tables: Mapping[str, DataFrame], path: str, load: str) -> None:
    """Add a load's columns to the history; a load that is stored again replaces itself."""
    (schema_rows(tables, load).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id").parquet(path))


def drift(history: DataFrame, before: str, now: str) -> DataFrame:
    """(table_name, column_name, change, old, new, known_values): columns that differ between two loads.

    `added`, `dropped`, `retyped` (with both types) or `moved` (with both positions). Tables that only
    one of the loads has are left out: they haven't been loaded again.
    """
    shape = ["position", "data_type", "known_values"]
    old, new = (history.filter(F.col("load_id") == load).select(
        "table_name", "column_name", F.struct(*shape).alias(side)) for load, side in ((before, "o"), (now, "n")))
    both = old.select("table_name").distinct().join(new.select("table_name").distinct(), "table_name")
    joined = old.join(new, ["table_name", "column_name"], "full_outer").join(both, "table_name", "left_semi")
    change = (F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "dropped")
              .when(F.col("o.data_type") != F.col("n.data_type"), "retyped")
              .when(F.col("o.position") != F.col("n.position"), "moved"))
    shown = lambda side: F.when(F.col("change") == "moved", F.col(f"{side}.position").cast("string")).otherwise(
        F.col(f"{side}.data_type"))
    return joined.withColumn("change", change).filter("change IS NOT NULL").select(
        "table_name", "column_name", "change", shown("o").alias("old"), shown("n").alias("new"),
        F.coalesce("n.known_values", "o.known_values").alias("known_values"))


def drift_over(history: DataFrame, loads: list[str]) -> DataFrame:
    """The drift of each load from the one before, with its name."""
    parts = [drift(history, a, b).withColumn("load_id", F.lit(b)) for a, b in zip(loads, loads[1:])]
    return reduce(DataFrame.unionByName, parts)
