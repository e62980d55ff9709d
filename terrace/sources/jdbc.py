"""JDBC source and sink. The driver jar for the database must be on the session's classpath."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}


@dataclass(frozen=True)
class Slices:
    """How to read a table in parallel: a numeric or date column and its range."""

    column: str
    low: str
    high: str
    parts: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": self.low,
                "upperBound": self.high, "numPartitions": str(self.parts)}


def query_options(db: Database, query: str, fetch: int = 10_000) -> dict[str, str]:
    """A SELECT run by the database; filters and columns of the plan are pushed into it."""
    return {**db.options(), "query": query, "fetchsize": str(fetch)}


def table_options(db: Database, table: str, slices: Slices, fetch: int = 10_000) -> dict[str, str]:
    return {**db.options(), "dbtable": table, "fetchsize": str(fetch), **slices.options()}


def run_query(spark: SparkSession, db: Database, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(db, query)).load()


def scan_table(spark: SparkSession, db: Database, table: str, slices: Slices) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(db, table, slices)).load()


def count_rows(spark: SparkSession, db: Database, table: str) -> int:
    return int(run_query(spark, db, f"SELECT count(*) AS n FROM {table}").first()[0])


def write_options(db: Database, table: str, batch: int = 10_000, writers: int = 16) -> dict[str, str]:
    """`numPartitions` caps the connections the database has to bear."""
    return {**db.options(), "dbtable": table, "batchsize": str(batch),
            "numPartitions": str(writers)}


def reload_table(df: DataFrame, db: Database, table: str) -> int:
    """Empty the table, keep its definition, insert, and return the stored row count."""
    (df.write.format("jdbc").mode("overwrite").option("truncate", True)
     .options(**write_options(db, table)).save())
    return count_rows(df.sparkSession, db, table)


def append_rows(df: DataFrame, db: Database, table: str) -> tuple[int, int]:
    """Append; returns the row counts before and after for reconciliation."""
    before = count_rows(df.sparkSession, db, table)
    df.write.format("jdbc").mode("append").options(**write_options(db, table)).save()
    return before, count_rows(df.sparkSession, db, table)
