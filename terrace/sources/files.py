"""File sources: CSV, JSON and Parquet into the raw layer's all-text contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.schemas import bronze_schema


def add_audit(
    df: DataFrame, batch_id: str, source_file: str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Load time, source file and load id; without a name, each row's own file name."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    file: Column = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.select(
        "*", stamp.alias("_ingestion_ts"), file.alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"))


def scan_csv(spark: SparkSession, path: str, entity: str, delimiter: str = ",") -> DataFrame:
    """Explicit all-text schema: nothing is inferred, and an empty field is null."""
    return (
        spark.read.schema(bronze_schema(entity)).option("header", True)
        .option("delimiter", delimiter).csv(path))


def scan_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """Column names from the header, every column text."""
    return spark.read.option("header", True).csv(path)


def scan_json(
    spark: SparkSession, path: str, entity: str, multi_line: bool = False
) -> DataFrame:
    """JSON as text columns; numbers and flags become their text.

    `multi_line` reads a file that is one array, which a single task must parse. JSON lines,
    the default, can be split.
    """
    return spark.read.schema(bronze_schema(entity)).option("multiLine", multi_line).json(path)


def scan_parquet(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")


def with_row_position(df: DataFrame) -> DataFrame:
    """Number the rows of a file scan 0, 1, 2, ... in (file, offset) order as `row_position`.

    Rows are numbered inside each file block and shifted by the rows of earlier blocks. Only
    one row per block meets in the running total.
    """
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seen"))
    # Splitting is by bytes, so a block holds a bounded number of rows.
    in_block = Window.partitionBy("_file", "_block").orderBy("_seen")
    numbered = placed.withColumn("_n", F.row_number().over(in_block) - 1)
    blocks = placed.groupBy("_file", "_block").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        numbered.join(starts, ["_file", "_block"])
        .withColumn("row_position", F.col("_start") + F.col("_n"))
        .drop("_file", "_block", "_seen", "_n", "_start"))
