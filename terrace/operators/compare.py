"""Cell-by-cell comparison of two tables or two files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.files import scan_csv_header, with_row_position


def compare_cells(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per differing cell, and one per key that only one side has.

    Keys must be unique on each side; `unique` in the quality checks tells.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*keys, F.struct(*(F.col(c).cast("string").alias(c) for c in columns))
                         .alias(tag))

    both = side(left, "l").join(side(right, "r"), list(keys), "full_outer")
    cells = F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.col(f"l.{c}").alias("left_value"),
                 F.col(f"r.{c}").alias("right_value"), F.lit("different").alias("finding"))
        for c in columns))
    differing = F.filter(cells, lambda x: ~x["left_value"].eqNullSafe(x["right_value"]))
    findings = (
        F.when(F.col("l").isNull(), F.array(_absent("missing on left")))
        .when(F.col("r").isNull(), F.array(_absent("missing on right")))
        .otherwise(differing))
    return both.select(*keys, F.inline(findings))


def _absent(finding: str) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(F.lit("*").alias("column_name"), nothing.alias("left_value"),
                    nothing.alias("right_value"), F.lit(finding).alias("finding"))


def compare_files(spark: SparkSession, csv_path: str, json_path: str,
                  multi_line: bool = True) -> DataFrame:
    """Row i of a CSV file against row i of a JSON file, on the columns of the CSV header."""
    left = with_row_position(scan_csv_header(spark, csv_path))
    columns = [c for c in left.columns if c != "row_position"]
    schema = ", ".join(f"`{c}` string" for c in columns)
    right = with_row_position(
        spark.read.schema(schema).option("multiLine", multi_line).json(json_path))
    return compare_cells(left, right, ["row_position"], columns)


PAIR = "check_name string, row_position bigint, column_name string, left_value string, right_value string, finding string"


def file_pair(spark: SparkSession, csv_path: str, json_path: str, multi_line: bool = False) -> DataFrame:
    """All findings on a CSV file and the JSON file that should hold the same rows, as rows of `PAIR`.

    `extension`: a path that doesn't end as its format does. `header`: a column that one of them lacks;
    JSON columns are those of any row. `row_count`: both numbers of rows, always. `cell`: row i against
    row i, on the columns of the CSV header.
    """
    csv = with_row_position(scan_csv_header(spark, csv_path))
    named = scan_csv_header(spark, csv_path).columns
    found = spark.read.option("multiLine", multi_line).option("primitivesAsString", True).json(json_path)
    rows = [("extension", None, "*", path, kind, "different") for path, kind in ((csv_path, "csv"), (json_path, "json"))
            if wrong_extension(path.rstrip("/"), kind)]
    rows += [("header", None, c, None, None, finding) for c, finding in header_findings(
        csv.drop("row_position"), found)]
    both = sorted(set(named) & set(found.columns), key=named.index)
    json = with_row_position(spark.read.schema(", ".join(f"`{c}` string" for c in both) or "`-` string").option(
        "multiLine", multi_line).json(json_path))
    counts = csv.agg(F.count("*").alias("n")).withColumn("side", F.lit(0)).unionByName(
        json.agg(F.count("*").alias("n")).withColumn("side", F.lit(1))).agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r"))
    count_row = counts.select(
        F.lit("row_count").alias("check_name"), F.lit(None).cast("bigint").alias("row_position"), F.lit("*").alias("column_name"),
        F.col("l").cast("string").alias("left_value"), F.col("r").cast("string").alias("right_value"),
        F.when(F.col("l") == F.col("r"), "equal").otherwise("different").alias("finding"))
    cells = compare_cells(csv, json, ["row_position"], both).select(
        F.lit("cell").alias("check_name"), "row_position", "column_name", "left_value", "right_value", "finding")
    return spark.createDataFrame(rows, PAIR).unionByName(count_row).unionByName(cells)


def header_findings(csv: DataFrame, json: DataFrame) -> list[tuple[str, str]]:
    """Columns one of the two files lacks."""
    a, b = set(csv.columns), set(json.columns)
    return [(c, "missing on right") for c in sorted(a - b)] + [
        (c, "missing on left") for c in sorted(b - a)]


def wrong_extension(path: str, expected: str) -> bool:
    return not path.lower().endswith("." + expected.lower())
