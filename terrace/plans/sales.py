"""Sales table: profit, roll-ups and price bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import columns as C
from terrace.schemas import table_schema


def with_profit(sales: DataFrame) -> DataFrame:
    """The sales contract with profit derived from units, price and margin."""
    profit = C.sales_profit(F.col("units_sold"), F.col("unit_price"), F.col("margin_pct"))
    return sales.withColumn("profit", profit).to(table_schema("sales"))


def _totals(grouped) -> DataFrame:
    revenue = F.col("units_sold") * F.col("unit_price")
    return grouped.agg(
        F.count("*").alias("sales"),
        F.sum("units_sold").alias("units"),
        F.sum(revenue).cast("decimal(24,2)").alias("revenue"),
        F.sum("profit").cast("decimal(24,2)").alias("profit"))


def by_city_category(sales: DataFrame) -> DataFrame:
    return _totals(sales.groupBy("branch_city", "category"))


def by_date(sales: DataFrame) -> DataFrame:
    return _totals(sales.groupBy("transaction_date"))


def price_band_check(sales: DataFrame, bands: DataFrame) -> DataFrame:
    """Per category, the sales priced outside the band (category, low, high).

    Sales are counted per category and price before the join, so one popular category does not
    land in one task row by row.
    """
    priced = sales.groupBy("category", "unit_price").agg(F.count("*").alias("n"))
    outside = ~F.col("unit_price").between(F.col("low"), F.col("high"))
    return priced.join(bands, "category", "left").groupBy("category").agg(
        F.sum("n").alias("sales"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outside_band"),
        F.coalesce(F.sum(F.when(F.col("low").isNull(), F.col("n"))), F.lit(0))
        .alias("without_band"))
