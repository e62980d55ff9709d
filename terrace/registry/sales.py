"""Registered queries: sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.plans import sales
from terrace.registry.common import Tables, query

_PROFIT = """cast(cast(units_sold as decimal(10,0)) * unit_price * margin_pct * 0.01
             as decimal(14,2))"""
_TOTALS = f"""count(*) AS sales, cast(sum(units_sold) as bigint) AS units,
  cast(sum(units_sold * unit_price) as double) AS revenue,
  cast(sum({_PROFIT}) as double) AS profit"""


@query("sales_profit", f"""
  SELECT brand, category, branch_city, cast(transaction_date as varchar) AS transaction_date,
    units_sold, cast(unit_price as double) AS unit_price, cast(margin_pct as double) AS margin_pct,
    cast({_PROFIT} as double) AS profit, inventory_type FROM b_sales""")
def profit(t: Tables) -> DataFrame:
    return sales.with_profit(t.raw("sales"))


@query("sales_by_city_category", f"""
  SELECT branch_city, category, {_TOTALS} FROM b_sales GROUP BY branch_city, category""")
def by_city_category(t: Tables) -> DataFrame:
    return sales.by_city_category(sales.with_profit(t.raw("sales")))


@query("sales_by_date", f"""
  SELECT cast(transaction_date as varchar) AS transaction_date, {_TOTALS}
  FROM b_sales GROUP BY 1""")
def by_date(t: Tables) -> DataFrame:
    return sales.by_date(sales.with_profit(t.raw("sales")))


@query("sales_price_band", """
  SELECT s.category, count(*) AS sales,
    count(*) FILTER (WHERE unit_price NOT BETWEEN low AND high) AS outside_band,
    count(*) FILTER (WHERE low IS NULL) AS without_band
  FROM b_sales s LEFT JOIN (
    SELECT p_type AS category, min(cast(p_retailprice as decimal(12,2))) + 10 AS low,
      max(cast(p_retailprice as decimal(12,2))) - 10 AS high FROM part
    WHERE p_type <> 'SMALL' GROUP BY p_type) b ON b.category = s.category
  GROUP BY s.category""")
def price_band(t: Tables) -> DataFrame:
    price = F.col("p_retailprice").cast("decimal(12,2)")
    bands = t.given("part").filter("p_type <> 'SMALL'").groupBy(
        F.col("p_type").alias("category")).agg(
        (F.min(price) + 10).alias("low"), (F.max(price) - 10).alias("high"))
    return sales.price_band_check(t.raw("sales"), bands)
