"""Distinct counts and quantiles from stored sketches that merge, day by day, without the rows.

A sketch of a day is made once and stored; a question over any days and any coarser groups merges the
sketches that it touches, of a few kilobytes each, whatever number of rows stands behind them. The
answers lie within a stated bound of the exact ones: `DISTINCT_BOUND` of the count, `RANK_BOUND` of
the rank. Exact operators are `rows.exact_quantiles` and `count_distinct`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a distinct count; its standard error is 1.04 / sqrt(registers).
REGISTERS = 13
#: Values kept at a level of a quantile sketch; the error of a rank is some 0.4 % for 800.
LEVEL = 800
#: Stated bounds, over three standard errors: of a distinct count's size, and of a quantile's rank.
DISTINCT_BOUND = 0.04
RANK_BOUND = 0.012
MONTH = "sketch_month"


def sketched(df: DataFrame, groups: Sequence[str], distinct: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(groups, n, a distinct sketch `d_<c>` and a quantile sketch `q_<c>` of the named columns).

    Sketches are built in the map tasks and merged, so a group with a third of all rows is no
    matter. Nulls are left out; a group without values has a null quantile sketch.
    """
    return df.groupBy(*groups).agg(
        F.count("*").alias("n"),
        *(F.hll_sketch_agg(F.col(c).cast("string"), REGISTERS).alias(f"d_{c}") for c in distinct),
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), LEVEL).alias(f"q_{c}") for c in values))


def store_daily(df: DataFrame, path: str, day: str, groups: Sequence[str], distinct: Sequence[str],
                values: Sequence[str]) -> None:
    """Sketches of each day and group, by month; the months of `df` are replaced, so they must be whole."""
    made = sketched(df, [day, *groups], distinct, values)
    (made.withColumn(MONTH, F.date_format(F.trunc(day, "month"), "yyyy-MM")).hint("rebalance", MONTH)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))


def merged(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, from stored ones."""
    parts = [F.sum("n").alias("n")]
    for c in sketches.columns:
        if c.startswith("d_"):
            parts.append(F.hll_union_agg(c).alias(c))
        elif c.startswith("q_"):
            parts.append(F.kll_merge_agg_double(c).alias(c))
    return sketches.groupBy(*groups).agg(*parts)


def distinct_of(column: str) -> Column:
    """The estimated number of distinct values."""
    return F.hll_sketch_estimate(f"d_{column}")


def quantiles_of(column: str, shares: Sequence[float]) -> Column:
    """The estimated quantiles, as an array."""
    return F.kll_sketch_get_quantile_double(f"q_{column}", F.array(*map(F.lit, shares)))


def within_bounds(
    estimates: DataFrame, rows: DataFrame, groups: Sequence[str], distinct: str, value: str, shares: Sequence[float],
) -> DataFrame:
    """(groups, n, exact distinct count, whether each estimate keeps its bound) against the rows.

    `estimates` has the columns `distinct` and `quantiles`. A quantile keeps its bound if its share lies
    between the shares of the rows below it and up to it, give or take the bound.
    """
    known = estimates.select(*groups, "distinct", "quantiles")
    at = lambda k: F.element_at("quantiles", k + 1)
    x = F.col(value).cast("double")
    counted = rows.join(known, list(groups)).groupBy(*groups).agg(
        F.count("*").alias("n"), F.count(value).alias("valued"), F.first("distinct").alias("distinct"),
        *(part for k in range(len(shares)) for part in (
            F.count_if(x < at(k)).alias(f"below{k}"), F.count_if(x <= at(k)).alias(f"upto{k}"))))
    exact = rows.groupBy(*groups, distinct).agg(F.count("*").alias("_n")).groupBy(*groups).agg(
        F.count(distinct).alias("exact_distinct"))
    kept = F.lit(True)
    for k, share in enumerate(shares):
        kept = kept & (F.col(f"below{k}") / F.col("valued") <= share + RANK_BOUND) & (
            F.col(f"upto{k}") / F.col("valued") >= share - RANK_BOUND)
    return counted.join(exact, list(groups)).select(
        *groups, "n", "exact_distinct",
        (F.abs(F.col("distinct") - F.col("exact_distinct")) <= F.col("exact_distinct") * DISTINCT_BOUND)
        .alias("distinct_within"), kept.alias("quantiles_within"))
