"""Row selection: deduplication, ranking, set differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import cut_lineage


def row_digest(columns: Sequence[str]) -> Column:
    """64-bit digest of a row; nulls are marked, as the hash itself passes over them."""
    names = [f"`{c}`" for c in columns]
    nulls = ", ".join(f"if({c} IS NULL, '1', '0')" for c in names)
    return F.expr(f"xxhash64({', '.join(names)}, concat({nulls}))")


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the newest, and among equally new ones the one of largest digest.

    The digest makes reruns agree. It reads all columns of `df`, so give it only those that are
    needed; what goes through the sort and the shuffle is its one number beside the columns
    asked for later. The `= 1` filter on row_number lets Spark keep a single row per key in every
    map task (WindowGroupLimit), so a key that holds a third of all rows reaches the shuffle as one
    row per task.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    order = [*newest_first, *([row_digest(rest).desc()] if rest else [])] or list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def fresh_key(name: str) -> Column:
    """The key as text without any known partitioning, for the sides of a join that may be skewed.

    Adaptive execution splits a skewed join partition only when both sides were shuffled for
    that join. A side that an earlier grouping or window left partitioned by the key would not
    be; by this key it is shuffled again. A side read from storage is shuffled once either way.
    """
    return F.concat(F.col(name).cast("string"), F.lit(""))


def lookup(facts: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join to a side that has one row per key; a hot key is split over tasks."""
    keyed = side.withColumn("_key", fresh_key(key)).drop(key)
    return facts.withColumn("_fact_key", fresh_key(key)).join(
        keyed, F.col("_fact_key") == F.col("_key"), "left").drop("_fact_key", "_key")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """k best rows; each task keeps k, and one task merges them (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return top_k(df, n, *order)


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def keep_known(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the other side has; its keys are made distinct in the map tasks first."""
    return df.join(distinct_keys(other, *keys), list(keys), "left_semi")


def drop_known(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the other side lacks."""
    return df.join(distinct_keys(other, *keys), list(keys), "left_anti")


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.subtract(right)


def symmetric_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str], labels: tuple[str, str]
) -> DataFrame:
    """Keys found on one side only, with the side that has them."""
    a, b = distinct_keys(left, *keys), distinct_keys(right, *keys)
    return drop_known(a, b, keys).withColumn("side", F.lit(labels[0])).unionByName(
        drop_known(b, a, keys).withColumn("side", F.lit(labels[1])))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def share_of_total(df: DataFrame, group: str) -> DataFrame:
    """Rows and percent of all rows per group; the total comes from the grouped rows."""
    grouped = df.groupBy(group).agg(F.count("*").alias("n"))
    total = grouped.select(F.sum("n")).scalar()
    return grouped.withColumn("share_pct", F.round(F.col("n").cast("double") / total * 100, 6))


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """(groups..., q0, q1, ...): of each group, the smallest values that reach the given shares.

    Equal values are counted first, in the map tasks. The counts are range-partitioned by group
    and value, so a group may span many partitions; sums over partitions, of which there are
    few, say how many rows come before each. Nulls are left out.
    """
    part, n = "_part", "_n"
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias(n))
    placed = cut_lineage(
        counted.repartitionByRange(*groups, value).withColumn(part, F.spark_partition_id()))
    whole = Window.partitionBy(*groups)
    before = placed.groupBy(*groups, part).agg(F.sum(n).alias("_rows")).select(
        *groups, part, F.sum("_rows").over(whole).alias("_all"),
        (F.sum("_rows").over(whole.orderBy(part)) - F.col("_rows")).alias("_before"))
    inside = F.sum(n).over(Window.partitionBy(*groups, part).orderBy(value))
    # Null groups are groups as well, so the join compares structs, which are never null.
    left = placed.select("*", inside.alias("_inside"), F.struct(*groups, part).alias("_key"))
    right = before.select("_all", "_before", F.struct(*groups, part).alias("_key"))
    reached = left.join(right, "_key").withColumn("_upto", F.col("_before") + F.col("_inside"))
    return reached.groupBy(*groups).agg(*(
        F.min(F.when(F.col("_upto") >= F.ceil(F.lit(p) * F.col("_all")), F.col(value))).alias(f"q{i}")
        for i, p in enumerate(probabilities)))


def changed_values(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows present on both sides whose compared columns differ, null-safely."""
    a = left.select(*keys, *(F.col(c).alias(f"left_{c}") for c in columns))
    b = right.select(*keys, *(F.col(c).alias(f"right_{c}") for c in columns))
    differs = reduce(
        lambda x, y: x | y,
        [~F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in columns],
    )
    return a.join(b, list(keys), "inner").filter(differs)
