"""Lineage of every key through the layers: which hops have it, and where a transform went wrong.

Each layer gives its keys with a digest of the values that were carried on (`actual`), and with a digest
of what the next layer should have made of them (`expected`). All layers meet in one grouping by key,
hop and digest, so there is a single shuffle of narrow rows whatever the number of hops, and copies of
a key are combined in the map tasks. A key ends with two bits for each hop: present, and as expected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Hop:
    """A layer: the key in its rows, the values it holds, and those the next layer should hold.

    `actual` of a layer is compared with `expected` of the one before, value by value as text.
    """

    name: str
    rows: DataFrame
    key: Column
    actual: Sequence[Column] = ()
    expected: Sequence[Column] = ()


def _digest(values: Sequence[Column]) -> Column:
    texts = [F.coalesce(F.concat(F.lit("="), v.cast("string")), F.lit("-")) for v in values]
    return F.xxhash64(*texts) if texts else F.lit(0).cast("long")


def trace(hops: Sequence[Hop]) -> DataFrame:
    """(key, bits): bit 2i if hop i has the key, bit 2i + 1 if what it holds is what was expected.

    Null keys are left out. A key with several rows in a layer is as expected if one of them is.
    """
    parts = []
    for i, hop in enumerate(hops):
        keyed = hop.rows.filter(hop.key.isNotNull())
        last = i + 1 == len(hops)
        # What the first layer holds is compared with nothing: what it expects tells that it has the key.
        rows = [F.struct(F.lit(i).alias("hop"), F.lit(True).alias("actual"), _digest(hop.actual).alias("digest"))]
        if not last:
            rows = rows if i else []
            rows.append(F.struct(F.lit(i + 1).alias("hop"), F.lit(False).alias("actual"),
                                 _digest(hop.expected).alias("digest")))
        parts.append(keyed.select(hop.key.cast("string").alias("key"), F.inline(F.array(*rows))))
    met = reduce(DataFrame.unionByName, parts).groupBy("key", "hop", "digest").agg(
        F.bool_or("actual").alias("held"), F.bool_or(~F.col("actual")).alias("awaited"))
    flags = [F.when(F.col("held"), F.expr("shiftleft(1L, 2 * hop)")).otherwise(F.lit(0)),
             F.when(F.col("held") & (F.col("awaited") | (F.col("hop") == 0)), F.expr("shiftleft(1L, 2 * hop + 1)"))
             .otherwise(F.lit(0)),
             F.when(F.col("awaited") & (F.col("hop") == 1), F.lit(3)).otherwise(F.lit(0))]
    return met.groupBy("key").agg(F.bit_or(reduce(lambda a, b: a.bitwiseOR(b), flags)).alias("bits"))


def patterns(traced: DataFrame, names: Sequence[str], entity: str) -> DataFrame:
    """(entity, pattern, keys): how many keys went which way.

    A pattern lists the hops that have the key, those with what was expected marked by `=`.
    """
    has = lambda i, b: F.expr(f"bits & {1 << (2 * i + b)}L <> 0")
    words = [F.when(has(i, 1), F.lit(f"{n}=")).when(has(i, 0), F.lit(n)) for i, n in enumerate(names)]
    return traced.groupBy("bits").agg(F.count("*").alias("keys")).select(
        F.lit(entity).alias("entity"), F.concat_ws(" ", *words).alias("pattern"), "keys")


def broken(traced: DataFrame, names: Sequence[str]) -> DataFrame:
    """(key, hop, finding): the first hop at which each incomplete key went wrong."""
    whole = (1 << 2 * len(names)) - 1
    found = reduce(
        lambda rest, i: F.when(F.expr(f"bits & {1 << 2 * i}L = 0"), F.struct(
            F.lit(names[i]).alias("hop"), F.lit("missing").alias("finding"))).when(
            F.expr(f"bits & {1 << (2 * i + 1)}L = 0"), F.struct(
                F.lit(names[i]).alias("hop"), F.lit("different").alias("finding"))).otherwise(rest),
        reversed(range(len(names))), F.lit(None))
    return traced.filter(f"bits <> {whole}").select("key", found.alias("f")).select("key", "f.*")
