"""Sharding by sampled splitters: shards of near equal bytes, equal texts together.

Rows are ordered by the hash of their text, then id, then a row number. A sample in which a row's
chance grows with its size gives quantiles of that order; they are the boundaries of many more ranges than
there are shards. A range that still holds over twice its share, of bytes or of rows, is divided
again by a denser sample of its own rows, until none is left. Running sums are then taken within ranges
only, and over the few ranges, so no task holds more than a range, whatever text a third of all rows
share.

Texts of more than a part of a shard are placed first, the largest on the emptiest shard. The others
follow in their order and fill the shards up to one level: a text goes where the middle of its bytes
lies, also if its rows lie in several ranges. Only a text that is larger than a shard is divided, by id.

Everything is DataFrame functions. What comes to the driver, and goes back as literals, are the
boundaries, at most `ranges` and those of divided ranges, and the placed texts, at most `PARTS * shards`.

Defined results for odd input: a null text has size 1 and the checksum of the empty text; null ids
come last among equal texts; repeated rows are placed each; an empty table gives no rows; only the
id and text columns are read.
"""

from __future__ import annotations

import heapq
import json
from itertools import accumulate, count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.session import cut_lineage

#: Ranges for each shard, at least; and rows for each range, at most on average.
RANGES_PER_SHARD = 64
ROWS_PER_RANGE = 1_000_000
#: Sampled keys for each range.
DRAWS = 32
#: Texts of at least this part of a shard are placed one by one.
PARTS = 64
KEY = ("k", "id", "n")
LAST_ID = (1 << 63) - 1


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The narrow table that everything else reads: key, size and checksum of each row."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return cut_lineage(docs.select(
        F.xxhash64(said).alias("k"), F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.monotonically_increasing_id().alias("n"), F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(said) + 1).cast("long").alias("size"), F.crc32(said).alias("text_crc32")))


def _range_of(boundaries: list[tuple]) -> Column:
    """How many boundaries are at or below the row's key: a binary search in a literal."""
    if not boundaries:
        return F.lit(0)
    kind = "array<struct<" + ",".join(f"{c}:bigint" for c in KEY) + ">>"
    listed = F.from_json(F.lit(json.dumps([dict(zip(KEY, b)) for b in boundaries])), kind)
    steps = [1 << i for i in reversed(range(len(boundaries).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            at + step > len(boundaries), at).when(
            F.struct(*KEY) >= F.element_at(listed, at + step), at + step).otherwise(at))


def _quantiles(rows: DataFrame, share: float, within: list[str], seed: int) -> list[tuple]:
    """Keys that part `rows` (or each group `within` them) into runs of about `share` of their weights."""
    chance = F.col("weight") * (DRAWS / share)
    drawn = rows.filter(F.rand(seed) < chance).withColumn("drawn", F.greatest(chance, F.lit(1.0)))
    upto = F.sum("drawn").over(W.partitionBy(*within).orderBy(*KEY))
    cuts = drawn.withColumn("upto", upto).filter(
        F.floor(F.col("upto") / DRAWS) > F.floor((F.col("upto") - F.col("drawn")) / DRAWS)).select(*KEY)
    return [tuple(r) for r in cuts.collect()]


def _ranged(rows: DataFrame, n: int, total: int, ranges: int) -> tuple[DataFrame, list[tuple]]:
    """The rows with the number of their range, after overfull ranges have been divided; and boundaries."""
    # Half a row's weight is its share of the bytes, half that of the rows.
    rows = rows.withColumn("weight", F.col("size") / (2.0 * total) + 0.5 / max(n, 1))
    share = 1 / ranges
    boundaries = sorted(set(_quantiles(rows, share, [], 1)))
    for seed in count(2):
        out = rows.withColumn("range", _range_of(boundaries))
        full = (out.groupBy("range").agg(F.sum("weight").alias("held"), F.count("*").alias("rows"))
                .filter((F.col("held") > 2 * share) & (F.col("rows") > 1)).select("range"))
        found = set(boundaries).union(_quantiles(out.join(full, "range", "left_semi"), share / 2, ["range"], seed))
        if len(found) == len(boundaries):
            return out.drop("weight"), boundaries
        boundaries = sorted(found)
    raise AssertionError


def _placed(texts: list[tuple[int, int]], total: int, shards: int) -> tuple[list[tuple[int, int]], list[int]]:
    """(text, shard) of the texts, and where the shards of the others end among their bytes."""
    load, where = [(0, s) for s in range(shards)], []
    for size, k in sorted(((b, k) for k, b in texts), reverse=True):
        held, s = heapq.heappop(load)
        where.append((k, s))
        heapq.heappush(load, (held + size, s))
    held = [b for b, _ in sorted(load, key=lambda x: x[1])]
    # The level to which the others fill up the shards: over the emptiest ones that it reaches.
    rest, low = total - sum(held), sorted(held)
    reached = next(m for m in range(shards, 0, -1) if rest + sum(low[:m]) >= m * low[m - 1])
    level = (rest + sum(low[:reached])) / reached
    return where, [int(x) for x in accumulate(max(0.0, level - b) for b in held)]


def _listed(rows: DataFrame, values: list[tuple], ddl: str) -> DataFrame:
    """A bounded list as a table."""
    names = [c.split()[0] for c in ddl.split(", ")]
    kind = "array<struct<" + ",".join(c.replace(" ", ":") for c in ddl.split(", ")) + ">>"
    text = json.dumps([dict(zip(names, v)) for v in values])
    return rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def sharded(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): slots count from 0 in each shard, without gaps."""
    rows = _measured(docs, doc_id, text)
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(1))).first()
    ranged, boundaries = _ranged(rows, n, total, max(shards * RANGES_PER_SHARD, n // ROWS_PER_RANGE))
    large = rows.groupBy("k").agg(F.sum("size").alias("b")).filter(
        (F.col("b") * (PARTS * shards) >= total) & (F.col("b") * shards <= total))
    where, ends = _placed([tuple(r) for r in large.collect()], total, shards)

    ranged = ranged.join(F.broadcast(_listed(rows, where, "k bigint, own int")), "k", "left")
    streamed = F.when(F.col("own").isNull(), F.col("size")).otherwise(F.lit(0))
    ranged = ranged.withColumn("flow", streamed)
    sizes = ranged.groupBy("range").agg(F.sum("flow").alias("bytes"))
    before = sizes.select("range", (F.sum("bytes").over(W.orderBy("range")) - F.col("bytes")).alias("start"))
    ordered = W.partitionBy("range").orderBy(*KEY)
    offset = F.sum("flow").over(ordered.rowsBetween(W.unboundedPreceding, 0)) - F.col("flow")
    placed = cut_lineage(ranged.withColumn("offset", offset).join(before, "range").withColumn(
        "offset", F.col("start") + F.col("offset")).withColumn(
        "middle", F.min("offset").over(W.partitionBy("range", "k")) + F.expr("sum(flow) OVER (PARTITION BY range, k) div 2")))
    # A text whose rows a boundary parts has its middle over all its ranges, unless it is larger than a shard.
    cut = F.broadcast(_listed(rows, sorted({b[:1] for b in boundaries}), "k bigint"))
    parted = placed.join(cut, "k", "left_semi").groupBy("k").agg(
        F.min("offset").alias("first"), F.sum("flow").alias("flowing"))
    at = F.when(F.col("first").isNull(), F.col("middle")).when(
        F.col("flowing") * shards > total, F.expr("offset + size div 2")).otherwise(F.expr("first + flowing div 2"))
    filled = F.array(*(F.lit(e).cast("long") for e in ends[:-1])) if shards > 1 else F.array().cast("array<bigint>")
    at_shard = F.size(F.filter(filled, lambda e: e <= F.col("at")))
    placed = (placed.join(F.broadcast(parted), "k", "left").withColumn("at", at)
              .withColumn("shard", F.coalesce("own", at_shard).cast("int"))
              .select("range", "shard", *KEY, "doc_id", "size", "text_crc32"))
    counted = placed.groupBy("shard", "range").agg(F.count("*").alias("rows"))
    earlier = counted.select("shard", "range", (F.sum("rows").over(
        W.partitionBy("shard").orderBy("range")) - F.col("rows")).alias("earlier"))
    own = F.row_number().over(W.partitionBy("range", "shard").orderBy(*KEY)) - 1
    return placed.withColumn("slot", own).join(earlier, ["range", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("earlier") + F.col("slot")).alias("slot"))
