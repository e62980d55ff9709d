"""Hard-negative mining with exact integer scores, by matrix products in a residue number system.

Vectors are scaled and floored to integers. Their inner products are taken modulo several small
primes: residues lie around zero, so small that a float32 matrix product of a panel of dimensions is
exact; Chinese remaindering puts the residues of a score together. There are as many primes as the
longest two vectors ask for, by Cauchy and Schwarz.

Anchors meet all rows in blocks: a block of anchors of at most `BLOCK_BYTES` is sent to the tasks,
each of which runs over its rows tile by tile and keeps the best few of each anchor; the tasks' best
are then ranked together. A first pass, between rows of equal label, finds the positives; a second one
finds, for each positive, the best rows of other labels whose scores lie in its window.

Defined results for odd input: rows with a null label, a null vector, or a null or non-finite
component take no part; vectors of different lengths are filled up with zeros; rows without an id
come last among equal scores and are never anchors; repeated rows are rows of their own, also as
anchors; an empty table gives no rows; other columns are not read. Vectors whose squared
length is 2**50 or more are refused with an error: remainders would not fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.session import cut_lineage

#: Bytes of components in a block of anchors: what is sent to the tasks at a time.
BLOCK_BYTES = 8 << 20
#: Scores that a task holds at once.
TILE = 1 << 20
#: Dimensions multiplied at once; float32 holds sums of products up to 2**24 exactly.
PANEL = 512
EXACT = 1 << 24
LARGEST = 1 << 50
LAST_ID = (1 << 63) - 1
BEST = "anchor long, slot int, score long, id long, row long"


def primes(dims: int, bound: int) -> list[int]:
    """Primes, largest first, for panels of up to `dims` dimensions and scores of up to `bound`."""
    most = int((EXACT / max(1, min(dims, PANEL))) ** 0.5)
    sieve = np.ones(2 * min(most, 1 << 12) + 2, bool)
    for n in range(2, int(len(sieve) ** 0.5) + 1):
        sieve[n * n::n] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve[3:])[::-1] + 3:
        if product > 2 * bound + 1:
            break
        out.append(int(p))
        product *= int(p)
    return out


def residues(vectors: np.ndarray, p: int) -> np.ndarray:
    """Whole numbers modulo an odd prime, from -(p - 1) / 2 to (p - 1) / 2."""
    rest = np.mod(vectors, p)
    return np.where(rest > p // 2, rest - p, rest).astype(np.float32)


def scores(left: list[np.ndarray], right: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact inner products from the residues of both sides, by Garner's mixed digits."""
    total, product = None, 1
    for a, b, p in zip(left, right, moduli):
        rest = np.zeros((len(a), len(b)), np.int64)
        for k in range(0, a.shape[1], PANEL):
            rest += (a[:, k:k + PANEL] @ b[:, k:k + PANEL].T).astype(np.int64)
        if total is None:
            total = np.mod(rest, p)
        else:
            total += np.mod((rest - total) % p * pow(product, -1, p), p) * product
        product *= p
    return np.where(total > product // 2, total - product, total)


def _first(query: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the first `keep` of each query: higher scores, then smaller ids, then rows."""
    order = np.lexsort((row, ids, -score, query))
    query = query[order]
    starts = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else order[:0]
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < keep]


class Best:
    """The first few rows of each query so far."""

    def __init__(self, queries: int, keep: int):
        self.keep, self.least = keep, np.full(queries, np.iinfo(np.int64).min)
        self.held = [np.zeros(0, np.int64)] * 4  # query, score, row, id

    def add(self, start: int, found: np.ndarray, allowed: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        """A tile: queries from `start` on by rows, with their scores and whether they count."""
        if not allowed.any():
            return
        least = self.least[start:start + len(found)]
        worst = np.iinfo(np.int64).min
        if found.shape[1] > self.keep:
            there = np.where(allowed, found, worst)
            tile = np.partition(there, -self.keep, axis=1)[:, -self.keep]
            allowed = allowed & (found >= np.maximum(least, tile)[:, None])
        else:
            allowed = allowed & (found >= least[:, None])
        query, at = np.nonzero(allowed)
        if not len(query):
            return
        new = [query + start, found[query, at], row[at], ids[at]]
        held = [np.concatenate(pair) for pair in zip(self.held, new)]
        kept = _first(*held, self.keep)
        self.held = [column[kept] for column in held]
        query, score = self.held[0], self.held[1]
        last = np.flatnonzero(np.append(query[1:] != query[:-1], True))
        full = np.bincount(query, minlength=len(self.least))[query[last]] == self.keep
        self.least[query[last[full]]] = score[last[full]]


def _rows(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple]:
    """(row, id, label, vectors) of each piece, with as many columns in `vectors` as `dims`."""
    step = max(1, TILE // max(dims, 1))
    for batch in batches:
        for k in range(0, batch.num_rows, step):
            part = batch.slice(k, step)
            lists = part.column("vector")
            size = np.asarray(pc.list_value_length(lists))
            flat = np.asarray(lists.flatten())
            vectors = np.zeros((len(size), dims))
            vectors[np.arange(dims) < size[:, None]] = flat
            yield (*(part.column(c).to_numpy() for c in ("row", "id", "label")), vectors)


def _search(block, dims: int, moduli: list[int], keep: int, same: bool, low: int, high: int):
    """A task's best rows for each query of a block: its anchors, or its anchors' positives.

    `block` broadcasts the anchors' (row, label, vectors, windows); a window is (anchor, slot,
    score): where `same` is unset, a row of another label counts if
    `low * score <= 100 * its score <= high * score`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, labels, vectors, (of, slot, reach) = block.value
        mine = [residues(vectors, p) for p in moduli]
        best = Best(len(of), keep)
        # Queries run anchor by anchor, so those of some anchors lie side by side.
        ends = np.searchsorted(of, np.arange(len(own) + 1))
        for row, ids, label, piece in _rows(batches, dims):
            if same:
                met = np.isin(label, labels)
                row, ids, label, piece = row[met], ids[met], label[met], piece[met]
            theirs = [residues(piece, p) for p in moduli]
            step = max(1, TILE // max(1, len(row)) // (1 if same else 5))
            for a in range(0, len(own) if len(row) else 0, step):
                b = min(a + step, len(own))
                found = scores([m[a:b] for m in mine], theirs, moduli)
                equal = labels[a:b, None] == label
                if same:
                    best.add(a, found, equal & (own[a:b, None] != row), row, ids)
                    continue
                query = slice(ends[a], ends[b])
                found, at = found[of[query] - a], reach[query, None]
                inside = (low * at <= 100 * found) & (100 * found <= high * at)
                best.add(ends[a], found, inside & ~equal[of[query] - a], row, ids)
        query, score, row, ids = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[of[query]]), pa.array(slot[query].astype(np.int32)), pa.array(score),
             pa.array(ids), pa.array(row)], ["anchor", "slot", "score", "id", "row"])
    return run


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    """The first `keep` of each query, numbered from 1."""
    order = W.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def prepared(rows: DataFrame, vec_id: str, label: Column, vector: str, scale: float) -> DataFrame:
    """(row, id, label, vector): the rows that take part, with whole-number vectors. Stored."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    parts = F.col(f"`{vector}`").cast("array<double>")
    return cut_lineage(rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(LAST_ID)).alias("id"),
        label.cast("long").alias("label"), parts.alias("vector"))
        .filter(F.col("label").isNotNull() & F.col("vector").isNotNull())
        .filter(F.forall("vector", sound))
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double"))))


def mined(rows: DataFrame, anchors: Column, vec_id: str = "vec_id", label: Column | None = None,
          vector: str = "embedding", scale: float = 256.0, positives: int = 5, negatives: int = 5,
          low: int = 80, high: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchors` is a condition on `id`. An anchor's positives are the first other rows of its label;
    for each, the first rows of other labels with `low` to `high` per cent of its score are returned.
    """
    spark = rows.sparkSession
    label = F.col("label") if label is None else label
    table = prepared(rows, vec_id, label, vector, scale)
    square = F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x)
    longest, dims = table.agg(F.max(square), F.max(F.size("vector"))).first()
    dims, bound = max(1, dims or 0), int((longest or 0) * (1 + 1e-9)) + 1
    if bound >= LARGEST:
        raise ValueError("components are too large for exact 64-bit scores")
    moduli = primes(dims, bound)
    asked = table.filter((F.col("id") != LAST_ID) & anchors)
    size = max(1, block_bytes // (8 * dims))
    count = asked.count()
    blocks = max(1, -(-count // size))
    # Anchors dealt to blocks by digest; a block's size then strays little from its share.
    numbered = cut_lineage(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")))

    kept = []
    for number in range(blocks):
        held = (numbered.filter(F.col("block") == number).select("row", "id", "label", "vector")
                .sort("row").toArrow().combine_chunks().to_batches())
        got = list(_rows(iter(held), dims))
        if not got:
            continue
        own, _, labels, vectors = (np.concatenate(c) for c in zip(*got))
        each = np.arange(len(own))
        block = spark.sparkContext.broadcast((own, labels, vectors, (each, 0 * each, 0 * each)))
        near = cut_lineage(_ranked(table.mapInArrow(
            _search(block, dims, moduli, positives, True, low, high), BEST), positives))
        windows = near.select("anchor", "rank", "score").sort("anchor", "rank").toPandas()
        of = np.searchsorted(own, windows["anchor"].to_numpy(np.int64))
        window = (of, windows["rank"].to_numpy(np.int64), windows["score"].to_numpy(np.int64))
        wide = spark.sparkContext.broadcast((own, labels, vectors, window))
        far = _ranked(table.mapInArrow(
            _search(wide, dims, moduli, negatives, False, low, high), BEST), negatives)
        pairs = far.join(
            near.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive"),
                        F.col("score").alias("reach")), ["anchor", "slot"])
        kept.append(cut_lineage(pairs))
        block.destroy()
        wide.destroy()
    if not kept:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    known = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    ids = numbered.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return reduce(DataFrame.unionByName, kept).join(ids, "anchor").select(
        "anchor_id", known("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        known("id").alias("negative_id"), F.col("reach").alias("positive_score"),
        F.col("score").alias("negative_score"))
