"""SimHash near-duplicates: fingerprints, compared exactly tile by tile.

A fingerprint bit is set if it is set in over half of the hashes of a text's word shingles. Equal
fingerprints are one class from the start, so copies, however many, cost one row. Different ones
link if at most `radius` bits differ.

Tiles. Cut the 64 bits into `radius` + 2 blocks: two fingerprints within the radius agree on two
blocks at least. So each fingerprint goes to the tiles of its pairs of blocks, and every linked pair
meets in one. There, sorted by the number of set bits, rows are compared by numpy exclusive-or
and bit counts; tile pairs whose bit counts lie further apart than the radius are skipped, since
that many bits differ at least. A block pair shared by more than `TILE_ROWS` fingerprints is dealt
to slices, and the pairs of slices to different tasks, each of which holds two slices.

A task hands on a spanning forest of what it has found, not the pairs, and `components` joins the
forests.

Defined results for odd input: null and wordless texts have fingerprint zero and are linked like any
other; repeated rows get one result each; rows whose id is null take part, and their component's id
is null only if no member has one; texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.texts import free_name, giving_back, pieces, values
from terrace.session import cut_lineage
from pyspark.sql.types import LongType, StructField, StructType

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of one tile; and rows compared at once within it.
TILE_ROWS = 16_384
STRIP = 512
#: Groups up to this size are compared together, neighbour by neighbour.
SMALL = 32


def _hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # on ASCII white space, as bytes
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(joined, SEED)]
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [digest(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])]


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    found = [_hashes(t, shingle) for t in texts]
    out = np.zeros(len(texts), np.uint64)
    size = np.fromiter(map(len, found), np.int64, len(found))
    has = np.flatnonzero(size)
    if len(has):
        hashes = np.fromiter((h for own in found for h in own), np.uint64, int(size.sum()))
        starts = (np.cumsum(size) - size)[has]
        votes = np.empty((len(has), 64), np.int64)
        for k in range(8):  # a byte at a time keeps the unpacked bits small
            bits = np.unpackbits(hashes.view(np.uint8)[k::8, None], axis=1, bitorder="little")
            votes[:, 8 * k:8 * k + 8] = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[has] = np.packbits(2 * votes > size[has, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprinted(docs: DataFrame, text: str = "text", into: str = "fingerprint",
                  shingle: int = SHINGLE) -> tuple[DataFrame, str]:
    """`docs` with the fingerprints as signed 64-bit integers; and that column's name."""
    into, names = free_name(docs, into), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found = fingerprints(values(batch.column(text)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, LongType())])), into


def _masks(radius: int) -> list[int]:
    """For each pair of blocks, the mask of their bits, as a signed integer."""
    count = radius + 2
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(a | b) for a, b in combinations(blocks, 2)]


def _tiles(prints: DataFrame, radius: int, limit: int) -> DataFrame:
    """(block pair, value, two slices, fingerprint): each fingerprint in every tile it belongs to."""
    routed = prints.select("print", F.explode(F.array(*(
        F.struct(F.lit(i).alias("blocks"), F.col("print").bitwiseAND(F.lit(m)).alias("value"))
        for i, m in enumerate(_masks(radius))))).alias("t")).select("print", "t.*")
    full = (routed.groupBy("blocks", "value").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
            .withColumn("slices", F.ceil(F.col("n") / (limit // 2)).cast("int")))
    known = routed.join(full, ["blocks", "value"], "left")
    own = F.pmod(F.xxhash64("print"), F.col("slices")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda other: F.struct(
        F.least(own, other).alias("s1"), F.greatest(own, other).alias("s2")))
    alone = F.array(F.struct(F.lit(0).alias("s1"), F.lit(0).alias("s2")))
    return known.select("blocks", "value", "print", F.explode(
        F.when(F.col("slices").isNull(), alone).otherwise(pairs)).alias("p")).select(
        "blocks", "value", "p.s1", "p.s2", "print")


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of `i` and `j`, pair by pair; a label is the smallest member's place."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def forest(group: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Places of linked rows' smallest partners within a group (its number, sorted)."""
    bits = np.bitwise_count(prints).astype(np.int64)
    order = np.lexsort((prints, bits, group))
    group, prints, bits = group[order], prints[order], bits[order]
    label = np.arange(len(prints))
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(starts, len(group)))
    i = np.flatnonzero(np.repeat(size <= SMALL, size))
    step = 1
    while len(i):
        i = i[i + step < len(prints)]
        i = i[(group[i + step] == group[i]) & (bits[i + step] - bits[i] <= radius)]
        near = np.bitwise_count(prints[i] ^ prints[i + step]) <= radius
        _merge(label, i[near], i[near] + step)
        step += 1
    for start, n in zip(starts[size > SMALL].tolist(), size[size > SMALL].tolist()):
        for a in range(start, start + n, STRIP):
            a_end = min(a + STRIP, start + n)
            for b in range(a, start + n, STRIP):
                if bits[b] - bits[a_end - 1] > radius:
                    break  # sorted by bit count: later tiles lie further off
                b_end = min(b + STRIP, start + n)
                x, y = np.nonzero(np.bitwise_count(
                    prints[a:a_end, None] ^ prints[None, b:b_end]) <= radius)
                _merge(label, x + a, y + b)
    out = np.empty(len(order), np.int64)
    out[order] = order[label]
    return out


def _compare(radius: int):
    def linked(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        keys = [rows.column(c).to_numpy() for c in ("blocks", "value", "s1", "s2")]
        prints = rows.column("print").to_numpy().view(np.uint64)
        new = np.zeros(len(prints), bool)
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        root = forest(np.cumsum(new), prints, radius)
        found = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([
            pa.array(prints[found].view(np.int64)), pa.array(prints[root[found]].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile; whole tiles are compared as they are complete."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch]).combine_chunks()
            last = rows.slice(rows.num_rows - 1).drop_columns("print").to_pylist()[0]
            same = np.ones(rows.num_rows, bool)
            for key, value in last.items():
                same &= rows.column(key).to_numpy() == value
            cut = int(np.argmax(same))
            if cut:
                yield linked(rows.slice(0, cut).to_batches())
            held = rows.slice(cut).to_batches()
        if held:
            yield linked(held)

    return run


def links(prints: DataFrame, column: str, radius: int = RADIUS, limit: int = TILE_ROWS) -> DataFrame:
    """(a, b): links that span each component of the different fingerprints in `column`."""
    tiles = _tiles(prints.select(F.col(column).alias("print")), radius, limit)
    return (tiles.repartition("blocks", "value", "s1", "s2")
            .sortWithinPartitions("blocks", "value", "s1", "s2")
            .mapInArrow(giving_back(_compare(radius)), "a long, b long"))


def _members(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int,
             limit: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fingerprint) of every row; (fingerprint, root, component_id) of every fingerprint."""
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    marked, _ = fingerprinted(plain, shingle=shingle)
    marked = cut_lineage(marked.select("doc_id", "fingerprint"))
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes, "fingerprint", radius, limit), "a", "b")
    # Linked classes take their component's smallest id; the rest keep their own.
    known = classes.join(roots, classes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    named = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked, known.join(named, "root").select("fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, limit: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the smallest id names the component."""
    marked, prints = _members(docs, doc_id, text, shingle, radius, limit)
    return marked.join(prints, "fingerprint").select("doc_id", "fingerprint", "component_id")


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                  radius: int = RADIUS, limit: int = TILE_ROWS) -> DataFrame:
    """The row with the smallest id of each component, with the columns it came with.

    Rows that repeat that id count as one document, of which one row stays. Of a component without
    any id, one row stays.
    """
    _, prints = _members(docs, doc_id, text, shingle, radius, limit)
    own, first = F.col(f"`{doc_id}`"), free_name(docs, "first_id")
    stay = prints.filter("component_id IS NOT NULL").select(F.col("component_id").alias(first)).distinct()
    named = docs.join(stay, own == F.col(first)).dropDuplicates([first]).select(docs.columns)
    nameless, print_ = fingerprinted(docs.filter(own.isNull()), text, shingle=shingle)
    alone = prints.filter("component_id IS NULL").select(
        F.col("fingerprint").alias(first), F.col("root").alias(f"{first}_root"))
    return named.unionByName(
        nameless.join(alone, F.col(print_) == F.col(first)).dropDuplicates([f"{first}_root"]).select(docs.columns))
