"""Removal of repeated byte strings by a distributed, sparse suffix array.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document of
smaller id, or in the same document. Strings are judged on the input, not on what is left.

**Suffixes.** Of the windows of `length` bytes, each names one byte run of `GRAM` bytes in it, the one
with the least hash (leftmost on ties); the suffix that starts there stands for the window. Equal
windows name the same run, so only suffixes that begin alike need to be compared, and only about
one position in thirty has a suffix. Neighbouring windows that name the same suffix are a stretch.

**Buckets.** Splitters are quantiles of the leading bytes of sampled suffixes (then of the run's hash); each
task deals its stretches to the ranges, and within a range to buckets by the run's hash. The sample has
some `DRAWN` suffixes for each of at most `RANGES` ranges, so what the driver sorts is bounded. Runs that the
sample meets in several different stretches are frequent: their stretches are dealt to all buckets by
their own hash, and their windows are compared as those of other hot beginnings, below.
In a bucket, suffixes are sorted. Stretches of equal bytes: all but the first go as a whole; a task
does that for its own stretches before it deals them, so copies, however many, meet once per task.
Where the suffixes of different stretches begin alike, the windows are sorted by their bytes with
a multikey quicksort, eight bytes at a time, of which only ties go on to the next eight; in a run of
equal windows all but the first go. Ranges are cut between different runs, and a beginning that
more than `HOT` different stretches share is spread over tasks by the hash of whole windows, so
equal strings always meet: those are the comparisons over a bucket's boundary.

Hashes of 64 bits (128 for whole windows that are spread) stand for stretches of equal bytes.

Defined results for odd input: null and empty texts have nothing to remove; texts shorter than
`length` stay whole; null ids come last; rows that repeat an id and a text are one document and get
the same result each; different texts under one id are ordered by a 64-bit hash, which tells them apart; texts are compared
whole and as UTF-8 bytes, so a cut may fall inside a character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.texts import free_name, giving_back, pieces, utf8
from terrace.session import cut_lineage

LENGTH = 100
GRAM = 32
#: Ranges at most, suffixes drawn for each on average, and documents from which these come, at least.
RANGES = 4096
DRAWN = 200
SAMPLED = 400
#: Different stretches of a run in the sample that make it frequent.
FREQUENT = 8
#: Bytes of text for each bucket.
BUCKET_BYTES = 12 << 20
#: Stretches with one beginning that a task compares; more are spread by whole windows.
HOT = 4096
#: Bytes of text within which a task sets its own repeats aside before it deals the rest.
DEALT_BYTES = 2 << 20
#: Rows that a task remembers, to cut the bytes of repeated ones once.
REMEMBERED = 100_000
#: Bytes of one text that are looked at together.
SEGMENT = 8 << 20
_PLACE = np.uint64((1 << 24) - 1)  # a place within a piece, which is shorter than 16 MB
LAST_ID = (1 << 63) - 1


def _eights(data: np.ndarray, order: str = "<u8") -> np.ndarray:
    """The eight bytes from every place on, as integers."""
    return np.ndarray((max(0, len(data) - 7),), order, np.ascontiguousarray(data), strides=(1,))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words, n = _eights(data), len(data) - GRAM + 1
    found = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        found ^= words[k:k + n]
        found *= np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ found >> np.uint64(29)


def stretches(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(suffix, first window, last window) as places in `data`, which holds texts from `at` to `at`."""
    none = np.zeros(0, np.int64)
    starts = np.zeros(len(data) + 1, np.int32)
    long = np.diff(at) >= length
    if not long.any():
        return none, none, none
    np.add.at(starts, at[:-1][long], 1)
    np.add.at(starts, at[1:][long] - length + 1, -1)
    key = _gram_hashes(data) & ~_PLACE | np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    width, grams = 1, length - GRAM + 1
    while 2 * width <= grams:  # least of twice as many neighbours each time
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if rest := grams - width:
        key = np.minimum(key[:-rest], key[rest:])
    window = np.flatnonzero(np.cumsum(starts)[:len(key)] > 0)
    suffix = (key[window] & _PLACE).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (suffix[1:] != suffix[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    return suffix[first], window[first], window[np.append(first[1:], len(window)) - 1]


def _segments(at: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first byte, its place in its text, texts' ends): all texts at once, or one text in parts."""
    if at[-1] <= SEGMENT:
        yield 0, 0, at
        return
    for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
        for part in range(start, max(end - length + 1, start + 1), SEGMENT):
            yield part, part - start, np.array([0, min(part + SEGMENT + length - 1, end) - part])


def _stretch_rows(batch: pa.RecordBatch, length: int) -> dict[str, np.ndarray]:
    """The stretches of a piece: leading bytes, hashes of run and bytes, document and place."""
    data, ends = utf8(batch.column("text"))
    out: list[dict] = []
    for start, shift, at in _segments(ends, length):
        part = data[start:start + at[-1]]
        suffix, first, last = stretches(part, at, length)
        if not len(suffix):
            continue
        if len(ends) == len(at):
            doc = np.searchsorted(at, suffix, side="right") - 1
            offset = at[doc]
        else:
            doc = np.full(len(suffix), np.searchsorted(ends, start, side="right") - 1)
            offset = np.full(len(suffix), -shift)
        whole, digest = part.tobytes(), xxhash.xxh3_64_intdigest
        out.append({
            "lead": _eights(part, ">u8")[suffix].astype(np.uint64),
            "run": np.array([digest(whole[a:a + GRAM]) for a in suffix.tolist()], np.uint64),
            "bytes": np.array([digest(whole[a:b]) for a, b in
                               zip(first.tolist(), (last + length).tolist())], np.uint64),
            "row": doc, "place": (suffix - offset) << 14 | (suffix - first) << 7 | (last - first)})
    names = ("lead", "run", "bytes", "row", "place")
    return {n: np.concatenate([o[n] for o in out]) if out else np.zeros(0, np.int64) for n in names}


def _as_before(columns: Iterable[np.ndarray]) -> np.ndarray:
    """Which rows equal the row before in all columns."""
    columns = list(columns)
    same = np.zeros(len(columns[0]), bool)
    same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return same


def _later(keys: list[np.ndarray], order: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by `keys` then `order`; and which of them repeat the keys of the one before.

    Those that agree in all of it are one place of a repeated row, and only the first is given.
    """
    by = np.lexsort([*reversed(order), *reversed(keys)])
    by = by[~_as_before(x[by] for x in (*keys, *order))]
    return by, _as_before(k[by] for k in keys)


def _windows(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = (place >> 14) - (place >> 7 & 127)
    return first, first + (place & 127)


def _deal(length: int, splitters: np.ndarray, frequent: np.ndarray, buckets: int):
    subs = np.uint64(max(1, buckets // (len(splitters) + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", DEALT_BYTES):
            doc, tie = batch.column("doc").to_numpy(), batch.column("tie").to_numpy()
            rows = _stretch_rows(batch, length)
            row = rows["row"]
            by, again = _later([rows["run"], rows["bytes"]], [doc[row], tie[row], rows["place"]])
            gone, own = by[again], by[~again]
            key = np.stack([rows["lead"][own].astype(">u8"), rows["run"][own].astype(">u8")], axis=1)
            bucket = np.searchsorted(splitters, np.ascontiguousarray(key).view("S16")[:, 0], side="right")
            bucket = bucket * int(subs) + (rows["run"][own] % subs).astype(np.int64)
            bucket = np.where(np.isin(rows["run"][own], frequent), rows["bytes"][own] % np.uint64(buckets), bucket)
            first, last = _windows(rows["place"][gone])
            order = np.lexsort((first, row[gone]))
            r, first, last = row[gone][order], first[order], last[order]
            apart = np.ones(len(r), bool)
            apart[1:] = (r[1:] != r[:-1]) | (first[1:] > last[:-1] + 1)
            head = np.flatnonzero(apart)
            last = last[np.append(head[1:], len(r))[:len(head)] - 1]
            r, first = r[head], first[head]
            keep, went = len(own), len(head)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([bucket, first % buckets]).astype(np.int32)),
                pa.array(np.repeat([False, True], [keep, went])),
                pa.array(np.concatenate([rows["run"][own].view(np.int64), first])),
                pa.array(np.concatenate([rows["bytes"][own].view(np.int64), last])),
                pa.array(doc[np.concatenate([row[own], r])]), pa.array(tie[np.concatenate([row[own], r])]),
                pa.array(np.concatenate([rows["place"][own], np.zeros(went, np.int64)]))],
                ["bucket", "gone", "run", "bytes", "doc", "tie", "place"])
    return run


def _settle(hot: int, frequent: np.ndarray):
    """In a bucket: which stretches go as a whole, and which must be compared by their bytes.

    A frequent run's other stretches lie in other buckets, so all of its stretches are compared.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns[1:]] for b in batches if b.num_rows]
        if not held:
            return
        held = [list(column) for column in zip(*held)]
        gone, run_, bytes_, doc, tie, place = (np.concatenate(held.pop(0)) for _ in range(6))
        own = np.flatnonzero(~gone)
        by, again = _later([run_[own], bytes_[own]], [doc[own], tie[own], place[own]])
        by = own[by]
        leader = by[~again]
        new = np.ones(len(leader), bool)
        new[1:] = run_[leader][1:] != run_[leader][:-1]
        number = np.cumsum(new) - 1
        variants = np.bincount(number)[number] if len(leader) else number
        spread = np.isin(run_[leader].view(np.uint64), frequent)
        variants = np.where(spread, hot + 1, variants)
        asked = leader[variants > 1]
        first, last = _windows(place)
        first[gone], last[gone] = run_[gone], bytes_[gone]
        out = np.concatenate([by[again], np.flatnonzero(gone), asked])
        kind = np.concatenate([np.zeros(len(out) - len(asked), np.int32),
                               1 + (variants[variants > 1] > hot)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), *(pa.array(x[out]) for x in (doc, tie, first, last)),
             pa.array(np.where(kind > 0, place[out] >> 14, 0)), pa.array(np.where(kind > 0, run_[out], 0))],
            ["kind", "doc", "tie", "first", "last", "suffix", "run"])
    return run


def _contexts(length: int):
    """The bytes of stretches to be compared, cut from their documents.

    A task does that once for a repeated row, as far as it can remember the rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in pieces(batches, "text"):
            data, ends = utf8(batch.column("text"))
            whole, rows = data.tobytes(), []
            for start, doc, tie, asked in zip(ends.tolist(), batch.column("doc").to_pylist(),
                                              batch.column("tie").to_pylist(), batch.column("asked").to_pylist()):
                if (doc, tie) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add((doc, tie))
                for a in asked:
                    rows.append((doc, tie, a["first"], a["last"], a["suffix"], a["run"],
                                 whole[start + a["first"]:start + a["last"] + length]))
            kinds = (*[pa.int64()] * 6, pa.binary())
            names = ["doc", "tie", "first", "last", "suffix", "run", "context"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)], names)
    return run


def multikey_equal(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Numbers for windows: equal if the group and all `length` bytes from `start` are equal.

    A multikey quicksort whose characters are eight bytes: each round sorts, by the next eight,
    those that are still tied with another; groups that agree throughout need no sorting.
    """
    words, number = _eights(np.append(data, np.zeros(8, np.uint8)), ">u8"), group.copy()
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 and length >= 8 else [])]
    tied = np.arange(len(start))
    for step in steps:
        order = tied[np.argsort(number[tied], kind="stable")]
        new = np.ones(len(order), bool)
        new[1:] = number[order][1:] != number[order][:-1]
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(order)))
        order, size = order[np.repeat(size > 1, size)], size[size > 1]
        if not len(order):
            break
        head = np.cumsum(size) - size
        word = words[start[order] + step]
        differs = np.add.reduceat(word != np.repeat(word[head], size), head) > 0
        mixed = np.repeat(differs, size)
        split = order[mixed]
        by = np.lexsort((word[mixed], number[split]))
        split, word = split[by], word[mixed][by]
        new = np.ones(len(split), bool)
        new[1:] = (number[split][1:] != number[split][:-1]) | (word[1:] != word[:-1])
        number[split] = number.max() + np.cumsum(new)
        tied = np.concatenate([order[~mixed], split])
    return number


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges: the range each member is in, and the member."""
    size = last - first + 1
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + first[row]


def _joined(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring members as (row, first, last)."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    return row[head], at[head], at[np.append(head[1:], len(row))[:len(head)] - 1]


def _compare(length: int):
    def settled(rows: pa.Table) -> pa.RecordBatch:
        doc, tie, first, last, suffix, run_ = (
            rows.column(c).to_numpy() for c in ("doc", "tie", "first", "last", "suffix", "run"))
        by = np.lexsort((first, tie, doc))  # then a smaller place in the list is an earlier one
        data, ends = utf8(rows.column("context"))
        by = by[~_as_before(x[by] for x in (doc, tie, first, last, run_))]  # repeated rows of other tasks
        doc, tie, first, last, suffix, run_ = (x[by] for x in (doc, tie, first, last, suffix, run_))
        row, window = _expand(first, last)
        _, run_ = np.unique(run_, return_inverse=True)
        group = run_[row] * length + (suffix[row] - window)
        number = multikey_equal(data, ends[:-1][by][row] + window - first[row], group, length)
        order = np.argsort(number, kind="stable")
        again = np.zeros(len(order), bool)
        again[order[1:]] = number[order[1:]] == number[order[:-1]]
        row, a, b = _joined(row[again], window[again])
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (doc[row], tie[row], a, b)], ["doc", "tie", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by run; whole runs are compared as soon as enough are there."""
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= 2 * HOT:
                rows = pa.Table.from_batches(held).combine_chunks()
                run_ = rows.column("run").to_numpy()
                cut = int(np.searchsorted(run_, run_[-1]))
                if cut:
                    yield settled(rows.slice(0, cut).combine_chunks())
                held, count = rows.slice(cut).to_batches(), len(run_) - cut
        if count:
            yield settled(pa.Table.from_batches(held).combine_chunks())
    return run


def _spread(length: int):
    """The windows of stretches with a frequent beginning, by the hash of their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in pieces(batches, "context", 1 << 20):
            first, last = (batch.column(c).to_numpy() for c in ("first", "last"))
            row, window = _expand(first, last)
            each = batch.column("context").to_pylist()
            found = [digest(each[r][k:k + length]) for r, k in zip(row.tolist(), (window - first[row]).tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(found, pa.binary()), pa.array(batch.column("doc").to_numpy()[row]),
                pa.array(batch.column("tie").to_numpy()[row]), pa.array(window)],
                ["said", "doc", "tie", "first"])
    return run


def _splitters(docs: DataFrame, length: int, buckets: int, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of (leading bytes, run's hash) over different sampled stretches; and the frequent runs."""
    ranges = min(buckets, RANGES)
    share = min(1.0, max(SAMPLED, 8 * ranges) / max(total, 1))
    # About every thirtieth byte has a suffix.
    chance = min(1.0, DRAWN * ranges / max(share * size / 30, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = _stretch_rows(batch, length)
            some = np.random.default_rng(len(rows["run"])).random(len(rows["run"])) < chance
            key = np.stack([rows[c][some].astype(">u8") for c in ("lead", "run", "bytes")], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in key], pa.binary())], ["key"])

    part = docs.sample(share, seed=7).mapInArrow(run, "key binary").distinct()
    drawn = np.array(sorted(part.toArrow().column("key").to_pylist()), "S24")
    key = drawn.view("S8").reshape(-1, 3) if len(drawn) else np.zeros((0, 3), "S8")
    cuts = drawn[[len(drawn) * i // ranges for i in range(1, ranges)]].tolist() if len(drawn) else []
    splitters = np.array(sorted({c.ljust(24, b"\0")[:16] for c in cuts}) or [b"\xff" * 16], "S16")
    run_, often = np.unique(key[:, 1].copy().view(">u8").astype(np.uint64), return_counts=True)
    return splitters, run_[often >= FREQUENT]


def _known(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tie, text, row): what a document is known by, its text, and its other columns."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(said).alias("tie"), said.alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row"))


def _repeated(known: DataFrame, length: int, buckets: int | None, hot: int) -> DataFrame:
    """(doc, tie, runs): for documents with repeats, the windows to remove as (first, last) ranges.

    `known` is joined with all its columns here and by the caller, so that Spark shuffles it once.
    """
    texts = known.select("doc", "tie", "text")
    long = texts.filter(F.octet_length("text") >= length)
    total, size = texts.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    buckets = buckets or max(16, (size or 0) // BUCKET_BYTES + 1)
    splitters, frequent = _splitters(long, length, buckets, total, size or 0)
    dealt = long.mapInArrow(
        _deal(length, splitters, frequent, buckets),
        "bucket int, gone boolean, run long, bytes long, doc long, tie long, place long")
    settled = cut_lineage(dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(
        giving_back(_settle(hot, frequent)), "kind int, doc long, tie long, first long, last long, suffix long, run long"))

    def contexts(kind: int) -> DataFrame:
        asked = settled.filter(F.col("kind") == kind).groupBy("doc", "tie").agg(
            F.collect_list(F.struct("first", "last", "suffix", "run")).alias("asked"))
        return known.join(asked, ["doc", "tie"]).mapInArrow(
            _contexts(length), "doc long, tie long, first long, last long, suffix long, run long, "
            "context binary")

    compared = (contexts(1).repartition("run").sortWithinPartitions("run")
                .mapInArrow(giving_back(_compare(length)), "doc long, tie long, first long, last long"))
    found = settled.filter("kind = 0").select("doc", "tie", "first", "last").unionByName(compared)
    if not settled.filter("kind = 2").isEmpty():
        spread = contexts(2).mapInArrow(_spread(length), "said binary, doc long, tie long, first long")
        at = F.struct("doc", "tie", "first")
        earliest = spread.groupBy("said").agg(F.min(at).alias("earliest"))
        found = found.unionByName(spread.join(earliest, "said").filter(at > F.col("earliest")).select(
            "doc", "tie", "first", F.col("first").alias("last")))
    return found.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def _spans(runs: list[dict] | None, length: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in runs or ()):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + length))
        else:
            out.append((first, last + length))
    return out


def _kept(length: int, as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, ends = utf8(batch.column("text"))
            whole, spans, left = data.tobytes(), [], []
            for start, end, runs in zip(ends.tolist(), ends[1:].tolist(), batch.column("runs").to_pylist()):
                own = _spans(runs, length)
                at, kept = start, []
                for a, b in own:
                    kept.append(whole[at:start + a])
                    at = start + b
                spans.append([{"first": a, "past": b} for a, b in own])
                parts = [*kept, whole[at:end]]
                left.append("".join(p.decode(errors="ignore") for p in parts) if as_text else b"".join(parts))
            yield pa.RecordBatch.from_arrays([
                batch.column("row"),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                pa.array(left, pa.string() if as_text else pa.binary())], ["row", "spans", "kept"])
    return run


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                 buckets: int | None = None, hot: int = HOT, as_text: bool = False) -> DataFrame:
    """(row, spans, kept): each row of `docs`, the removed byte ranges, and the bytes that are left.

    `row` is a struct of all columns but the text. Ranges are (first byte, past the last). With
    `as_text`, what is left is a string, without the characters that a cut has gone through.
    """
    if not GRAM < length < GRAM + 128:
        raise ValueError(f"length must be between {GRAM + 1} and {GRAM + 127}")
    known = _known(docs, doc_id, text)
    found = known.join(_repeated(known, length, buckets, hot), ["doc", "tie"], "left")
    kind, left = known.schema["row"].dataType.simpleString(), "string" if as_text else "binary"
    return found.mapInArrow(
        _kept(length, as_text), f"row {kind}, spans array<struct<first:bigint,past:bigint>>, kept {left}")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars",
                    **options) -> DataFrame:
    """`docs` with repeats cut out of the texts, and a cut text's length in `chars`, if it is a column.

    A null text stays null.
    """
    null = free_name(docs, "was_null")
    done = deduplicated(docs.withColumn(null, F.col(f"`{text}`").isNull()), doc_id, text,
                        as_text=True, **options)
    new = {c: F.col("row")[c] for c in docs.columns if c != text}
    new[text] = F.when(~F.col("row")[null], F.col("kept"))
    if chars in new:
        new[chars] = F.when(F.size("spans") > 0, F.length("kept")).otherwise(new[chars])
    return done.select(*(new[f.name].cast(f.dataType).alias(f.name) for f in docs.schema.fields))
