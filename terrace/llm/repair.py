"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation is repaired by a shortest path. A node is (rows read, place in the pattern of roles);
an edge keeps, reroles or deletes a row or inserts an empty one. A path's weight is one big integer: its
high digits carry the cost, its low ones, of fixed width, the letters of its edits, the first letter
highest and zeros after the last; so the least integer is the cheapest path and, among those, the one
whose letters come first, and nothing else decides. Long conversations run block by block: the place
of a path's letters among those of the other open paths is one more digit, above the block's own.

What is edited are rows in the order of (turn, role, digest of the text), null turns first. Only (turn,
role, digest, marks) go to the path search, equal rows added up before; whole texts are shuffled
once, beside the edits found, and hashed as they stream by. So a task holds no conversation's texts:
of one with a third of all rows it holds a byte a row, and its edits.

Defined results for odd input: a null turn, role, text or conversation id counts as one space where
text is asked for, and null ids are one conversation; a row whose role has no legal first letter, or
no letter at all, is reroled or deleted; rows of one turn that are equal stay side by side; a row's own texts
may be of any length; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Digits of the letters, in their order.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = str.maketrans("1234", "DIKR")
BITS = 3
#: Rows of a block: a path's letters within it are one integer of at most three digits a row.
BLOCK = 64
#: Places in the pattern `(s?(ua)+)?`: before it, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NAME = {"u": "user", "a": "assistant"}
#: A row as a byte: its role's initial, in upper case if truncated; '-' if it has to go, 'o' and 'O' if
#: the initial isn't legal.
MUST_GO = "-"


def _block(rows: str, ranks: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int, int, str]]:
    """Least paths over some rows, from each open place: {place: (cost, rank so far, from, letters)}.

    `ranks` has the cost and the rank of the best path to each place; every path ends with a row, so
    two of equal cost are never the beginning of one another.
    """
    width = 3 * len(rows)
    rank_at, cost_at = BITS * width, BITS * width + BITS
    step = lambda cost, letter, used: (cost << cost_at) + (DIGIT[letter] << BITS * (width - 1 - used))
    best = {q: ((cost << cost_at) + (rank << rank_at), 0, q) for q, (cost, rank) in ranks.items()}

    def offer(to: dict, q: int, path: tuple) -> None:
        if q not in to or path < to[q]:
            to[q] = path
    for row in rows:
        for _ in range(2):  # more inserts before a row come back to the same place and cost more
            for q, (w, used, came) in list(best.items()):
                offer(best, AFTER[q, NEXT[q]], (w + step(INSERT, "I", used), used + 1, came))
        after: dict[int, tuple] = {}
        role, extra = row.lower(), TRUNCATED if row.isupper() else 0
        for q, (w, used, came) in best.items():
            offer(after, q, (w + step(DELETE, "D", used), used + 1, came))
            if row == MUST_GO:
                continue
            if (q, role) in AFTER:
                offer(after, AFTER[q, role], (w + step(KEEP + extra, "K", used), used + 1, came))
            for target in NAME:
                if (q, target) in AFTER:
                    offer(after, AFTER[q, target], (w + step(REROLE + extra, "R", used), used + 1, came))
        best = after
    out = {}
    for q, (w, used, came) in best.items():
        letters = w & ((1 << rank_at) - 1)
        out[q] = (w >> cost_at, w & ((1 << cost_at) - 1), came,
                  f"{letters:0{width}o}"[:used].translate(LETTERS))
    return out


@lru_cache(1 << 14)
def _short(rows: str) -> tuple[int, str]:
    return _repair(rows, BLOCK)


def _repair(rows: str, block: int) -> tuple[int, str]:
    ranks, steps = {START: (0, 0)}, []
    for k in range(0, len(rows), block):
        found = _block(rows[k:k + block], ranks)
        steps.append({q: (came, letters) for q, (_, _, came, letters) in found.items()})
        order = sorted(found, key=lambda q: found[q][1])
        ranks = {q: (found[q][0], rank) for rank, q in enumerate(order)}
    # What is left to do after the last row: an assistant's row after a user's, two after a system's.
    ends = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    last = min(ranks, key=lambda q: (ranks[q][0] + INSERT * len(ends[q]), ranks[q][1]))
    cost, out, q = ranks[last][0] + INSERT * len(ends[last]), [ends[last]], last
    for found in reversed(steps):
        q, letters = found[q]
        out.append(letters)
    return cost, "".join(reversed(out))


def repair(rows: str, block: int = BLOCK) -> tuple[int, str]:
    """The cost and the letters of the cheapest edits for rows given as letters."""
    return _short(rows) if len(rows) <= BLOCK == block else _repair(rows, block)


def conversed(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, copies: Column) -> DataFrame:
    """(conv, turn, role, text, copies, digest, blank, truncated); nulls are a space but in conv and turn."""
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    out = rows.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        said(role).alias("role"), said(text).alias("text"), copies.cast("long").alias("copies"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return out.withColumns({
        "digest": F.unhex(F.sha2("text", 256)), "blank": last == "",
        "truncated": ~last.isin(".", "!", "?")})


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of rows of one conversation, as (is it new, conversation, rows): batch by batch."""
    first, now = True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.to_pylist()
        start = 0
        for i, row in enumerate(rows):
            if first or row["conv"] != now:
                if i > start:
                    yield False, now, rows[start:i]
                first, now, start = False, row["conv"], i
                yield True, now, []
        if len(rows) > start:
            yield False, now, rows[start:]


class _Found:
    """What is counted over a conversation's rows, in their order."""

    def __init__(self):
        self.rows = io.StringIO()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = self.least = self.most = self.before = None

    def add(self, row: dict) -> None:
        n = row["copies"]
        if not n:
            return
        initial = row["role"][:1]
        if row["turn"] is not None and row["turn"] != self.most:
            self.turns = (self.turns or 0) + 1
            self.least = row["turn"] if self.least is None else self.least
            self.most = row["turn"]
        legal = lambda a, b: a + b in ("su", "ua", "au")
        self.illegal += (self.before is not None and not legal(self.before, initial)) + (n - 1) * (
            not legal(initial, initial))
        self.before = initial
        if row["blank"]:
            self.blank += n
            self.rows.write(MUST_GO * n)
            return
        fresh = row["earliest"]
        self.duplicate += n - fresh
        self.truncated += fresh and row["truncated"]
        kept = initial if initial and initial in "sua" else "o"
        self.rows.write((kept.upper() if row["truncated"] else kept) * fresh + MUST_GO * (n - fresh))

    def result(self, conv) -> dict:
        cost, audit = repair(self.rows.getvalue())
        return {"conv": conv, "gaps": self.most - self.least + 1 - self.turns if self.turns else 0,
                "blank": self.blank, "duplicate": self.duplicate, "truncated": int(self.truncated),
                "illegal": self.illegal, "cost": cost, "audit": audit}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
FOUND = "conv long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation, from its narrow rows in their order."""
    schema = pa.schema([("conv", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
    out, held, found = [], None, None
    for new, conv, rows in _streams(batches):
        if new:
            if found:
                out.append(found.result(held))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
            held, found = conv, _Found()
        for row in rows:
            found.add(row)
    if found:
        out.append(found.result(held))
    yield pa.RecordBatch.from_pylist(out, schema)


class _Repaired:
    """A conversation after its edits, as a running hash of its rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START
        self.hash, self.rows = hashlib.sha256(), 0

    def _put(self, role: str, text: str) -> None:
        self.hash.update((f"\n{role}:" if self.rows else f"{role}:").encode())
        self.hash.update(text.encode())
        self.rows += 1

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._put(NAME[NEXT[self.place]], "")
            self.place = AFTER[self.place, NEXT[self.place]]
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        initial = role[:1] if edit == "K" else NEXT[self.place]
        self._put(role if edit == "K" else NAME[initial], text)
        self.place = AFTER[self.place, initial]

    def result(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's edits and the hash of what they make of its rows."""
    schema = pa.schema([("conv", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()),
                        ("repaired_sha256", pa.string()), ("rows", pa.int64())])
    out, known, made = [], None, None

    def finished() -> dict:
        return {**{c: known[c] for c in schema.names[:-2]}, "repaired_sha256": made.result(), "rows": made.rows}
    for _, _, rows in _streams(part for b in batches for part in _cut(b)):
        for row in rows:
            if row["audit"] is not None:  # stands before the conversation's rows
                if made:
                    out.append(finished())
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
                known, made = row, _Repaired(row["audit"])
            else:
                for _ in range(row["copies"]):
                    made.add(row["role"], row["text"])
    if made:
        out.append(finished())
    yield pa.RecordBatch.from_pylist(out, schema)


def _cut(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def repaired(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text", copies: Column | None = None) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, rows).

    One row for every conversation id. `copies` says how often a row stands there, next to itself;
    one that stands there 0 times has been dropped, but its conversation is returned.
    """
    table = conversed(rows, conv_id, turn, role, text, F.lit(1) if copies is None else copies)
    key = ["conv", "turn", "role", "digest"]
    narrow = table.groupBy(*key, "blank", "truncated").agg(F.sum("copies").alias("copies"))
    # Dropped rows count as never seen, so they come last among equal ones.
    seen = W.partitionBy("conv", "role", "digest").orderBy((F.col("copies") == 0), "turn")
    narrow = narrow.withColumn("earliest", (F.row_number().over(seen) == 1).cast("int"))
    edits = (narrow.repartition("conv").sortWithinPartitions(*key)
             .mapInArrow(_edits, FOUND))
    none = lambda kind: F.lit(None).cast(kind)
    found = edits.select("*", none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"),
                         none("binary").alias("digest"), none("long").alias("copies"), F.lit(0).alias("kind"))
    texts = table.filter("copies > 0").select(
        "conv", *(none("long").alias(c) for c in COUNTS), none("string").alias("audit"),
        "turn", "role", "text", "digest", "copies", F.lit(1).alias("kind"))
    return (found.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
            .mapInArrow(_hashed, FOUND + ", repaired_sha256 string, rows long"))
