"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents are lower-cased (A-Z) and cut into words, runs of ASCII digits and letters and
of anything beyond ASCII. The automaton holds every run of words of every item. A document's words
are streamed through it; the state says how long a run ending at the present word occurs in an
item. A run of `window` words, or a whole item that is shorter, is a hit; all its words are.

The benchmark is sorted and cut into groups of at most `AUTOMATON_WORDS` words (a longer item makes
a group of its own), one automaton and one pass over the documents for each group, so what a task
holds is bounded however large the benchmark is. One group is the normal case.

Defined results for odd input: a null or wordless text has no hits and is not contaminated; null or
wordless items and repeated items of one id and text are without effect; items of one text all
count; an item whose id is null has hits but is not listed; texts are read whole; repeated rows are
judged each; columns of the documents stay, and the result takes an unused name.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from terrace.llm.texts import free_name, pieces, values
from terrace.session import cut_lineage

WINDOW = 13
AUTOMATON_WORDS = 200_000
#: A document is contaminated if it has hits and 20 * hit words >= words.
COVERAGE = 20

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())  # bytes.lower() changes A-Z only


class Automaton:
    """Suffix automaton of several word sequences, with the items of the runs that count.

    Per state: transitions, suffix link, length of its longest run. `hit_at` gives, for a state, the
    longest counting run that ends every match in it and the items with any counting run among
    the match's endings.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = array("q", [-1]), array("q", [0])
        ends: list[tuple[int, int]] = []  # state, item: every prefix of the item ends there
        sequences = [[self.number.setdefault(w, len(self.number)) for w in ws] for _, ws in items]
        for sequence in sequences:
            self._add(sequence)
        self.names = [name for name, _ in items]
        for i, sequence in enumerate(sequences):
            ends.extend((state, i) for state in self._walk(sequence))
        self._mark(sequences, ends)

    def _walk(self, sequence: list[int]) -> Iterator[int]:
        state = 0
        for word in sequence:
            state = self.next[state][word]
            yield state

    def _new(self, follow: dict[int, int], link: int, length: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the shorter runs of `target` that also follow `state`."""
        clone = self._new(dict(self.next[target]), self.link[target], self.length[state] + 1)
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            target = self.next[last].get(word)
            if target is not None:  # another item has this run already
                fits = self.length[target] == self.length[last] + 1
                last = target if fits else self._split(last, word, target)
                continue
            new, state = self._new({}, 0, self.length[last] + 1), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                fits = self.length[target] == self.length[state] + 1
                self.link[new] = target if fits else self._split(state, word, target)
            last = new

    def _holder(self, state: int, size: int) -> int:
        """The state of the ending of `size` words of a run in `state`."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, sequences: list[list[int]], ends: list[tuple[int, int]]) -> None:
        """Items by the state and size of each run that counts."""
        counting: dict[tuple[int, int], set[int]] = {}
        sizes = [min(self.window, len(s)) for s in sequences]
        for (state, item), place in zip(ends, chain.from_iterable(range(1, len(s) + 1) for s in sequences)):
            if place >= sizes[item]:
                counting.setdefault((self._holder(state, sizes[item]), sizes[item]), set()).add(item)
        by_state: dict[int, list[tuple[int, frozenset[int]]]] = {}
        for (state, size), found in counting.items():
            by_state.setdefault(state, []).append((size, frozenset(found)))
        #: for each state on whose chain of links something counts: (size, items), longest first
        self.counts: dict[int, list[tuple[int, frozenset[int]]]] = {}
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            own = sorted(by_state.get(state, []), key=lambda x: -x[0])
            if found := own + self.counts.get(self.link[state], []):
                self.counts[state] = found
        self.least = min(sizes, default=0)

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit runs of words as (first, past the last), joined where they touch; items found."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        state = size = 0
        follow, link, length, counts = self.next, self.link, self.length, self.counts
        for i, word in enumerate(map(self.number.get, text)):
            if word is None:
                state = size = 0
                continue
            while state and word not in follow[state]:
                state = link[state]
                size = length[state]
            to = follow[state].get(word)
            if to is None:
                continue
            state, size = to, size + 1
            if size < self.least:
                continue
            for run, items in counts.get(state, ()):
                if run <= size:
                    found |= items
                    start = i + 1 - run
                    while spans and start <= spans[-1][1]:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, found


def item_groups(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple]]:
    """Items in groups of at most `limit` words, fetched one group at a time."""
    rows = (items.select(F.col(f"`{item_id}`").cast("string").alias("item"),
                         F.col(f"`{text}`").cast("string").alias("words"))
            .filter("words IS NOT NULL").distinct().orderBy("item", "words"))
    group, size = [], 0
    for row in rows.toLocalIterator():
        if found := words(row["words"].encode()):
            if group and size + len(found) > limit:
                yield group
                group, size = [], 0
            group.append((row["item"], found))
            size += len(found)
    yield group


def _scanned(docs: DataFrame, text: str, into: str, items: list[tuple], window: int) -> DataFrame:
    kind = StructType([
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(StructType([StructField("first", LongType()),
                                                   StructField("past", LongType())]))),
        StructField("items", ArrayType(StringType()))])
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(shared.value, window)
        arrow = pa.struct([("n_words", pa.int64()),
                           ("spans", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                           ("items", pa.list_(pa.string()))])
        for batch in pieces(batches, text):
            rows = []
            for value in values(batch.column(text)):
                found = words(value)
                spans, hit = automaton.scan(found)
                rows.append({"n_words": len(found),
                             "spans": [{"first": a, "past": b} for a, b in spans],
                             "items": sorted({automaton.names[i] for i in hit} - {None})})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, arrow)], [*names, into])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(into, kind)]))


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", into: str = "hits", window: int = WINDOW,
                  limit: int = AUTOMATON_WORDS) -> tuple[DataFrame, str]:
    """`docs` with a struct: n_words, spans of hit words, items (as sorted strings), n_hit.

    Spans are (first word, past the last), apart from each other and in order.
    """
    into = free_name(docs, into)
    out, have = docs, F.col(f"`{into}`")
    for k, group in enumerate(item_groups(items, item_id, item_text, limit)):
        if k == 0:
            out = _scanned(out, text, into, group, window)
            continue
        out = cut_lineage(out)  # else one task would hold the automatons of all groups side by side
        more = free_name(out, f"{into}_more")
        out = _scanned(out, text, more, group, window)
        both = F.array_sort(F.concat(have["spans"], F.col(f"`{more}`.spans")))
        joined = F.aggregate(both, F.slice(both, 1, 1), lambda done, span: F.when(
            span["first"] > F.element_at(done, -1)["past"], F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["first"].alias("first"),
                F.greatest(F.element_at(done, -1)["past"], span["past"]).alias("past"))))))
        out = out.withColumn(into, have.withField("spans", joined).withField(
            "items", F.array_sort(F.array_union(have["items"], F.col(f"`{more}`.items"))))).drop(more)
    n_hit = F.aggregate(have["spans"], F.lit(0).cast("long"),
                        lambda total, span: total + span["past"] - span["first"])
    return out.withColumn(into, have.withField("n_hit", n_hit)), into


def is_contaminated(hits):
    return (hits["n_hit"] > 0) & (COVERAGE * hits["n_hit"] >= hits["n_words"])


def _cut(text: bytes, spans: list[dict]) -> str:
    at = [m.span() for m in WORD.finditer(text.lower())]
    out, done = [], 0
    for span in spans:
        out.append(text[done:at[span["first"]][0]])
        done = at[span["past"] - 1][1]
    return b"".join([*out, text[done:]]).decode()


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", chars: str = "n_chars",
                   **options) -> DataFrame:
    """Documents beyond the coverage limit go; of the others, the hit spans are cut out.

    Only the text of a document with hits changes, and its length in `chars`, if that is a column.
    """
    found, name = contamination(docs, items, text, **options)
    kept, names = found.filter(~is_contaminated(F.col(f"`{name}`"))), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(name).field("spans").to_pylist()
            columns = dict(zip(names, batch.columns))
            if any(spans):
                old = columns[text].to_pylist()
                new = [_cut(t.encode(), s) if s else t for t, s in zip(old, spans)]
                columns[text] = pa.array(new, columns[text].type)
                if chars in columns:
                    counts = [len(t) if s else n for n, t, s in zip(columns[chars].to_pylist(), new, spans)]
                    columns[chars] = pa.array(counts, columns[chars].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return kept.mapInArrow(run, docs.schema)
