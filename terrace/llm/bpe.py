"""Byte-pair encoding and decoding with forced boundaries.

The vocabulary file says how a text is prepared: special tokens are taken out as they stand, the
rest is put into NFC, lower-cased letter by letter, cut into words by a pattern, and the words'
bytes are merged by rank. Two bytes that stand side by side inside no vocabulary token can never be
merged over, so a cut between them is certain: the fragments are encoded each on its own and their
tokens strung together, and remembered in a cache of bounded size.

Defined results for odd input: null and empty texts have no tokens and decode to the empty text;
texts are encoded whole; a special token's string in a text is that token; repeated rows are
encoded each; ids outside the vocabulary and null ids are passed over in decoding; columns of the
input stay, and new ones take unused names.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from terrace.llm.texts import free_name, pieces

#: Bytes of words and ids remembered by a worker, with what Python needs to hold them.
CACHE_BYTES = 24 << 20
HELD = 150
#: Below this code point letters and digits are listed for the plain `re` module, which is faster.
NEAR = 0x100
SUFFIX = "</w>"
#: Fragments of more bytes are merged with a heap.
LONG = 48
NEVER = 1 << 30


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _near_pattern(pattern: str) -> re.Pattern:
    """The word pattern with its letter and digit classes written out below NEAR.

    Letters are tried first: the alternatives that begin with an apostrophe can't match there.
    """
    def listed(kind: str) -> str:
        return "".join(re.escape(c) for c in map(chr, range(NEAR)) if unicodedata.category(c)[0] == kind)

    tried = sorted(pattern.split("|"), key=lambda part: part.startswith("'") or part.startswith("[^") * 2)
    return re.compile("|".join(tried).replace(r"\p{L}", listed("L")).replace(r"\p{N}", listed("N"))
                      .replace(r"\s", "\t-\r \x85\xa0"))


def _is_near(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Tokenizer:
    """A vocabulary file of the kind described above, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern, self.near = regex.compile(pattern), _near_pattern(pattern)
        self.alone, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.alone[byte], self.last[byte] = vocab[letter], vocab[letter + SUFFIX]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = np.array([vocab[a.removesuffix(SUFFIX) + b] for a, b in pairs], np.int64)
        joined = np.zeros((256, 256), bool)
        for token in vocab:
            held = [letters[c] for c in token.removesuffix(SUFFIX)]
            joined[held[:-1], held[1:]] = True
        self.cut = ~joined
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        names = vocab | self.special
        self.token: list[str | None] = [None] * (max(names.values()) + 1)
        for name, number in names.items():
            self.token[number] = name
        self.tokens = pa.array(self.token, pa.string())
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NEVER where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], NEVER)

    def _by_heap(self, ids: list[int]) -> list[int]:
        """One fragment of many symbols: lowest rank first, then leftmost, from a heap."""
        n, rank_of = len(ids), self.rank.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank, i) for i, pair in enumerate(zip(ids, ids[1:]))
                if (rank := rank_of(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or rank_of((ids[i], ids[j])) != rank:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = int(self.made[rank]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if 0 <= a and b < n and (rank := rank_of((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (rank, a))
        return [x for x in ids if x >= 0]

    def _together(self, ids: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many short fragments at once, one merge in each at a time: tokens and their fragment."""
        done_ids, done_fragment = [ids[:0]], [fragment[:0]]
        same = fragment[1:] == fragment[:-1]
        rank = np.append(np.where(same, self._ranks(ids[:-1], ids[1:]), NEVER), NEVER)[:len(ids)]
        while len(ids):
            starts = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
            # Ranks are below 2**31, so rank and place fit one number: least rank, then leftmost.
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), starts)
            more = best >> 32 < NEVER
            open_ = np.repeat(more, np.diff(np.append(starts, len(ids))))
            done_ids.append(ids[~open_])
            done_fragment.append(fragment[~open_])
            at = best[more] & 0xFFFFFFFF
            ids[at] = self.made[best[more] >> 32]
            keep = open_.copy()
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            ids, fragment, rank = ids[keep], fragment[keep], rank[keep]
            for left in (place - 1, place):
                left = left[(left >= 0) & (left + 1 < len(ids))]
                new = self._ranks(ids[left], ids[left + 1])
                rank[left] = np.where(fragment[left] == fragment[left + 1], new, NEVER)
            if len(rank):
                rank[-1] = NEVER
        tokens, fragment = np.concatenate(done_ids), np.concatenate(done_fragment)
        order = np.argsort(fragment, kind="stable")
        return tokens[order], fragment[order]

    def fragments(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words' bytes, the fragment that each is in, and each fragment's word.

        A fragment begins with a word and wherever two neighbours stand together in no token.
        """
        data = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(size)
        begins = np.zeros(len(data), bool)
        begins[1:] = self.cut[data[:-1], data[1:]]
        begins[ends - size] = True
        ids = self.alone[data]
        ids[ends - 1] = self.last[data[ends - 1]]
        return ids, np.cumsum(begins) - 1, np.repeat(np.arange(len(words)), size)[begins]

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as the bytes of 32-bit integers."""
        ids, fragment, word = self.fragments([w.encode() for w in words])
        size = np.bincount(fragment, minlength=len(word))
        short = (size <= LONG)[fragment]
        tokens, owner = self._together(ids[short], fragment[short])
        ends = np.concatenate([[0], np.cumsum(size)])
        for f in np.flatnonzero(size > LONG).tolist():
            found = self._by_heap(ids[ends[f]:ends[f + 1]].tolist())
            tokens, owner = np.append(tokens, found), np.append(owner, [f] * len(found))
        if not short.all():
            order = np.argsort(owner, kind="stable")
            tokens, owner = tokens[order], owner[order]
        cuts = np.searchsorted(word[owner], np.arange(len(words) + 1)) * 4
        whole, cuts = tokens.astype(np.int32).tobytes(), cuts.tolist()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return self.near.findall(text) if _is_near(text) else self.pattern.findall(text)

    def _known(self, words: set[str]) -> dict[str, bytes]:
        """The ids of all these words, remembered or made."""
        known = {w: v for w in words if (v := self.known.get(w)) is not None}
        if missing := list(words - known.keys()):
            made = dict(zip(missing, self.merged(missing)))
            known.update(made)
            if self.held > CACHE_BYTES:
                self.known, self.held = {}, 0
            short = {w: v for w, v in made.items() if len(w) <= 64}
            self.known.update(short)
            self.held += sum(len(w) + len(v) + HELD for w, v in short.items())
        return known

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list] = []  # of each text: lists of words, and ids of special tokens between
        for text in texts:
            own, done = [], 0
            for found in self.specials.finditer(text):
                own += [self._words(text[done:found.start()]), self.special[found[0]]]
                done = found.end()
            parts.append([*own, self._words(text[done:])])
        known = self._known({w for own in parts for part in own[::2] for w in part}).__getitem__
        return [np.frombuffer(b"".join([
            np.int32(part).tobytes() if isinstance(part, int) else b"".join(map(known, part))
            for part in own]), np.int32) for own in parts]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list with one space between: the file names no other decoder."""
        kept = pc.fill_null(ids, []) if ids.null_count else ids
        flat, ends = kept.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(kept))])
        number = np.asarray(flat.fill_null(-1)) if flat.null_count else np.asarray(flat)
        inside = (number >= 0) & (number < len(self.token))
        inside[inside] &= np.asarray(self.tokens.is_valid())[number[inside]]
        names = self.tokens.take(pa.array(number[inside]))
        ends = np.concatenate([[0], np.cumsum(inside)])[ends].astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), names), " ")


def _listed(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))


@lru_cache(2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encoded(docs: DataFrame, text: str = "text", into: str = "ids",
            path: str | None = None) -> tuple[DataFrame, str]:
    """`docs` with the token ids of their texts; and that column's name."""
    path, into, names = path or default_path(), free_name(docs, into), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in pieces(batches, text):
            ids = _listed(encode([t or "" for t in batch.column(text).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*names, into])

    kind = StructField(into, ArrayType(IntegerType(), True))
    return docs.mapInArrow(run, StructType([*docs.schema.fields, kind])), into


def decoded(rows: DataFrame, ids: str = "ids", into: str = "decoded",
            path: str | None = None) -> tuple[DataFrame, str]:
    """`rows` with the texts that their ids decode to; and that column's name."""
    path, into, names = path or default_path(), free_name(rows, into), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokenizer(path).decode
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                made = decode(part.column(ids)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*names, into])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(into, StringType())])), into


def round_trip(docs: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded",
               path: str | None = None) -> tuple[DataFrame, str, str]:
    """`docs` with, instead of their texts, token ids and what these decode to; and the columns' names.

    One worker does both for a piece of texts, with one vocabulary in memory.
    """
    path, ids = path or default_path(), free_name(docs, ids)
    rest = [f for f in docs.schema.fields if f.name != text]
    decoded = free_name(docs, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(path)
        for batch in pieces(batches, text):
            made = _listed(known.encode([t or "" for t in batch.column(text).to_pylist()]))
            back = known.decode(made).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), made, back], [*(f.name for f in rest), ids, decoded])

    new = [StructField(ids, ArrayType(IntegerType(), True)), StructField(decoded, StringType())]
    return docs.mapInArrow(run, StructType([*rest, *new])), ids, decoded
