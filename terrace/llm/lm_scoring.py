"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates: of a word after the word before it, of the word alone,
and an even share of all words. The weights hang on how often the word before was seen (buckets of
powers of two), and are learned by expectation-maximisation: one tenth of the training texts is
held back (deleted), its words are looked up in the counts of the rest, and every weight moves to
the share of them that its estimate explains. Scores then use the counts of all training texts.

**Counting without moving n-grams one by one.** Texts are stored once as packed chunks. A chunk
asks for each of its different n-grams once: their 64-bit hashes, sorted, go to the shards of the
hash space, with how often its training texts have them. A shard adds up what all chunks have and
answers in the order asked, so an answer needs no keys. The chunk, with its answers, is scored.
Frequent n-grams cost a shard one entry per chunk, and shards grow in number with the text.

Tokens are runs of anything but ASCII white space, A-Z lower-cased, then one end of text. Defined
results for odd input: null and empty texts are the end alone; texts are read whole; a null id counts as
an empty one when texts are split, and stays null; repeated rows count and are scored each; without
training texts every word has an even share; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import warnings
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.texts import giving_back, per_value, pieces, values
from terrace.session import cut_lineage

#: Bytes of text in a chunk, and for each shard.
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 32 << 20
#: Parts of a shard that are counted one after the other.
SLICES = 8
FOLDS = 10
HELD_OUT, DELETED, RETAINED = 0, 1, 2
#: Context frequencies of 2**k to 2**(k+1) - 1 share weights; the last bucket has all above.
BUCKETS = 24
ROUNDS = 500
CLOSE = 1e-3
ADDED = 0.1
END, START = (np.uint64(xxhash.xxh3_64_intdigest(mark)) for mark in (b" ", b"\n"))  # no word has white space


def _pack(*arrays) -> bytes:
    return zstandard.compress(pickle.dumps(arrays, 5), 3)


def _unpack(data: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(data))


def _bytewise(sorted_hashes: np.ndarray) -> np.ndarray:
    """Sorted integers as their steps, byte by byte, which compresses well."""
    return np.diff(sorted_hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.copy()


def _from_bytes(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.uint64)[:, 0], dtype=np.uint64)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def _chunks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(chunk, part, ids, texts): texts of one part packed together."""
    part = fold(F.col(f"`{doc_id}`"))
    plain = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"),
        F.when(part == 0, HELD_OUT).when(part == 1, DELETED).otherwise(RETAINED).alias("part"))
    kind = plain.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = defaultdict(list)
        sizes: dict[int, int] = defaultdict(int)
        number, id_type = count(TaskContext.get().partitionId() << 32), None

        def packed(part: int) -> pa.RecordBatch:
            own, sizes[part] = held.pop(part), 0
            return pa.RecordBatch.from_arrays([
                pa.array([next(number)]), pa.array([part], pa.int32()),
                pa.array([[i for i, _ in own]], pa.list_(id_type)),
                pa.array([_pack([t for _, t in own])], pa.binary())], ["chunk", "part", "ids", "texts"])

        for batch in pieces(batches, "text"):
            id_type = batch.schema.field("id").type
            for i, t, p in zip(batch.column("id").to_pylist(), values(batch.column("text")),
                               batch.column("part").to_pylist()):
                held[p].append((i, t))
                sizes[p] += len(t)
                if sizes[p] >= CHUNK_BYTES:
                    yield packed(p)
        for p in list(held):
            yield packed(p)

    return cut_lineage(plain.mapInArrow(run, f"chunk long, part int, ids array<{kind}>, texts binary"))


class Words:
    """The tokens of a chunk's texts, and its different words and pairs by sorted hash."""

    def __init__(self, texts: list[bytes]):
        number = defaultdict(count(1).__next__)
        words = [text.lower().split() for text in texts]
        self.size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        token = np.zeros(int(self.at[-1]), np.int64)  # 0 is the end of a text
        is_word = np.ones(len(token), bool)
        is_word[self.at[1:] - 1] = False
        get = number.__getitem__
        token[is_word] = np.fromiter((get(w) for ws in words for w in ws), np.int64, int(is_word.sum()))
        digest = xxhash.xxh3_64_intdigest
        hashes = np.array([END, *map(np.uint64, map(digest, number))], np.uint64)
        before = np.empty(len(token), np.uint64)
        before[1:] = hashes[token[:-1]]
        before[self.at[:-1]] = START
        pair = (before ^ before >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + hashes[token]
        pair = (pair ^ pair >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        # START stands among the words, once for each text, since it comes before a word.
        self.words, back, times = np.unique(
            np.concatenate([hashes[token], np.full(len(words), START)]), return_inverse=True, return_counts=True)
        self.word, self.word_times = back[:len(token)], times
        self.before = np.empty(len(token), np.int64)
        self.before[1:] = self.word[:-1]
        self.before[self.at[:-1]] = back[len(token):]
        self.pairs, self.pair, self.pair_times = np.unique(pair, return_inverse=True, return_counts=True)

    def __len__(self) -> int:
        return len(self.word)


def _cuts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where the sorted hashes pass from shard to shard."""
    edges = np.array([(s << 64) // shards for s in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def _questions(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, part, texts in zip(batch.column("chunk").to_pylist(), batch.column("part").to_pylist(),
                                          batch.column("texts")):
                words = Words(_unpack(texts.as_py())[0])
                asked = []
                for hashes, times in ((words.words, words.word_times), (words.pairs, words.pair_times)):
                    cuts = _cuts(hashes, shards)
                    asked.append([(_bytewise(hashes[a:b]), times[a:b].astype(np.uint32))
                                  for a, b in zip(cuts, cuts[1:])])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(shards, dtype=np.int32)), pa.array([chunk] * shards),
                    pa.array([part] * shards, pa.int32()),
                    pa.array([_pack(*a, *b) for a, b in zip(*asked)], pa.binary())],
                    ["shard", "chunk", "part", "asked"])
    return run


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits if all of them fit, else in 64."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64)


def _added(hashes: list[np.ndarray], times: list[np.ndarray], parts: list[int]) -> tuple[np.ndarray, ...]:
    """Counts over all training texts and over the retained ones, in the order asked, and the keys."""
    keys, back = np.unique(np.concatenate(hashes), return_inverse=True)
    n = np.concatenate(times).astype(np.float64)
    part = np.repeat(parts, [len(h) for h in hashes])
    everything = np.bincount(back, np.where(part == HELD_OUT, 0, n), len(keys)).astype(np.int64)
    retained = np.bincount(back, np.where(part == RETAINED, n, 0), len(keys)).astype(np.int64)
    return keys, everything, retained, back


def _answers(shards_in_all: int):
    """A shard's answers to all chunks, and (with chunk null) what it adds to the totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(
            *(batch.column(c).to_pylist() for c in ("shard", "chunk", "part")), batch.column("asked"))]
        if not rows:
            return
        shards, chunks, parts, asked = zip(*rows)
        for shard in sorted(set(shards)):
            own = [i for i, s in enumerate(shards) if s == shard]
            found = [_unpack(asked[i].as_py()) for i in own]
            part = [parts[i] for i in own]
            answers: list[list] = [[] for _ in own]
            totals = np.zeros(3, np.int64)
            for k in (0, 2):
                hashes = [_from_bytes(f[k]) for f in found]
                times = [f[k + 1] for f in found]
                pieces_ = [([], []) for _ in own]
                # A slice of the shard's range at a time: sorting it takes several times its size.
                edges = [((shard << 64) + (i << 64) // SLICES) // shards_in_all for i in range(1, SLICES)]
                cuts = [[0, *np.searchsorted(h, np.array(edges, np.uint64)).tolist(), len(h)] for h in hashes]
                for i in range(SLICES):
                    some = [h[c[i]:c[i + 1]] for h, c in zip(hashes, cuts)]
                    keys, everything, retained, back = _added(
                        some, [t[c[i]:c[i + 1]] for t, c in zip(times, cuts)], part)
                    if k == 0:
                        token = keys != START
                        totals += np.array([everything[token].sum(), (everything[token] > 0).sum(), retained[token].sum()])
                    at = np.concatenate([[0], np.cumsum([len(h) for h in some])])
                    for (whole, rest), a, b in zip(pieces_, at, at[1:]):
                        whole.append(_narrow(everything[back[a:b]]))
                        rest.append(_narrow(retained[back[a:b]]))
                for answer, (whole, rest) in zip(answers, pieces_):
                    answer += [np.concatenate(whole), np.concatenate(rest)]
            yield pa.RecordBatch.from_arrays([
                pa.array([*(chunks[i] for i in own), None], pa.int64()),
                pa.array([shard] * (len(own) + 1), pa.int32()),
                pa.array([*(_pack(*a) for a in answers), None], pa.binary()),
                *(pa.array([0] * len(own) + [t], pa.int64()) for t in totals.tolist())],
                ["chunk", "shard", "answer", "tokens", "types", "retained"])
    return run


def _counts(words: Words, answers: list[dict], kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: counts of the word, of the pair and of the word before.

    `kind` 0 counts all training texts, 1 the retained ones.
    """
    found = [_unpack(a["answer"]) for a in sorted(answers, key=lambda a: a["shard"])]
    word = np.concatenate([f[kind] for f in found]).astype(np.float64)
    pair = np.concatenate([f[2 + kind] for f in found]).astype(np.float64)
    return word[words.word], pair[words.pair], word[words.before]


def _bucket(before: np.ndarray) -> np.ndarray:
    """0 for an unseen word before, else 1 and its logarithm."""
    return np.minimum(np.frexp(before)[1], BUCKETS).astype(np.int64)


def _deleted():
    """Words of deleted texts as (bucket, pair, before, word): their counts in the rest, and how many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, answers in zip(batch.column("texts"), batch.column("answers")):
                words = Words(_unpack(texts.as_py())[0])
                word, pair, before = _counts(words, answers.as_py(), 1)
                seen, n = np.unique(np.stack([before, pair, word]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(_bucket(seen[0]).astype(np.int32)), *(pa.array(seen[i].astype(np.int64)) for i in (1, 0, 2)),
                    pa.array(n)], ["bucket", "pair", "before", "word", "n"])
    return run


def learn(events: DataFrame, tokens: int, types: int) -> list[tuple[float, float, float]]:
    """Weights (pair, word, even share) for each bucket, by expectation-maximisation.

    A bucket starts even; one pseudo-observation keeps each weight above zero. A bucket without
    observations takes the weights of the one below it.
    """
    weights = [(1 / 3, 1 / 3, 1 / 3)] * (BUCKETS + 1)
    events = events.select(
        "bucket", "n", F.when(F.col("before") > 0, F.col("pair") / F.col("before")).otherwise(0.0).alias("f2"),
        (F.col("word") / F.lit(float(max(tokens, 1)))).alias("f1"), F.lit(1.0 / (types + 1)).alias("f0"))
    for _ in range(ROUNDS):
        own = [F.element_at(F.array(*(F.lit(w[k]) for w in weights)), F.col("bucket") + 1) for k in range(3)]
        parts = [own[k] * F.col(f"f{2 - k}") for k in range(3)]
        shares = [F.sum(F.col("n") * parts[k] / (parts[0] + parts[1] + parts[2])).alias(f"s{k}") for k in range(3)]
        found = {r["bucket"]: (r["s0"], r["s1"], r["s2"], r["n"]) for r in events.groupBy("bucket").agg(
            *shares, F.sum("n").alias("n")).collect()}  # a row per bucket
        before, moved = weights, []
        for b in range(BUCKETS + 1):
            *s, n = found.get(b, (0, 0, 0, 0))
            moved.append(tuple((x + 1) / (n + 3) for x in s) if n else moved[-1] if moved else weights[b])
        weights = moved
        if max(abs(x - y) for a, b in zip(before, weights) for x, y in zip(a, b)) < CLOSE:
            break
    else:
        warnings.warn(f"weights still move by over {CLOSE} after {ROUNDS} rounds", RuntimeWarning, stacklevel=2)
    # After a word that was never seen there are no pairs: their weight goes to the other two.
    _, word, even = weights[0]
    return [(0.0, word / (word + even), even / (word + even)), *weights[1:]]


def _scores(weights: list[tuple], tokens: int, types: int):
    mix = np.array(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, part, texts, answers in zip(batch.column("ids"), batch.column("part").to_pylist(),
                                                 batch.column("texts"), batch.column("answers")):
                words = Words(_unpack(texts.as_py())[0])
                word, pair, before = _counts(words, answers.as_py(), 0)
                base = np.log10((word + ADDED) / (tokens + ADDED * (types + 1)))
                own = mix[_bucket(before)]
                p = (own[:, 0] * np.divide(pair, before, out=np.zeros_like(pair), where=before > 0)
                     + own[:, 1] * word / max(tokens, 1) + own[:, 2] / (types + 1))
                add = lambda x: np.add.reduceat(x, words.at[:-1]) if len(words) else x
                n = len(words.size)
                yield pa.RecordBatch.from_arrays([
                    ids.values, pa.array([part == HELD_OUT] * n), pa.array(words.size),
                    pa.array(per_value(word > 0, words.at)), pa.array([tokens] * n, pa.int64()),
                    pa.array(add(base)), pa.array(add(np.log10(p)))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    chunks = _chunks(docs, doc_id, text)
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")).cast("long"))).first()[0] or 0
    shards = max(16, size // SHARD_BYTES + 1)
    answers = cut_lineage(
        chunks.select("chunk", "part", "texts").mapInArrow(
            giving_back(_questions(shards)), "shard int, chunk long, part int, asked binary")
        .repartitionById(shards, F.col("shard")).mapInArrow(
            giving_back(_answers(shards)), "chunk long, shard int, answer binary, tokens long, types long, retained long"))
    tokens, types, retained = answers.filter("chunk IS NULL").agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "retained"))).first()
    by_chunk = answers.filter("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("shard", "answer")).alias("answers"))
    known = chunks.join(by_chunk, "chunk").select("ids", "part", "texts", "answers")
    events = cut_lineage(known.filter(F.col("part") == DELETED).select("texts", "answers").mapInArrow(
        giving_back(_deleted()), "bucket int, pair long, before long, word long, n long"))
    weights = learn(events, retained, types)
    kind = docs.schema[doc_id].dataType.simpleString()
    return known.mapInArrow(
        giving_back(_scores(weights, tokens, types)), f"doc_id {kind}, held_out boolean, n_tokens long, "
        "n_known long, train_tokens long, base_score double, score double")
