"""Registered queries over the smallest test tables, against their SQL or a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SMALL, plan_of
from tests.llm import brute
from terrace.llm import quality_classifier as qc
from terrace.llm.texts import utf8
from terrace.llm.queries import ORACLE, QUERIES
from tools.compare import check, connect


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def run(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, SMALL).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    difference, rows = check(spark, connect(SMALL), SMALL, name, QUERIES[name], ORACLE[name])
    assert difference is None and rows


def test_native_queries_run_no_python(spark):
    for name in ("op7_sharding", "op8_url_filters"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lm_scoring(spark, docs):
    got = run(spark, "op3_lm_scoring")
    for (doc, _), (held, n, known, train, base, score) in zip(docs, brute.lm(docs)):
        row = got[doc]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held, n, known, train)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert math.isclose(row.score, score, rel_tol=1e-6)


def test_lm_beats_words_alone_on_held_out_texts(spark):
    held = [r for r in run(spark, "op3_lm_scoring").values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def kinds(text):
    """The bytes of a text, a run of white space as one zero, which also stands before the text."""
    spaced = re.sub(rb"[\x09-\x0d ]+", b" ", text.encode())
    return [0 if b == 0x20 else b for b in spaced.removeprefix(b" ")]


def test_grams_are_the_bytes_of_texts():
    texts = ["приветмир", "", "  a\n\tB  ", None, "日本語中文字", " "]
    found, at = qc.grams(*utf8(pa.array(texts)))
    for text, a, b in zip(texts, at, at[1:]):
        padded = [0] * (qc.ORDER - 1) + kinds(text or "")
        want = [bytes(x or 0x20 for x in padded[i:i + qc.ORDER]) for i in range(len(kinds(text or "")))]
        assert [int(g).to_bytes(qc.ORDER) for g in found[a:b]] == want


def test_quality_classifier(spark, docs):
    got = run(spark, "op4_quality_classifier")
    trusted = {r.doc_id for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()}
    want = brute.kneser_ney([t for d, t in docs if d in trusted], [t for _, t in docs], kinds, qc.ORDER, qc.CLASSES)
    for (doc, text), p in zip(docs, want):
        row = got[doc]
        assert row.n_grams == len(kinds(text))
        assert math.isclose(math.log10(row.perplexity), -p / row.n_grams, rel_tol=1e-4)
        assert row.kept == (row.perplexity <= row.threshold)


def test_quality_classifier_keeps_trusted_and_drops_junk(spark):
    got = run(spark, "op4_quality_classifier")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = Counter((labels[d], got[d].kept) for d in labels)
    assert kept[1, True] >= 0.98 * (kept[1, True] + kept[1, False])
    assert kept[0, False] >= 0.5 * (kept[0, True] + kept[0, False])


def test_simhash(spark, docs):
    got = run(spark, "op6_simhash_near_dedup")
    prints = [brute.fingerprint(t) for _, t in docs]
    ids = [d for d, _ in docs]
    for doc, mine, component in zip(ids, prints, brute.components(prints, ids)):
        assert (got[doc].fingerprint, got[doc].component_id) == (f"{mine:016x}", component)


def test_sharding(spark, docs):
    got = run(spark, "op7_sharding")
    size, slots, by_text = Counter(), defaultdict(list), defaultdict(set)
    for doc, text in docs:
        row = got[doc]
        assert row.size == len(text.encode()) + 1 and row.text_crc32 == zlib.crc32(text.encode())
        assert row.law == "bytes" and row.grown_shard is None and 0 <= row.shard < 16
        size[row.shard] += row.size
        slots[row.shard].append(row.slot)
        by_text[text].add(row.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # a boundary lies at most half a text off its place, and texts of a 64th of a shard are placed first
    assert max(abs(s - sum(size.values()) / 16) for s in size.values()) <= max(len(t.encode()) for _, t in docs) + 1
    assert all(len(s) == 1 for s in by_text.values())
    plain = brute.sharding(docs, 16)
    assert {(d, *place) for (d, _), place in zip(docs, plain)} == {(r.doc_id, r.shard, r.slot) for r in got.values()}


def test_bpe(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    got = run(spark, "op10_bpe")
    for (doc, _), made in zip(docs, library.encode_batch([t for _, t in docs], add_special_tokens=False)):
        assert got[doc].n_tokens == len(made.ids)
        assert got[doc].ids_sha256 == brute.sha(" ".join(map(str, made.ids)))
        assert got[doc].decoded_sha256 == brute.sha(library.decode(made.ids, skip_special_tokens=False))


def test_pipeline(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(d, t) for d, t in docs if passes(brute.quality(t))]
    prints = [brute.fingerprint(t) for _, t in rows]
    first = brute.components(prints, [d for d, _ in rows])
    rows = [r for r, c in zip(rows, first) if r[0] == c]
    flags = brute.suffix_dedup(rows)
    rows = [(d, cut(t, flags[d, t])) for d, t in rows]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {}
    for doc, text in rows:
        words, hit, _ = brute.contamination(text, items)
        if not (sum(hit) and 20 * sum(hit) >= len(words)):
            want[doc] = text if not any(hit) else None
    got = {r.doc_id: r for r in QUERIES["pipeline"](spark, SMALL).collect()}
    assert got.keys() == want.keys()
    for doc, text in want.items():
        if text is not None:
            assert got[doc].ids == library.encode(text, add_special_tokens=False).ids


def passes(measured):
    words, chars, symbols, dup, repeat, lines = measured
    return not (words < 20 or 100 * repeat > 30 * words or chars < 2 * words or chars > 20 * words
                or 10 * symbols > 3 * words or 2 * dup > lines)


def cut(text, flags):
    data, out, start = text.encode(), [], 0
    for a, b in brute.spans(flags):
        out.append(data[start:a].decode(errors="ignore"))
        start = b
    return "".join([*out, data[start:].decode(errors="ignore")])


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).dtypes == docs.dtypes


def test_trial_conversation_comes_back(spark):
    row = run(spark, "op1_chat_formatting")[-1]
    said = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(said), brute.sha(said))
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
