"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SMALL, plan_of, rows_of
from tests.llm import brute
from terrace.llm import (bpe, chat_format, decontaminate, lm_scoring, quality_classifier, quality_rules,
                         sharding, simhash, suffix_dedup, url_filters)

random.seed(5)
WORDS = ["alpha", "beta", "gamma", "delta", "né", "straße", "one", "two", "x1", "Ω"]
PASSAGE = " ".join(random.choice(WORDS) for _ in range(60))
LONG = " ".join(random.choice(WORDS) + str(random.randrange(50)) for _ in range(30_000))
ODD = [
    (None, PASSAGE + " tail"), (None, None), (1, None), (2, ""), (3, " \t\n"), (4, PASSAGE), (4, PASSAGE),
    (4, "other text under one id " + PASSAGE), (5, "x"), (6, "x"), (7, LONG), (8, "lead " + LONG), (9, "a" * 1000),
    (10, "ab" * 700), (11, "né" * 300), (12, "<|endoftext|> </s> \\ 'S it's"), (13, PASSAGE.upper()),
    (-3, PASSAGE + " end")]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, ids string, ledger int, hits int, row int"


@pytest.fixture
def odd(spark):
    """The odd rows, with columns named like those that the operators add."""
    return spark.createDataFrame(
        [(d, t, None if i % 5 == 0 else "en", "s", None if t is None else len(t), "i", 1, 2, 3)
         for i, (d, t) in enumerate(ODD)], COLUMNS)


def key(row):
    return tuple((x is not None, x) for x in row)


def test_rules(odd):
    judged, name = quality_rules.ledger(odd)
    got = sorted(((r.doc_id, r.text, *r[name][:6]) for r in judged.collect()), key=key)
    assert got == sorted(((d, t, *brute.quality(t)) for d, t in ODD), key=key)
    assert quality_rules.kept_rows(odd).columns == odd.columns


def test_ablation_counts_patterns(frame):
    bit = quality_rules.BIT
    failed = frame("failed long", [0], [bit["few_words"]], [bit["few_words"] | bit["many_symbols"]],
                   [bit["many_symbols"]], [bit["many_symbols"]])
    got = {r.rule: tuple(r)[1:] for r in quality_rules.ablation(failed, "2024-1").collect()}
    assert got == {"few_words": (2, 1, 3), "repeated_windows": (0, 0, 4), "many_symbols": (3, 2, 2)}


def test_ablation_of_all_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged, name = quality_rules.ledger(docs)
    failed = [r[0] for r in judged.select(f"{name}.failed").collect()]
    assert len(failed) == docs.count() and any(failed)
    for policy, rules in quality_rules.POLICIES.items():
        bits = [{rule for rule in rules if f & quality_rules.BIT[rule]} for f in failed]
        got = {r.rule: tuple(r)[1:] for r in quality_rules.ablation(judged.select(f"{name}.failed"), policy).collect()}
        assert got == {rule: (sum(rule in b for b in bits), sum(b == {rule} for b in bits),
                              sum(bool(b - {rule}) for b in bits)) for rule in rules}


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"buckets": 3}])
def test_suffixes(odd, options):
    want = brute.suffix_dedup(ODD)
    got = sorted(((r.row.doc_id, [tuple(s) for s in r.spans], bytes(r.kept))
                  for r in suffix_dedup.deduplicated(odd, **options).collect()), key=key)
    expected = []
    for d, t in ODD:
        flags = want[d, t]
        kept = bytes(b for b, f in zip((t or "").encode(), flags) if not f)
        expected.append((d, brute.spans(flags), kept))
    assert got == sorted(expected, key=key)


def test_random_texts_with_shared_passages(spark):
    base = "".join(random.choice("abcdeé ") for _ in range(3000))
    rows = []
    for i in range(80):
        a, n = random.randrange(2500), random.randrange(60, 400)
        rows.append((i, "".join(random.choice("xyz") for _ in range(random.randrange(90))) + base[a:a + n]
                     + random.choice(["", "a" * 300, "ab" * 150])))
    want = brute.suffix_dedup(rows)
    for options in ({}, {"hot": 1, "buckets": 5}):
        got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), **options)
        assert {r.row.doc_id: [tuple(s) for s in r.spans] for r in got.collect()} == {
            d: brute.spans(want[d, t]) for d, t in rows}


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"buckets": 3}])
def test_repeated_rows_keep_what_is_their_own(spark, options):
    words = lambda n: " ".join(f"{random.choice(WORDS)}{random.randrange(1000)}" for _ in range(n))
    shared, variant, twice = words(40), words(40), words(30)
    rows = [(1, words(60)), (None, words(60)), (2, f"{words(30)} {shared} {words(30)}"), (3, f"{words(10)} {shared} {words(9)}"),
            (None, f"{words(5)} {twice} {words(5)} {twice}"), (4, f"{variant} {words(20)}"), (5, f"{words(3)} {variant[:130]} {words(20)}")]
    want = brute.suffix_dedup(rows)
    assert not any(want[rows[0]]) and not any(want[rows[1]])
    assert all(any(want[rows[k]]) for k in (3, 4, 6))
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string").repartition(5)
    got = sorted(((r.row.doc_id, [tuple(s) for s in r.spans], bytes(r.kept).decode(errors="ignore"))
                  for r in suffix_dedup.deduplicated(docs, **options).collect()), key=key)
    assert got == sorted(((d, brute.spans(want[d, t]),
                           bytes(b for b, f in zip(t.encode(), want[d, t]) if not f).decode(errors="ignore"))
                          for d, t in rows * 3), key=key)


def _spans_of(spark, rows, **options):
    got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), **options)
    want = brute.suffix_dedup(rows)
    assert sorted(((r.row.doc_id, [tuple(s) for s in r.spans]) for r in got.collect()), key=key) == sorted(
        ((d, brute.spans(want[d, t])) for d, t in rows), key=key)


def test_texts_of_one_checksum_are_told_apart(spark):
    known, draw = {}, random.Random(4)
    while True:
        text = "".join(draw.choices("abcdefghij ", k=150))
        other = known.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            break
    for doc in (None, 5):
        _spans_of(spark, [(doc, text), (doc, other), (9, f"{text[20:]} and more"), (10, "own " * 3 + other[:120])])


def test_a_run_in_very_many_different_stretches(spark, monkeypatch):
    # The run of least hash of many: wherever it stands, it names the windows around it.
    draw = np.random.default_rng(3)
    many = draw.integers(97, 123, 200_000).astype(np.uint8)
    at = int(np.argmin(suffix_dedup._gram_hashes(many)))
    run = many[at:at + 32].tobytes().decode()
    words = lambda n: "".join(map(chr, draw.integers(97, 123, n)))
    rows = [(i, words(80) + run + words(80)) for i in range(3000)]
    rows += [(5000 + i, words(30) + rows[7 * i][1][20:170] + words(9)) for i in range(200)]
    asked = []
    dealt = suffix_dedup._settle
    monkeypatch.setattr(suffix_dedup, "_settle", lambda hot, frequent: asked.append(len(frequent)) or dealt(hot, frequent))
    _spans_of(spark, rows, buckets=12)
    assert asked and asked[0] >= 1


def test_texts_beyond_a_segment(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 5000)
    rows = [(1, LONG[:20_000]), (2, "begin " + LONG[3000:16_000] + " x")]
    batch = spark.createDataFrame(rows, "doc_id long, text string").select("text").toArrow().combine_chunks().to_batches()[0]
    found = suffix_dedup._stretch_rows(batch, 100)
    covered = {(r, p) for r, place in zip(found["row"].tolist(), found["place"].tolist())
               for p in range((place >> 14) - (place >> 7 & 127), (place >> 14) - (place >> 7 & 127) + (place & 127) + 1)}
    assert covered == {(r, p) for r, (_, t) in enumerate(rows) for p in range(len(t.encode()) - 99)}


def test_cut_texts_are_text_again(odd):
    done = suffix_dedup.without_repeats(odd)
    assert done.dtypes == odd.dtypes
    for row in done.collect():
        assert row.n_chars == (None if row.text is None else len(row.text))


@pytest.mark.parametrize("limit", [simhash.TILE_ROWS, 2])
def test_fingerprints(odd, limit):
    prints = [brute.fingerprint(t) for _, t in ODD]
    want = zip([d for d, _ in ODD], prints, brute.components(prints, [d for d, _ in ODD]))
    got = [(r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id)
           for r in simhash.near_duplicates(odd, limit=limit).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_tiles_find_all_links(spark):
    rng = random.Random(3)
    prints = []
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 80)):
            prints.append(centre)
            for bit in rng.sample(range(64), rng.randrange(0, 4)):
                prints[-1] ^= 1 << bit
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    want = brute.components(prints, list(range(len(prints))))
    for limit in (simhash.TILE_ROWS, 10):
        links = simhash.links(spark.createDataFrame(signed, "print long"), "print", limit=limit)
        from terrace.llm.components import components
        roots = {r.node: r.root for r in components(links, "a", "b").collect()}
        group = [roots.get(s, s) for s, in signed]
        pairs = set(zip(want, group))
        assert len(pairs) == len(set(want)) == len(set(group))


def test_one_document_of_each_group_stays(odd, spark):
    kept = simhash.first_of_each(odd)
    assert kept.dtypes == odd.dtypes
    prints = [brute.fingerprint(t) for _, t in ODD]
    first = set(brute.components(prints, [d for d, _ in ODD]))
    assert sorted((key((r.doc_id,)) for r in kept.collect())) == sorted(key((f,)) for f in first)
    nameless = [(None, "some words of one text"), (None, "some words of one text"), (None, "x y z"), (5, "X Y Z")]
    found = simhash.first_of_each(spark.createDataFrame(nameless, "doc_id long, text string")).collect()
    assert sorted((r.text for r in found)) == ["X Y Z", "some words of one text"]


def test_contamination_over_several_groups(odd, spark):
    items = [(1, PASSAGE), (2, "x"), (3, None), (4, ""), (5, " ".join(PASSAGE.split()[3:20])), (None, "delta"),
             (6, " ".join(LONG.split()[100:140])), (6, " ".join(LONG.split()[100:140])), (7, "not there at all")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for limit in (decontaminate.AUTOMATON_WORDS, 30):
        found, name = decontaminate.contamination(odd, table, limit=limit)
        for row in found.collect():
            words, flags, names = brute.contamination(row.text, items)
            hits = row[name]
            assert (hits.n_words, hits.n_hit, hits["items"]) == (len(words), sum(flags), names)
            assert [(s.first, s.past) for s in hits.spans] == brute.spans(bytes(flags))


def test_a_task_scans_for_one_group_of_items(odd, spark):
    items = spark.createDataFrame([(i, f"w{i} " * 20) for i in range(4)], "item_id long, text string")
    found, _ = decontaminate.contamination(odd, items, limit=30)
    assert plan_of(found).count("MapInArrow") == 1


def test_few_hits_are_cut_and_many_drop_the_document(frame):
    text = " ".join(f"w{i}" for i in range(400))
    item = " ".join(f"w{i}" for i in range(100, 113))
    docs = frame("doc_id long, text string, n_chars long", [1, text, len(text)], [2, item, len(item)], [3, "clean", 5])
    got = {r.doc_id: r for r in decontaminate.decontaminated(docs, frame("item_id long, text string", [1, item])).collect()}
    assert got.keys() == {1, 3} and got[3].text == "clean"
    assert got[1].text == text.replace(item, "") and got[1].n_chars == len(got[1].text)


def test_bpe_equals_the_library(odd):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded, ids = bpe.encoded(odd)
    back, text = bpe.decoded(coded, ids)
    assert ids == "ids_"
    for row in back.collect():
        made = library.encode(row.text or "", add_special_tokens=False).ids
        assert row[ids] == made and row[text] == library.decode(made, skip_special_tokens=False)


def test_decoding_passes_over_unknown_ids(frame):
    back, text = bpe.decoded(frame("ids array<int>", [[320, None, -5, 10**9, 321]], [None], [[]]))
    assert sorted(len(r[text].split()) for r in back.collect()) == [0, 0, 2]


def test_lm(odd):
    want = sorted(((d, *x[:4], round(x[4], 6), round(x[5], 4)) for (d, _), x in zip(ODD, brute.lm(ODD))), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 4))
                  for r in lm_scoring.scored(odd).collect()), key=key)
    assert got == want


def test_lm_answers_with_counts_beyond_32_bits():
    many, hashes = (1 << 32) - 1, np.array([5, 9], np.uint64)
    packed = lm_scoring._pack(*[lm_scoring._bytewise(hashes), np.array([many, 1], np.uint32)] * 2)
    rows = [pa.RecordBatch.from_arrays(
        [pa.array([0, 0], pa.int32()), pa.array([1, 2]), pa.array([lm_scoring.RETAINED] * 2, pa.int32()),
         pa.array([packed] * 2, pa.binary())], ["shard", "chunk", "part", "asked"])]
    (answered,) = lm_scoring._answers(1)(iter(rows))
    for packed in answered.column("answer").to_pylist()[:2]:
        assert [a.tolist() for a in lm_scoring._unpack(packed)] == [[2 * many, 2]] * 4


def test_classifier(odd, frame):
    got = quality_classifier.classified(odd, frame("doc_id long", [4], [4], [None], [99])).collect()
    assert len(got) == len(ODD)
    for row in got:
        assert (row.perplexity is None) == (row.n_grams == 0) and not (row.n_grams == 0 and row.kept)


def test_classifier_rejects_junk_that_is_much_of_a_language(spark):
    rng = random.Random(7)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    trusted = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").select("doc_id")
    said = lambda: " ".join("".join(rng.choices("bcdfghjkqwxz", k=rng.randrange(3, 9))) for _ in range(150))
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    junk = [(10**6 + 1000 * k + i, said(), lang) for k, (lang, n) in enumerate(sorted(counts.items())) for i in range(n // 2 + 1)]
    junk += [(2 * 10**6 + i, said(), "without trusted texts") for i in range(10)]
    plain = docs.filter("lang = 'en'").join(trusted, "doc_id", "left_semi").limit(20).collect()
    junk += [(3 * 10**6 + i, r.text, "without trusted texts") for i, r in enumerate(plain)]
    table = docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string"))
    got = {r.row.doc_id: r.kept for r in quality_classifier.classified(table, trusted).collect()}
    assert not any(got[d] for d, *_ in junk if d < 3 * 10**6)
    assert all(got[d] for d, *_ in junk if d >= 3 * 10**6)
    ids = [r.doc_id for r in trusted.collect()]
    assert sum(got[d] for d in ids) >= 0.98 * len(ids)


def test_shards(odd):
    got = sharding.sharded(odd, 4).collect()
    assert sorted(key((r.doc_id, r.size)) for r in got) == sorted(
        key((d, len((t or "").encode()) + 1)) for d, t in ODD)
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def sharded(spark, rows, shards):
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), shards).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted(
        (d, *place) for (d, _), place in zip(rows, brute.sharding(rows, shards)))
    return got


def test_a_text_of_many_rows_is_divided(spark):
    rows = [(i % 7, "y" * 300) for i in range(600)] + [(i, f"{i} z" * (i % 9)) for i in range(600)]
    rows.sort()  # rows with one id and text are numbered as they stand
    got = sharded(spark, rows, 8)
    size = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert sum(size) == sum(len(t) + 1 for _, t in rows) and max(size) - min(size) <= 0.03 * sum(size)


def test_equal_texts_share_a_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES_PER_SHARD", 400)  # boundaries fall between the rows of most pairs
    pairs = [(i, f"text {i // 2} " + "x" * (i // 2 % 40)) for i in range(900)]
    few = [(1000 + i, f"copy {i % 3}" + "y" * 900) for i in range(60)]
    empty = [(2000 + i, "") for i in range(700)]
    got = sharded(spark, sorted(pairs + few + empty), 4)
    where = {}
    for r in got:
        where.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    size = [sum(r.size for r in got if r.shard == s) for s in range(4)]
    assert max(size) - min(size) <= 0.05 * sum(size)


def test_conversations(frame):
    rows = frame("conv_id long, turn long, role string, text string, formatted int",
                 [1, 0, "user", None, 0], [1, 1, "assistant", "", 0], [1, 1, "assistant", "tie <|end|>", 0],
                 [1, 1, "assistant", "", 0], [None, None, None, "\\", 0], [None, 2, "assistant", "\\<|turn|>\\", 0],
                 [3, 5, "<|text|>", "[INST" * 3 + "]", 0])
    got = {r.conv_id: r for r in chat_format.read(chat_format.formatted(rows)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", ""), ("assistant", ""), ("assistant", ""), ("assistant", "tie <|end|>")]
    assert got[1].learnt == "tie <|end|>" and got[None].learnt == "\\<|turn|>\\"
    assert [tuple(t) for t in got[None].turns] == [("", "\\"), ("assistant", "\\<|turn|>\\")]
    assert [tuple(t) for t in got[3].turns] == [("<|text|>", "[INST" * 3 + "]")]


def test_url_lists_over_time(frame):
    entries = frame("list string, kind string, pattern string, added boolean, at date string".replace("date string", "string"),
                    ["bad", "domain", "a.com", True, "2024-01-10"], ["bad", "domain", "a.com", False, "2024-02-01"],
                    ["bad", "domain", "a.com", True, "2024-02-01"], ["bad", "domain", "a.com", True, "2024-03-01"],
                    ["bad", "domain", "a.com", True, "2024-03-01"], ["ads", "prefix", "b.org/x", True, "2024-01-01"],
                    ["ads", "host", None, True, "2024-01-01"])
    captures = frame("page_id long, url string, fetched string, matches int",
                     [1, "http://m.a.com/q", "2024-01-09", 0], [2, "http://m.a.com/q", "2024-01-10", 0],
                     [3, "https://A.COM:80", "2024-02-01", 0], [4, "https://a.com.", "2024-03-01", 0],
                     [5, "http://u@b.org/x/y?z", "2024-05-01", 0], [6, "http://b.org/xy", "2024-05-01", 0],
                     [7, None, "2024-05-01", 0], [8, "nonsense", None, 0], [2, "http://m.a.com/q", "2024-01-10", 0])
    got = [(r.row.page_id, [m.list for m in r.matches]) for r in url_filters.judged(captures, entries).collect()]
    assert sorted(got) == [(1, []), (2, ["bad"]), (2, ["bad"]), (3, []), (4, ["bad"]), (5, ["ads"]), (6, []), (7, []), (8, [])]
    kept = url_filters.allowed(captures, entries)
    assert kept.columns == captures.columns and [r[0] for r in rows_of(kept, "page_id")] == [1, 3, 6, 7, 8]


def test_empty_tables(spark, odd, frame):
    none = odd.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.kept_rows(none).count() == 0
    assert simhash.first_of_each(none).count() == 0
    assert suffix_dedup.without_repeats(none).count() == 0
    assert decontaminate.decontaminated(odd, items).count() == len(ODD)
    assert bpe.encoded(none)[0].count() == 0
    assert lm_scoring.scored(none).count() == 0
    assert quality_classifier.classified(none, none).count() == 0
    assert sharding.sharded(none, 4).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.formatted(rows).count() == 0
    entries = spark.createDataFrame([], "list string, kind string, pattern string, added boolean, at date")
    assert url_filters.judged(spark.createDataFrame([], "url string, fetched date"), entries).count() == 0


def test_pipeline_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SMALL).count() >= 0, name


def test_classifier_over_several_blocks_equals_one(spark, odd, frame, monkeypatch):
    trusted = frame("doc_id long", [4])
    scored = lambda: sorted((str(r.row), r.n_grams, r.perplexity or 0.0)
                            for r in quality_classifier.classified(odd, trusted).collect())
    whole = scored()
    monkeypatch.setattr(quality_classifier, "BLOCK_BYTES", 1)
    monkeypatch.setattr(quality_classifier, "HELD_GRAMS", 1)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1")  # a text, and so a block, at a time
    try:
        apart = scored()
    finally:
        spark.conf.set(limit, before)
    assert [r[:2] for r in apart] == [r[:2] for r in whole]
    assert all(abs(a[2] - b[2]) <= 1e-6 * b[2] for a, b in zip(apart, whole))
