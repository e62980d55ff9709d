"""SQL for the queries that SQL can express, over the whole tables.

White space is ASCII white space. Texts are taken as lists of words with their places.
"""

from __future__ import annotations

SPACE_WORD = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, regexp_extract_all(text, '{SPACE_WORD}') AS w FROM texts),
placed AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM split),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS said FROM placed WHERE i + 7 <= len(w)),
twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, said) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY r),
lines AS (
    SELECT r, line, count(*) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '{SPACE_WORD}') GROUP BY r, line),
per_text AS (SELECT r, sum(n)::BIGINT AS n, sum(n - 1)::BIGINT AS dup FROM lines GROUP BY r),
measured AS (
    SELECT t.doc_id, len(s.w)::BIGINT AS n_words,
           length(regexp_replace(t.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(t.text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
           coalesce(l.n, 0)::BIGINT AS n_lines
    FROM texts t JOIN split s USING (r) LEFT JOIN covered c USING (r) LEFT JOIN per_text l USING (r)),
judged AS (
    SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
               + 4 * (word_chars < 2 * n_words)::INT + 8 * (word_chars > 20 * n_words)::INT
               + 16 * (10 * n_symbols > 3 * n_words)::INT
               + 32 * (2 * n_dup_lines > n_lines)::INT)::BIGINT AS failed_rules
    FROM measured)
SELECT *, failed_rules & 3 <> 0 AS base_failed, failed_rules = 0 AS kept FROM judged
"""

#: Policies and the places of their rules' bits.
_PLACES = {"base": (0, 1), "2024-1": (0, 1, 4), "2024-2": (0, 1, 2, 3, 4, 5)}
_RULES = ("few_words", "repeated_windows", "short_words", "long_words", "many_symbols", "repeated_lines")


def _ablation() -> str:
    parts = []
    for policy, places in _PLACES.items():
        whole = sum(1 << p for p in places)
        for p in places:
            parts.append(f"""
SELECT '{policy}' AS policy, '{_RULES[p]}' AS rule, count(*) FILTER (WHERE failed_rules & {1 << p} <> 0) AS n_failed,
       count(*) FILTER (WHERE failed_rules & {whole} = {1 << p}) AS n_failed_alone,
       count(*) FILTER (WHERE failed_rules & {whole - (1 << p)} <> 0) AS n_rejected_without FROM rated""")
    return "WITH rated AS MATERIALIZED (" + OP5 + ")" + " UNION ALL ".join(parts)


def _digits(column: str, first: int) -> str:
    digit = lambda k: f"(instr('0123456789abcdef', substr(md5({column}), {k}, 1)) - 1)"
    return f"({digit(first)} * 16 + {digit(first + 1)})"


_SAID = "kind || ' ' || pattern"
OP8 = rf"""
WITH read AS (
    SELECT row_number() OVER () AS r, page_id,
           rtrim(lower(regexp_extract(coalesce(url, ''),
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
           list_filter(string_split(regexp_extract(coalesce(url, ''),
               '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS parts,
           DATE '2024-01-01' + ({_digits("concat_ws(' ', page_id::VARCHAR, url)", 1)}
                                + {_digits("concat_ws(' ', page_id::VARCHAR, url)", 3)})::INT AS fetched
    FROM pages),
asked AS (
    SELECT r, fetched, 'host' AS kind, host AS pattern FROM read
    UNION ALL SELECT r, fetched, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
        lambda i: array_to_string(string_split(host, '.')[i:], '.'))) FROM read
    UNION ALL SELECT r, fetched, 'prefix', unnest(list_transform(range(1, len(parts) + 1),
        lambda i: host || '/' || array_to_string(parts[1:i], '/'))) FROM read),
drawn AS (
    SELECT CASE WHEN {_digits(_SAID, 3)} < 128 THEN 'malware' ELSE 'spam' END AS list, kind, pattern,
           {_digits(_SAID, 5)} AS d, {_digits(_SAID, 7)} % 100 + 1 AS days, {_digits(_SAID, 9)} AS fate
    FROM (SELECT DISTINCT kind, pattern FROM asked WHERE pattern <> '') WHERE {_digits(_SAID, 1)} < 64),
events AS (
    SELECT list, kind, pattern, true AS added, DATE '2024-01-01' + d::INT AS happened FROM drawn
    UNION ALL SELECT list, kind, pattern, false, DATE '2024-01-01' + (d + days)::INT FROM drawn WHERE fate < 128
    UNION ALL SELECT list, kind, pattern, true, DATE '2024-01-01' + (d + days + 30)::INT FROM drawn WHERE fate < 64),
spans AS (
    SELECT list, kind, pattern, added, happened AS since,
           lead(happened) OVER (PARTITION BY list, kind, pattern ORDER BY happened) AS until FROM events),
hits AS (
    SELECT r, list, a.kind, a.pattern, since FROM asked a
    JOIN spans s ON a.kind = s.kind AND a.pattern = s.pattern AND added
        AND fetched >= since AND (until IS NULL OR fetched < until)),
gathered AS (
    SELECT r, count(*) AS n, array_to_string(list_sort(list_distinct(list(list))), ',') AS lists,
           string_agg(list || ' ' || kind || ' ' || pattern || ' ' || since::VARCHAR, chr(10)
                      ORDER BY list, kind, pattern, since) AS matched FROM hits GROUP BY r)
SELECT page_id, host, fetched::VARCHAR AS fetched, coalesce(n, 0) > 0 AS blocked,
       coalesce(n, 0)::BIGINT AS n_matches, coalesce(lists, '') AS lists, coalesce(matched, '') AS matched
FROM read LEFT JOIN gathered USING (r)
"""

OP9 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS size FROM items WHERE len(w) > 0),
wanted AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS said
    FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
placed AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM texts),
tried AS (
    SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS said
    FROM placed, (SELECT DISTINCT size FROM sized) WHERE i + size - 1 <= len(w)),
found AS (SELECT r, i, size, item_id FROM tried JOIN wanted USING (size, said)),
hit AS (
    SELECT r, count(DISTINCT j)::BIGINT AS n
    FROM (SELECT r, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r),
listed AS (
    SELECT r, count(*)::BIGINT AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
       coalesce(l.n, 0)::BIGINT AS n_items, sha256(coalesce(l.items, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN hit h USING (r) LEFT JOIN listed l USING (r)
"""

CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")


def _escaped_length(column: str) -> str:
    marks = " + ".join(f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}"
                       for c in ("\\", *CONTROL))
    return f"length({column}) + {marks}"


OP1 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
joined AS (
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
           coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS learnt,
           sum({len("<|turn|><|text|><|end|>")} + {_escaped_length("role")}
               + {_escaped_length("text")})::BIGINT AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
       sha256(learnt) AS loss_sha256, formatted_chars FROM joined
"""

OP2 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM texts WHERE len(h) >= 200),
said AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM windows),
later AS (
    SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM said)
    WHERE n > 1),
edges AS (
    SELECT r, i, coalesce(i > lag(i) OVER one + 100, true) AS new FROM later
    WINDOW one AS (PARTITION BY r ORDER BY i)),
runs AS (
    SELECT r, min(i) AS a, max(i) + 100 AS b
    FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM edges) GROUP BY r, k),
gaps AS (
    SELECT r, a, b, coalesce(lag(b) OVER one, 0) AS before, lead(a) OVER one IS NULL AS final
    FROM runs WINDOW one AS (PARTITION BY r ORDER BY a)),
kept AS (
    SELECT r, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
           string_agg(substr(h, 2 * before + 1, 2 * (a - before))
                      || CASE WHEN final THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS h
    FROM gaps JOIN texts USING (r) GROUP BY r)
SELECT doc_id, (len(t.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (r)
"""

#: The tables' pages have one article each; of inline markup, they have b, and br at the ends of blocks.
OP11 = r"""
WITH bodies AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS h FROM pages),
marked AS (
    SELECT page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS h FROM bodies),
texts AS (
    SELECT page_id, url, trim(regexp_replace(
        replace(replace(replace(replace(h, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'),
        '[\x20\x09-\x0D]+', ' ', 'g')) AS text FROM marked)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM texts
"""

OP12 = """
WITH sound AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
    SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM sound a JOIN sound b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
    SELECT * FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.score DESC, n.vec_id, n.other)::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN met n ON n.r = p.r AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLE = {
    "op1_chat_formatting": OP1,
    "op2_suffix_array_dedup": OP2,
    "op5_quality_rules": OP5,
    "quality_rules_ablation": _ablation(),
    "op8_url_filters": OP8,
    "op9_benchmark_decontamination": OP9,
    "op11_html_extraction": OP11,
    "op12_hard_negatives": OP12,
}
