"""HTML extraction, hard negatives and conversation repair: registered queries and small cases."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm import brute
from terrace.llm import hard_negatives, html_extract, repair
from terrace.llm.queries import QUERIES, damaged

from pyspark.sql import functions as F


def test_repair_query_against_all_edits(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    after, ids = brute.damaged(rows)
    by_conv = defaultdict(list)
    for conv, turn, role, text in after:
        by_conv[conv].append((turn, role, text))
    found = {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()}
    assert found == {conv: brute.conversation(sorted(by_conv[conv])) for conv in ids}


def _plain(symbols):
    """Rows (role, text, fault) whose letters are `symbols`."""
    role = {"s": "system", "u": "user", "a": "assistant", "o": "other", "-": "user"}
    return [(role[c.lower()], "x", "blank" if c == "-" else "truncated" if c.isupper() else "") for c in symbols]


def test_repair_in_blocks_is_the_cheapest_and_first():
    draw = random.Random(5)
    for _ in range(400):
        symbols = "".join(draw.choice("suaoSUAO-uaua") for _ in range(draw.randrange(9)))
        cost, audit, _ = brute.repaired(_plain(symbols))
        for block in (1, 2, 3, 64):
            assert repair._repair(symbols, block) == (cost, audit), symbols


def test_repair_of_long_conversations():
    draw = random.Random(6)
    symbols = "".join(draw.choice("suaoUA-") for _ in range(3000))
    assert repair.repair(symbols) == repair._repair(symbols, 1000)
    assert repair.repair("ua" * 50_000) == (0, "K" * 100_000)


def test_repair_of_odd_rows(spark, frame):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, "assistant", "Ok."), (None, 1, None, None),
            (2, 1, "", "x."), (2, 5, "system", "y"), (3, 0, "user", "dropped"), (4, 1, "user", "a." * 200_000),
            (4, 2, "assistant", "\x85.")]
    table = frame("conv_id long, turn long, role string, text string, copies int, CONV string, n int",
                  *((*r, 0 if r[3] == "dropped" else 1, "x", 1) for r in rows))
    found = {r.conv: r for r in repair.repaired(table, copies=F.col("copies")).collect()}
    assert set(found) == {None, 1, 2, 3, 4}
    assert (found[1].audit, found[1].duplicate, found[1].gaps, found[1].illegal) == ("IKKDI", 1, 0, 1)
    assert (found[3].audit, found[3].cost, found[3].repaired_sha256) == ("", 0, hashlib.sha256().hexdigest())
    assert (found[None].audit, found[None].blank, found[None].cost) == ("D", 1, 4)
    assert (found[2].audit, found[2].cost, found[2].gaps) == ("DD", 8, 3)
    assert found[4].repaired_sha256 == brute.sha("user:" + "a." * 200_000 + "\nassistant:\x85.")
    empty = table.limit(0)
    assert repair.repaired(empty).count() == 0


def test_exact_products_of_remainders():
    draw = np.random.default_rng(1)
    for dims, most in ((1, 30), (64, 256), (700, 9000)):
        a, b = (draw.integers(-most, most + 1, (n, dims)).astype(float) for n in (7, 11))
        bound = int(max((a * a).sum(1).max(), (b * b).sum(1).max())) + 1
        moduli = hard_negatives.primes(dims, bound)
        got = hard_negatives.scores(*([hard_negatives.residues(x, p) for p in moduli] for x in (a, b)), moduli)
        assert (got == a.astype(np.int64) @ b.astype(np.int64).T).all()


def _mined(rows):
    """Plain version over (id, label, vector) rows that take part."""
    out = []
    whole = [[int(np.floor(256 * x)) for x in v] for _, _, v in rows]
    last = lambda x: (x is None, x or 0)
    for a, (anchor, label, _) in enumerate(rows):
        if anchor is None or anchor % 100:
            continue
        met = [(-sum(x * y for x, y in zip(whole[a], whole[b])), last(rows[b][0]), b) for b in range(len(rows)) if b != a]
        same, others = (sorted(m for m in met if (rows[m[2]][1] == label) is wanted) for wanted in (True, False))
        for p, _, b in same[:5]:
            fitting = [m for m in others if 80 * -p <= 100 * -m[0] <= 100 * -p]
            out += [(anchor, rows[b][0], k, rows[c][0], -p, -n) for k, (n, _, c) in enumerate(fitting[:5], 1)]
    return out


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_hard_negatives_with_ties_and_odd_rows(spark, frame, block_bytes):
    draw = random.Random(2)
    rows = [(i if i % 17 else None, draw.randrange(3), [draw.choice([0.0, 0.01, 0.5, -0.25]) for _ in range(draw.choice([3, 4]))])
            for i in range(220)]
    rows += [rows[100], rows[100], (300, 1, []), (400, -2, [1.0, 0.0])]
    odd = [(100, None, [1.0]), (200, 1, None), (7, 1, [None, 1.0]), (8, 1, [float("nan")]), (9, 2, [float("inf")])]
    table = frame("vec_id long, label int, embedding array<float>, ID int, score string",
                  *((*r, 1, "x") for r in rows + odd))
    got = hard_negatives.mined(table, F.col("id") % 100 == 0, block_bytes=block_bytes)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got.collect()) == order(_mined(rows))
    assert hard_negatives.mined(table.limit(0), F.lit(True)).count() == 0


def extract(spark, frame, *pages):
    table = frame("page_id long, url string, html string, HOST string, text string",
                  *((i, url, html, "x", "y") for i, (url, html) in enumerate(pages)))
    found = html_extract.extracted(table).collect()
    return [r.text for r in sorted(found, key=lambda r: r.row.page_id)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies</div>
%s
<div class="sidebar"><p>Recent</p></div><section id="comments"><article class="comment">First!</article></section>
<footer>&copy; us</footer><script>var t="</article>";</script></body></html>"""


def test_articles_of_several_shapes(spark, frame):
    inner = """<h1>A &amp; B</h1><p>One <b>bo</b>ld &lt;word&gt;&nbsp;here<br>next<p>Two<span class="ad">Buy</span>s
        <form><input name=q>Search</form><ul><li>x<li>y</ul><aside>Aside</aside><table><tr><td>1<td>2</table><!-- no -->"""
    said = "A & B One bold <word> here next Twos x y 1 2"
    shapes = [f"<article>{inner}</article>", f"<main>{inner}</main>", f'<div class="entry-content">{inner}</div>',
              f'<form id="all"><article>{inner}</article></form>', f"<article><header>By me{inner}</header></article>"]
    texts = extract(spark, frame, *((f"http://h{i}.org/a", PAGE % s) for i, s in enumerate(shapes)))
    assert texts[:4] == [said] * 4
    assert texts[4] == "A & B"


def test_template_is_told_from_pages_of_one_host(spark, frame):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    page = lambda k: (f"<body><div><div>The Daily</div><div>Read us every day</div></div><div><div><h2>Title {k}</h2>"
                      + "".join(f"<p>{words(10 * k + j)}" for j in range(1 + k % 3)) + "</div></div><div>All rights reserved</div>")
    texts = extract(spark, frame, *(("https://one.example.org/p", page(k)) for k in range(6)))
    assert texts == [" ".join([f"Title {k}", *(words(10 * k + j) for j in range(1 + k % 3))]) for k in range(6)]


def test_equal_copies_keep_their_article(spark, frame):
    page = PAGE % "<article><h1>Same</h1><p>Always the same.</article>"
    assert extract(spark, frame, *[("http://h.org/", page)] * 5) == ["Same Always the same."] * 5


def test_odd_pages(spark, frame):
    deep = "<div>" * 3000 + "<article><p>deep</p></article>"
    long = "<article>" + "<p>word " * 50_000 + "</article>"
    pages = [(None, None), ("", ""), ("http://x.org", "just text"), ("http://x.org", "<p"), ("nonsense", "<article>a<b>b"),
             ("http://y.org", deep), ("http://y.org", long), ("http://z.org", "<article><p title=\"a>b\">q</p></article>"),
             ("http://z.org", "a < b <article>it's 1 < 2 &amp;am &nosuch; &#65;</article></p></div>"),
             ("http://z.org", "<script>never closed <article>x</article>")]
    texts = extract(spark, frame, *pages)
    assert texts == ["", "", "just text", "", "ab", "deep", "word " * 49_999 + "word", "q",
                     "it's 1 < 2 &am &nosuch; A", ""]
    assert extract(spark, frame) == []


def test_wrappers_are_union_free_expressions():
    root = None
    for page in ("<body><h1>a</h1><p>x<p>y<ul><li>1<li>2</ul>", "<body><h1>b</h1><p>z<div class=q>n</div><ul><li>3</ul>"):
        root = html_extract.merged(root, html_extract.expression(html_extract.parse(page), keep=False))
    body = root.kids[0]
    assert [(i.label, i.optional, i.many) for i in body.kids] == [
        ("h1", False, False), ("p", False, True), ("div.q", True, False), ("ul", False, False)]
    assert [(i.label, i.many) for i in body.kids[3].kids] == [("li", True)]
    assert body.kids[0].kids[0].said is None and body.kids[2].kids[0].said is not None
    square = html_extract.expression(html_extract.parse("<h2>a</h2><p>b<h2>c</h2><p>d<p>e<h2>f</h2><p>g"))
    assert [(i.label, i.many) for i in square.kids] == [("(h2 p)", True)]


def test_small_wrapper_parts_give_the_same_texts(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    few = {r.row.page_id: r.text for r in html_extract.extracted(pages, hosts=1).collect()}
    assert few == {r.page_id: r.text for r in QUERIES["op11_html_extraction"](spark, SMALL).collect()}
    assert all(re.search(r"\S", t) for t in few.values())
