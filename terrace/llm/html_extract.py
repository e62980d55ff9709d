"""Main texts of pages, by wrappers: union-free regular expressions inferred from a host's pages.

A page is a stream of tokens, read as nested sequences of elements and texts. Within a page, runs
that repeat become repeated groups, from the innermost elements outward. The page is then aligned with
what its host's earlier pages have given: texts that differ become slots, elements that only one side has
become optional; a mismatch is resolved by looking ahead on both sides and skipping the shorter stretch. The
result, without alternatives, is the host's wrapper, with what its slots have held: how much text, how
much of it in links, and whether it was always the same.

A wrapper names the element that holds the article: one that says so by its tag or its name or, failing
that, the deepest one with nearly all text that varies. Each page is aligned with its host's
wrapper, and the texts at and below that element are its main text, without what is marked as menu, form,
notice, advert or comment. Elements that a wrapper doesn't know are judged by the page alone.

Tasks build wrappers of the hosts among their own rows and give them out, at most `HOSTS` at a time; those
of a host are aligned with each other one after the other as they stream by, so that a host with a third
of all pages brings few rows and no group. A wrapper that has grown beyond `ITEMS` elements forgets
those that were on fewest pages; pages then meet them as elements that it doesn't know. Texts are whole.

Defined results for odd input: null and empty pages have the empty text; pages without an article, as far
as can be told, give what is left of them without the parts beside it; pages without a host are
judged alone; text outside elements counts as in the body; unclosed elements end with what they stand in;
repeated rows are extracted each; an empty table gives no rows; columns may have any names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrace.llm.html_tree import HEADINGS, Node, described, names_article, parse
from terrace.llm.texts import pieces
from terrace.llm.url_filters import host
from terrace.session import cut_lineage

HOSTS = 500
ITEMS = 2000
#: Longest repeated group, in elements.
SQUARE = 4
#: Pages from which a text that is always the same is taken as part of the template.
FEW = 3
#: Letters of a repeated group's digests, 16 a text; a longer one is not compared with other pages'.
SAID = 256
#: Share of the varying text that the element holding the article has.
NEARLY_ALL = 0.8
LEAVES = HEADINGS | set("# p li tr td th dt dd option br hr".split())


class Item:
    """An element, a slot of text (`#`) or a group of a wrapper, and what it has held."""

    __slots__ = ("label", "optional", "many", "pages", "chars", "linked", "said", "kids", "nodes")

    def __init__(self, label: str, optional=False, many=False, pages=1, chars=0, linked=0, said=None, kids=(), nodes=()):
        self.label, self.optional, self.many, self.pages = label, optional, many, pages
        self.chars, self.linked, self.said = chars, linked, said
        self.kids, self.nodes = list(kids), list(nodes)

    def packed(self) -> list:
        return [self.label, int(self.optional) + 2 * int(self.many), self.pages, self.chars, self.linked, self.said,
                [k.packed() for k in self.kids]]


def unpacked(row: list) -> Item:
    label, flags, pages, chars, linked, said, kids = row
    return Item(label, bool(flags & 1), bool(flags & 2), pages, chars, linked, said, map(unpacked, kids))


def _shape(item: Item) -> list:
    return [item.label, [_shape(k) for k in item.kids]]


def _alike(a: Item, b: Item) -> bool:
    """Whether two neighbours repeat each other: nameless containers have to be built alike."""
    if a.label != b.label:
        return False
    return a.label in LEAVES or "." in a.label or _shape(a) == _shape(b)


def _joined(a: Item, b: Item, repeats: bool) -> None:
    """`b` becomes another instance of `a`: the next one of a repeated group, or that of another page."""
    a.pages = max(a.pages, b.pages) if repeats else a.pages + b.pages
    a.chars, a.linked = a.chars + b.chars, a.linked + b.linked
    if repeats:
        a.said = a.said + b.said if a.said and b.said and len(a.said) < SAID else None
    elif a.said != b.said:
        a.said = None
    a.optional, a.many = a.optional or b.optional, a.many or b.many
    a.nodes += b.nodes
    a.kids = aligned(a.kids, b.kids, repeats)


def folded(items: list[Item]) -> list[Item]:
    """The sequence with neighbouring equal stretches as one repeated element or group."""
    for k in range(1, SQUARE + 1):
        out: list[Item] = []
        for item in items:
            out.append(item)
            # What stands at the end repeats the stretch before it.
            if len(out) >= 2 * k and all(_alike(a, b) for a, b in zip(out[-2 * k:-k], out[-k:])):
                for a, b in zip(out[-2 * k:-k], out[-k:]):
                    _joined(a, b, True)
                del out[-k:]
                if k == 1:
                    out[-1].many = True
                else:
                    out[-k:] = [_group(out[-k:])]
            elif k > 1 and len(out) > k and out[-k - 1].label == _name(out[-k:]):
                for a, b in zip(out[-k - 1].kids, out[-k:]):
                    _joined(a, b, True)
                del out[-k:]
        items = out
    return items


def _name(items: list[Item]) -> str:
    return "(" + " ".join(i.label for i in items) + ")"


def _group(items: list[Item]) -> Item:
    return Item(_name(items), many=True, pages=max(i.pages for i in items), kids=items)


def _matches(a: list[Item], b: list[Item]) -> Iterator[tuple[Item | None, Item | None]]:
    """Items of both sequences in their order, side by side where they match."""
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i].label == b[j].label:
            yield a[i], b[j]
            i, j = i + 1, j + 1
            continue
        ahead_a = next((k for k in range(i + 1, len(a)) if a[k].label == b[j].label), None)
        ahead_b = next((k for k in range(j + 1, len(b)) if b[k].label == a[i].label), None)
        skip_a = ahead_a is not None and (ahead_b is None or ahead_a - i <= ahead_b - j)
        stop_a = ahead_a if skip_a else i + (ahead_b is None)
        stop_b = j if skip_a else ahead_b if ahead_b is not None else j + 1
        for k in range(i, stop_a):
            yield a[k], None
        for k in range(j, stop_b):
            yield None, b[k]
        i, j = stop_a, stop_b
    for item in a[i:]:
        yield item, None
    for item in b[j:]:
        yield None, item


def aligned(a: list[Item], b: list[Item], repeats: bool = False) -> list[Item]:
    """One sequence for both: `b`'s items are joined to `a`'s, or become optional beside them."""
    out = []
    for x, y in _matches(a, b):
        if x and y:
            _joined(x, y, repeats)
            out.append(x)
        else:
            one = x or y
            one.optional = True
            out.append(one)
    return out


def expression(node: Node, keep: bool = True) -> Item:
    """The union-free expression of one element; with `keep`, its items know the nodes they come from."""
    nodes = [node] if keep else []
    if node.tag == "#":
        text = " ".join(node.text.split())
        said = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).hexdigest()
        return Item("#", chars=len(text), linked=min(node.linked, len(text)), said=said, nodes=nodes)
    kids = [expression(k, keep) for k in node.kids if k.tag != "#" or k.text.strip()]
    return Item(node.label, kids=folded(kids), nodes=nodes)


def _walk(item: Item) -> Iterator[Item]:
    yield item
    for kid in item.kids:
        yield from _walk(kid)


def pruned(wrapper: Item) -> Item:
    """The wrapper without the elements on fewest pages, if it has grown too large."""
    while (size := sum(1 for _ in _walk(wrapper))) > ITEMS:
        rare = sorted(i.pages for i in _walk(wrapper))[size // 4]
        if rare >= wrapper.pages:
            return wrapper
        for item in _walk(wrapper):
            item.kids = [k for k in item.kids if k.pages > rare]
    return wrapper


def merged(wrapper: Item | None, other: Item) -> Item:
    if wrapper is None:
        return other
    wrapper.kids = aligned(wrapper.kids, other.kids)
    wrapper.pages += other.pages
    return wrapper


class Wrapper:
    """A host's expression, and which of its elements hold the article."""

    def __init__(self, root: Item, beside: dict[int, bool], says: dict[int, str]):
        self.root, self.beside, self.says = root, beside, says
        self.known = root.pages >= FEW
        self.holds = {id(i) for i in self._chosen()}
        #: No element says that it holds the article.
        self.loose = not any(says[i] for i in self.holds)

    def fixed(self, slot: Item | None) -> bool:
        return self.known and slot is not None and slot.said is not None and slot.pages >= FEW

    def varying(self, item: Item) -> int:
        """Characters of text outside links that aren't the same on all pages."""
        if self.beside.get(id(item)):
            return 0
        own = 0 if item.label != "#" or self.fixed(item) else item.chars - item.linked
        return own + sum(map(self.varying, item.kids))

    def _outermost(self, wanted) -> list[Item]:
        out, todo = [], [self.root]
        while todo:
            item = todo.pop()
            if self.beside.get(id(item)):
                continue
            if wanted(item):
                out.append(item)
            else:
                todo += item.kids
        return out

    def _chosen(self) -> list[Item]:
        for tag in ("article", "main"):
            if found := self._outermost(lambda i: self.says.get(id(i)) == tag):
                return found
        named = self._outermost(lambda i: self.says.get(id(i)) == "named")
        found = max(named, key=self.varying, default=None)
        if found is not None and self.varying(found) * 2 >= self.varying(self.root):
            return [found]
        item, most = self.root, NEARLY_ALL * self.varying(self.root)
        while True:
            inner = max(item.kids, key=self.varying, default=None)
            if inner is None or inner.label == "#" or inner.many or self.varying(inner) < most:
                return [item]
            item = inner


def _of(label: str) -> tuple[bool, str]:
    """Whether an element of a wrapper is beside the article, and what it says of holding it."""
    tag, *names = label.split(".")
    if tag == "#" or tag.startswith("(") or not tag:
        return False, ""
    beside = described(tag, f' class="{" ".join(names)}"')[1]
    says = tag if tag in ("article", "main") else "named" if names_article(names) else ""
    return beside, says


def judged(root: Item) -> Wrapper:
    beside, says = {}, {}
    for item in _walk(root):
        beside[id(item)], says[id(item)] = _of(item.label)
    return Wrapper(root, beside, says)


@lru_cache(256)
def _loaded(packed: str) -> Wrapper:
    return judged(unpacked(json.loads(packed)))


def _assign(item: Item, page: Item) -> None:
    """Tells the page's nodes which elements of the wrapper they are."""
    for node in page.nodes:
        node.item = item
    for known, here in _matches(item.kids, page.kids):
        if known and here:
            _assign(known, here)


def _texts(node: Node, wrapper: Wrapper, inside: bool, header: bool) -> Iterator[str]:
    """Texts at and below a node that belong to the article, in the page's order."""
    inside = inside or id(node.item) in wrapper.holds
    if node.tag == "#":
        if not inside or header or wrapper.loose and (wrapper.fixed(node.item) or 2 * node.linked > len(node.text)):
            return
        yield node.text
    elif node.beside and (node.tag != "header" or not inside or wrapper.loose):
        return
    else:
        # Of a header inside the article, its headings are part of it.
        header = node.beside or header and node.tag not in HEADINGS
        for kid in node.kids:
            yield from _texts(kid, wrapper, inside, header)


def main_text(page: str, packed: str | None = None) -> str:
    """The main text of a page, given its host's wrapper or none."""
    tree = parse(page)
    own = expression(tree)
    for wrapper in ([_loaded(packed)] if packed else []) + [judged(own)]:
        _assign(wrapper.root, own)
        said = [" ".join(text.split()) for text in _texts(tree, wrapper, False, False)]
        if any(said):
            return " ".join(filter(None, said))
    return ""


def _learnt(hosts: int):
    """(host, part, wrapper): the wrappers of the hosts among a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Item] = {}
        part = 0

        def given() -> pa.RecordBatch:
            nonlocal part
            part += 1
            rows = [pa.array(list(known), pa.string()), pa.array([part] * len(known), pa.int64()),
                    pa.array([json.dumps(pruned(w).packed()) for w in known.values()], pa.string())]
            known.clear()
            return pa.RecordBatch.from_arrays(rows, ["host", "part", "wrapper"])
        for batch in pieces(batches, "html"):
            for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if name and page:
                    known[name] = merged(known.get(name), expression(parse(page), keep=False))
                    if known[name].pages % 64 == 0:
                        pruned(known[name])
                    if len(known) > hosts:
                        yield given()
        yield given()
    return run


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host, from rows sorted by host."""
    now, wrapper = None, None
    for batch in batches:
        for name, packed in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            if name != now and wrapper is not None:
                yield pa.RecordBatch.from_pydict({"host": [now], "wrapper": [json.dumps(wrapper.packed())]})
            wrapper = pruned(merged(wrapper if name == now else None, unpacked(json.loads(packed))))
            now = name
    if wrapper is not None:
        yield pa.RecordBatch.from_pydict({"host": [now], "wrapper": [json.dumps(wrapper.packed())]})


def wrappers(pages: DataFrame, url: str = "url", html: str = "html", hosts: int = HOSTS) -> DataFrame:
    """(host, wrapper): every host's expression, as JSON. Stored."""
    rows = pages.select(host(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").cast("string").alias("html"))
    parts = rows.mapInArrow(_learnt(hosts), "host string, part long, wrapper string")
    key = ["host", "task", "part"]
    return cut_lineage(
        parts.withColumn("task", F.spark_partition_id()).repartition("host").sortWithinPartitions(*key)
        .select("host", "wrapper").mapInArrow(_together, "host string, wrapper string"))


def extracted(pages: DataFrame, url: str = "url", html: str = "html", hosts: int = HOSTS) -> DataFrame:
    """(row, text): each row of `pages` as a struct without the html, and its main text.

    The wrappers are a stored table, so Spark knows their size: it broadcasts them if they are small,
    and else splits the pages of a host that holds very many.
    """
    known = wrappers(pages, url, html, hosts)
    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != html)).alias("row"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
        F.coalesce(host(F.col(f"`{url}`")), F.lit("")).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            said = [main_text(page, packed) for page, packed in zip(
                batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(said, pa.string())], ["row", "text"])

    schema = StructType([rows.schema["row"], StructField("text", StringType())])
    return rows.join(known, "host", "left").select("row", "html", "wrapper").mapInArrow(run, schema)
