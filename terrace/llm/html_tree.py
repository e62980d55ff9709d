"""Pages as trees of blocks: a tolerant reading of HTML, with what is needed to tell blocks apart.

Only elements that make blocks, and inline ones that are no part of a text, become nodes; other
inline markup is passed over, so that words it stands in stay whole. Missing and surplus end tags are
taken as browsers take them.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|</[^a-zA-Z][^>]*+>?
    |<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)>?""", re.S | re.X)
ATTRIBUTE = re.compile(
    r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""",
    re.I)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are no markup; what is in them is never part of a text.
RAW = set("iframe noembed noframes noscript script style textarea title xmp".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td template tfoot th thead tr ul""".split())
#: Blocks that are neither menus, forms nor asides but can't be in a paragraph either.
NO_TEXT = set("""aside audio button canvas datalist dialog footer form head header input map menu nav object
    search select svg template video""".split())
ROLES = set("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status
    tablist toolbar""".split())
#: Words of class names and ids that name something beside the article.
BESIDE = set(
    """ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments
    commentlist consent cookie cookies disqus foot footer gdpr header login masthead menu menus modal nav navbar
    navigation newsletter notice notices notification overlay pager pagination popup promo promotion recommended
    related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription toolbar widget widgets""".split())
#: Words that name the article or what holds it.
ARTICLE = set("article content entry main post story".split())
#: A class such as `no-sidebar` speaks of the page.
ABOUT_PAGE = set("has is no with without".split())
#: An open element on the right ends where one on the left begins, up to the barriers.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set())}
CELLS = {"td", "th", "caption", "table"}
PARAGRAPH = {"p"}, {"button", *CELLS}
IN_TABLE = {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}
#: Deeper elements lend their text to the one at this depth.
DEPTH = 150


class Node:
    """An element, or a run of text (tag `#`) with the number of its characters inside links."""

    __slots__ = ("tag", "label", "beside", "kids", "text", "linked", "item")

    def __init__(self, tag: str, label: str, beside: bool, text: str = "", linked: int = 0):
        self.tag, self.label, self.beside, self.text, self.linked = tag, label, beside, text, linked
        self.kids: list[Node] = []
        self.item = None


@lru_cache(1 << 14)
def described(tag: str, attributes: str) -> tuple[str, bool]:
    """An element's label, and whether it is something beside the article."""
    found = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape("".join(values)))
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    label = ".".join([tag, *sorted({re.sub(r"\d+", "", n).lower() for n in names})])
    if tag in NO_TEXT or tag in RAW:
        return label, True
    if tag in ("html", "body"):
        return label, False
    hidden = ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
              or "display:none" in found.get("style", "").replace(" ", "").lower())
    for name in names:
        words = {w.lower() for w in WORD.findall(name)}
        if tag in ("article", "main"):
            hidden = hidden or name.lower() in BESIDE or name.lower().startswith("comment")
        elif words & BESIDE and not words & ABOUT_PAGE and not (words & BESIDE == {"header"} and words & ARTICLE):
            hidden = True
    return label, hidden or bool(ROLES & set(found.get("role", "").lower().split()))


def names_article(names: list[str]) -> bool:
    return any(ARTICLE & {w.lower() for w in WORD.findall(name)} for name in names)


def parse(page: str) -> Node:
    """The tree of a page's blocks and texts."""
    root = Node("", "", False)
    stack: list[tuple[str, Node]] = [("", root)]
    at, link, glue = 0, False, False

    def say(raw: str) -> None:
        nonlocal glue
        text = html.unescape(raw) if "&" in raw else raw
        kids = stack[-1][1].kids
        # A word goes on after inline elements that are no part of it.
        last = next((k for k in reversed(kids) if not k.beside or k.tag in BLOCKS), None) if glue else None
        if last is not None and last.tag == "#":
            last.text += text
        else:
            kids.append(last := Node("#", "#", False, text))
        if link:
            last.linked += len(text)
        glue = True

    def close(depth: int) -> None:
        nonlocal glue
        if any(tag in BLOCKS for tag, _ in stack[depth:]):
            glue = False
        del stack[depth:]

    def opened(names: set[str], barriers: set[str]) -> int | None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                return k
            if stack[k][0] in barriers:
                return None
        return None

    while True:
        token = TOKEN.search(page, at)
        start = token.start() if token else len(page)
        if start > at:
            say(page[at:start])
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if token[1]:  # an end tag
            if tag == "a":
                link = False
            if tag in BLOCKS:
                glue = False
            k = opened({tag}, set() if tag in IN_TABLE else CELLS)
            if k is not None and tag not in ("html", "body"):
                close(k)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag == "a":
            link = True
        label, beside = described(tag, token[3])
        if tag not in BLOCKS and not beside:
            continue
        if tag in BLOCKS:
            glue = False
            if (k := opened(*PARAGRAPH)) is not None:
                close(k)
            if tag in HEADINGS and stack[-1][0] in HEADINGS:
                close(len(stack) - 1)
            if tag != "head" and stack[-1][0] == "head":
                close(len(stack) - 1)
            while tag in ENDS and (k := opened(*ENDS[tag])) is not None:
                close(k)
        if tag in ("html", "body") and any(open_ == tag for open_, _ in stack):
            continue
        parent = stack[-1][1]
        if tag in VOID:
            continue
        if len(stack) > DEPTH and not beside:
            stack.append((tag, parent))
            continue
        node = Node(tag, label, beside)
        parent.kids.append(node)
        if tag in ("article", "main") and not beside:  # a form round the whole page is no form
            for form in (n for open_, n in stack if open_ == "form"):
                form.tag = form.label = "div"
                form.beside = False
        stack.append((tag, node))
        if tag in BLOCKS:
            glue = False
    return root
