"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, which
are discounted by the density of links in them; the best container is kept
with those siblings that score well too or read like prose.  Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are left out before, by element and by the words of class, id and
role.  An element whose words speak for it too, or that is an article or main
element, isn't left out for its words but scored.

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by one line feed.

Defined cases: null or empty html and pages without paragraphs of text give
an empty string; unclosed and stray tags are taken as browsers take them
(``p``, ``li`` and table cells close themselves); other columns are kept out;
repeated rows give repeated results.
"""

from __future__ import annotations

import html as _html
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchpulse.llm.tables import ship_package

SCHEMA = "page_id long, url string, text string, n_chars long"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value only after an equals sign; one that is never closed ends with the tag
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s/=>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_LETTERS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Elements whose text is never main text.
DROPPED = RAW | frozenset(
    "nav header footer aside button select option input label fieldset dialog menu svg math canvas object "
    "audio video head figure-caption".split()
)
BLOCK = frozenset(
    "html body p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption pre blockquote figure figcaption address center details summary hgroup form".split()
)
#: Words of a class, id or role that mark something other than the article.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion popup modal overlay "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar side rail aside widget "
    "footer foot header masthead topbar toolbar cookie cookies consent gdpr notice alert notification "
    "comment comments commentlist reply replies respond disqus discussion feedback share sharing social follow "
    "subscribe subscription newsletter signup login register search related recommended recommendations "
    "contentinfo complementary dialog skip hidden".split()
)
LIKELY = frozenset("article body content entry main page post story text blog".split())
#: Elements that the words of a class, id or role can leave out whole; those of
#: a paragraph, heading or inline element never do.
CONTAINERS = frozenset("div section ul ol dl table form article main details center address figure td tr".split())
#: Elements of which the text is that of paragraphs.
PARAGRAPHS = frozenset("p pre blockquote td li".split())
#: A form stays, and is scored like any other, if it has this share of the paragraphs' text.
FORM_SHARE = 0.5
#: Start tags that close an open element of these names first.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table tbody thead tfoot select div section article main body html td th".split())
#: A sibling stays if it has this share of the best score.
SIBLING_SHARE = 0.2


class Node:
    __slots__ = ("name", "parent", "items", "weight", "dropped", "chars", "links", "commas", "score", "listed")

    def __init__(self, name, parent, dropped=False, weight=0):
        self.name, self.parent, self.dropped, self.weight = name, parent, dropped, weight
        self.items: list = []  # text and nodes, in page order
        self.chars = self.links = self.commas = 0
        self.score = 0.0
        self.listed = False


def _marks(name: str, attrs: str) -> tuple[bool, int]:
    """Whether the attributes mark an element as not main text; its weight.
    Words of both kinds, and unlikely ones of an article or main element,
    leave it to the scoring."""
    found: dict[str, str] = {}
    for key, a, b, c in _ATTR.findall(attrs):
        found.setdefault(key.lower(), (a or b or c).lower())
    hidden = (
        bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")))
        or found.get("hidden", "false") != "false" or found.get("aria-hidden") == "true"
    )
    words = {w for key in ("class", "id", "role") for w in _LETTERS.findall(found.get(key, ""))}
    likely, unlikely = bool(words & LIKELY), bool(words & UNLIKELY)
    out = unlikely and not likely and name in CONTAINERS and name not in ("article", "main")
    return hidden or out, 25 * likely - 25 * unlikely


def parse(page: str) -> Node:
    """The page's tree, without what can never be main text."""
    root = node = Node("#page", None)
    at, end = 0, len(page)
    count: Counter[str] = Counter()  # open elements by name, so that no search goes up in vain

    def closed(up: Node) -> Node:
        """Close everything up to and including ``up``."""
        n = node
        while True:
            count[n.name] -= 1
            if n is up:
                return up.parent
            n = n.parent

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            node.items.append(page[at:])
            break
        if m.start() > at:
            node.items.append(page[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1]:
                node.items.append(_html.escape(m[1]))
            continue
        name = name.lower()
        if m[2]:  # an end tag closes the nearest open element of its name
            if count[name] > 0:
                up = node
                while up.name != name:
                    up = up.parent
                node = closed(up)
            elif name == "p":
                node.items.append(Node("p", node))
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name == "br":
            node.items.append(" ")
            continue
        if name in VOID or m[4].endswith("/") and name in ("path", "circle", "use"):
            continue
        if count["p"] > 0 and (name in BLOCK or name in DROPPED or name == "form"):
            up = node  # a block ends an open paragraph
            while up is not root and up.name not in SCOPE and up.name != "p":
                up = up.parent
            if up.name == "p":
                node = closed(up)
        if name in CLOSES and any(count[x] > 0 for x in CLOSES[name]):
            up = node
            while up is not root and up.name not in CLOSES[name] and up.name not in SCOPE - CLOSES[name]:
                up = up.parent
            if up.name in CLOSES[name]:
                node = closed(up)
        unlikely, weight = _marks(name, m[4]) if m[4] and name not in ("html", "body") else (False, 0)
        # a header inside an article holds its title
        never = name in DROPPED and not (name == "header" and count["article"] > 0)
        child = Node(name, node, never or unlikely, weight)
        node.items.append(child)
        count[name] += 1
        node = child
    _judge_forms(root)
    return root


def _judge_forms(root: Node) -> None:
    """Leave out forms, but for one that holds most of the page's paragraphs,
    as where a page is one form."""
    forms: list[list] = []  # each with its paragraphs' characters
    total = 0
    todo: list[tuple[Node, bool, tuple[int, ...]]] = [(root, False, ())]
    while todo:
        n, paragraph, inside = todo.pop()
        for x in n.items:
            if isinstance(x, str):
                size = len(x) if paragraph else 0
                total += size
                for f in inside:
                    forms[f][1] += size
            elif not x.dropped:
                within = inside
                if x.name == "form" and len(inside) < 8:  # forms do not nest; deeper ones go with the outer
                    within = (*inside, len(forms))
                    forms.append([x, 0])
                todo.append((x, paragraph or x.name in PARAGRAPHS, within))
    for form, size in forms:
        form.dropped = not total or size < FORM_SHARE * total


def _text(raw: str) -> str:
    return _html.unescape(raw) if "&" in raw else raw


def blocks(node: Node, out: list[str]) -> None:
    """The node's blocks of text, in page order."""
    line: list[str] = []

    def end():
        t = _SPACE.sub(" ", _text("".join(line))).strip()
        if t:
            out.append(t)
        line.clear()

    def walk(n: Node):
        for x in n.items:
            if isinstance(x, str):
                line.append(x)
            elif not x.dropped:
                if x.name in BLOCK:
                    end()
                    walk(x)
                    end()
                else:
                    walk(x)

    walk(node)
    end()


def _measure(n: Node, in_link: bool, scored: list[Node]) -> None:
    """Characters and link characters below each node, points for paragraphs."""
    has_block = False
    for x in n.items:
        if isinstance(x, str):
            n.commas += _text(x).count(",")
            size = len(x) if x.count(" ") < 2 else len(" ".join(x.split()))
            n.chars += size
            n.links += size if in_link else 0
        elif not x.dropped:
            _measure(x, in_link or x.name == "a", scored)
            n.chars += x.chars
            n.links += x.links
            n.commas += x.commas
            has_block |= x.name in BLOCK
    if n.name in ("p", "pre", "blockquote", "td", "h1", "h2", "h3", "li") or n.name in ("div", "section", "article", "main", "body") and not has_block:
        if n.chars:
            points = (1 + n.commas + min(n.chars / 100, 3)) * (1 - n.links / n.chars)
            if n.name in ("li", "h1", "h2", "h3"):
                points *= 0.25
            share, up = 1.0, n.parent if n.name not in ("div", "section", "article", "main", "body") else n
            level = 0
            while up is not None and level < 6:
                if not up.listed:
                    up.listed = True
                    scored.append(up)
                up.score += points * share
                level += 1
                share = 1.0 / (2 * level) if level < 2 else 1.0 / (3 * level)
                up = up.parent


def extract(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    root = parse(page)
    scored: list[Node] = []
    _measure(root, False, scored)
    best, top = None, 0.0
    for n in scored:
        if n.name in ("#page", "html") or not n.chars:
            continue
        value = (n.score + (n.weight if n.score > 0 else 0)) * (1 - n.links / n.chars)
        if n.name in ("article", "main"):
            value += 25
        n.score = value
        if value > top:
            best, top = n, value
    out: list[str] = []
    if best is None:
        blocks(root, out)
        return "\n".join(out)
    parent = best.parent
    if best.name in ("article", "main", "body") or parent is None or parent.name in ("html", "#page"):
        kept = [best]
    else:
        kept = [x for x in parent.items if isinstance(x, Node) and not x.dropped and (x is best or _keeps(x, top))]
    for n in kept:
        blocks(n, out)
    return "\n".join(out)


def _keeps(n: Node, top: float) -> bool:
    if not n.chars:
        return False
    density = n.links / n.chars
    if n.score * (1 - density) >= max(10.0, top * SIBLING_SHARE) or n.name in ("h1", "h2", "h3") and density < 0.3:
        return True
    return n.name in ("p", "pre", "blockquote", "ul", "ol", "table", "figure") and density < 0.3


def _extract_batches(batches):
    sys.setrecursionlimit(1_000_000)  # the walks follow the nesting of the page
    for batch in batches:
        texts = [extract(t) for t in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; no shuffle."""
    ship_package(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(_extract_batches, SCHEMA)
