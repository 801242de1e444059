"""Main text of web pages by tree scoring.

A page becomes a tree of elements. Paragraph-like blocks earn points for their length and
commas and hand them to their ancestors, halved with each step up; a container's points are
discounted by the share of its text that is links. The best container is kept whole, and
what lies around it unless it is mostly links, less everything that is chrome: menus,
headers, footers, side bars, notices, adverts, forms, scripts, comments.

Pages are independent: they run in Arrow batches where they lie, nothing is shuffled.

Defined cases: null and empty pages, and pages without text outside chrome, give an empty
text; of chrome by name alone, what outweighs the rest of the page is taken for its article.
Broken markup is closed as a browser would for the common cases; a tag that never
ends is dropped with what follows it. Repeated rows come back as they are; extra columns
are ignored.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush
from html import unescape
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.batches import filled, map_batches

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas".split())
CHROME = frozenset(
    "head nav header footer aside form button select option label fieldset menu dialog annotation annotation-xml".split()) | RAW
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
# Names that mark an element as chrome. The text of the first kind is never an article's unless
# next to nothing else is left; the second kind yields to text that outweighs the rest.
STRONG = re.compile(
    r"(?:^|[_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promos?|promotion\w*|promoted|breadcrumbs?|foot|footer\w*|masthead|"
    r"navi?|navs|navbar\w*|navigation\w*|navmenu|navlinks?|comments?|comment(?:list|form|box|area|section)\w*|replies|disqus|"
    r"cookies?(?:bar|banner|notice|consent\w*)?|consent|popup|modal|newsletter|subscribe|signup|pagination|pager|login)(?:$|[_-])")
WEAK = re.compile(
    r"(?:^|[_-])(?:banner|sidebar|side|menu|header|notice|alert|share|sharing|social|related|recommend\w*|widget|toolbar|"
    r"skip)(?:$|[_-])")
# Names that overrule them: those of an article, and those that only say what a layout has.
ARTICLE = re.compile(r"(?:^|[_-])(?:article|content|contents|main|post|entry|story|body|text|prose|page)(?:$|[_-])")
LAYOUT = re.compile(r"(?:^|[_-])(?:has|no|not|with|without)[_-]")
# Text of a name of the first kind must be so many times the rest; links' share of a menu's text.
OUTWEIGHS = 20
LINKS = 0.5
LIKELY_TAGS = {"article": 25.0, "main": 20.0, "section": 3.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "body": 0.0,
               "form": -10.0, "ul": -5.0, "ol": -5.0, "li": -5.0, "th": -5.0}
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?P<done>>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][^>]*)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)


class Element:
    __slots__ = ("tag", "parent", "children", "chrome", "named", "article", "points", "own", "link", "blocky")

    def __init__(self, tag: str, parent: "Element | None", chrome: bool):
        self.tag, self.parent, self.chrome = tag, parent, chrome
        self.named = 0  # how many times the rest its text must be, if its name is one of chrome
        self.article = tag in ("article", "main")
        self.children: list["Element | str"] = []
        self.points = 0.0
        self.own: tuple[int, int, int] | None = None
        self.link = self.blocky = False


def _is_hidden(rest: str) -> bool:
    for name, *values in NAMES.findall(rest):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in CHROME_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _set_names(node: Element, rest: str) -> None:
    """Sets ``named`` and ``article`` from the names in class and id."""
    names = " ".join("".join(values).lower() for name, *values in NAMES.findall(rest) if name.lower() in ("class", "id")).split()
    for name in names:
        if LAYOUT.search(name):
            continue
        if STRONG.search(name):
            node.named = OUTWEIGHS
        elif WEAK.search(name):
            node.named = node.named or 1
        elif ARTICLE.search(name):
            node.article = True


def parse(html: str) -> Element:
    root = here = Element("#root", None, False)
    at, end = 0, len(html)
    while at < end:
        found = TOKEN.search(html, at)
        if not found:
            if here.tag == "head":
                here = here.parent
            here.children.append(unescape(html[at:]))
            break
        if found.start() > at:
            text = unescape(html[at:found.start()])
            if here.tag == "head" and text.strip():
                here = here.parent
            here.children.append(text)
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if not found["done"]:
            break
        if found["close"]:
            node = here
            while node.parent and node.tag != tag and not (node.tag in BLOCKS and tag not in BLOCKS):
                node = node.parent
            if node.parent and node.tag == tag:
                here = node.parent
            continue
        if here.tag == "head" and tag not in IN_HEAD:  # its end tag may be left out
            here = here.parent
        if tag in ENDS_P or tag in CLOSES:
            node, stop = here, CLOSES.get(tag, set())
            while node.parent and node.tag != "p" and node.tag not in stop and node.tag not in BLOCKS:
                node = node.parent
            if node.parent and (node.tag in stop or node.tag == "p" and tag in ENDS_P):
                here = node.parent
        if tag == "br":
            here.children.append("\n")
        if tag in VOID:
            if tag == "hr":
                here.children.append(Element("hr", here, False))
            continue
        free = tag in ("body", "html", "article", "main")
        node = Element(tag, here, here.chrome or tag in CHROME or not free and _is_hidden(found["rest"]))
        if not free and not node.chrome and found["rest"]:
            _set_names(node, found["rest"])
        here.children.append(node)
        if tag in RAW:  # its content is no markup; it ends at its own end tag only
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.end() if close else end
        elif not found["rest"].endswith("/") or tag in BLOCKS:
            here = node
    return root


def _elements(root: Element) -> list[Element]:
    """Elements outside chrome, parents before children, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Element) and not c.chrome)
    return found


def _measure(elements: list[Element]) -> None:
    """Sets ``own``: (characters, of these in links, commas) of the text outside chrome below
    each element, and ``blocky``: whether a block lies below it."""
    for node in elements:
        node.link = node.tag == "a" or node.parent is not None and node.parent.link
        texts = [c for c in node.children if isinstance(c, str)]
        n = sum(len(" ".join(t.split())) for t in texts)
        node.own = (n, n * node.link, sum(t.count(",") for t in texts))
        node.blocky = False
    for node in reversed(elements[1:]):
        up = node.parent
        up.own = tuple(a + b for a, b in zip(up.own, node.own))
        up.blocky = up.blocky or node.blocky or node.tag in BLOCKS


def _named_below(node: Element) -> list[Element]:
    """The uppermost elements below ``node`` that have a name of chrome."""
    found, stack = [], [c for c in node.children if isinstance(c, Element)]
    while stack:
        below = stack.pop()
        if below.chrome:
            continue
        if below.named:
            found.append(below)
        else:
            stack.extend(c for c in below.children if isinstance(c, Element))
    return found


def _prose(node: Element) -> int:
    chars, linked, _ = node.own or (0, 0, 0)
    return chars - linked


def _settle_names(root: Element) -> bool:
    """Makes those named like chrome chrome, save where they are called an article's too and are
    no menu, or where their text outside links outweighs what is left of the page. Tells whether any are."""
    queue, rest, dropped = [], _prose(root), False
    order = count()

    def put(node: Element) -> int:
        below = _named_below(node)
        for n in below:
            heappush(queue, (not n.article or _is_menu(n), -_prose(n), next(order), n))
        return sum(map(_prose, below))

    rest -= put(root)
    while queue:
        doubtful, _, _, node = heappop(queue)
        if not doubtful or _prose(node) > node.named * rest:
            rest += _prose(node) - put(node)
        else:
            node.chrome = dropped = True
    return dropped


def _is_menu(node: Element) -> bool:
    chars, linked, _ = node.own or (0, 0, 0)
    return chars > 0 and linked > LINKS * chars


def _best(elements: list[Element]) -> Element | None:
    candidates: dict[int, Element] = {}
    for node in elements:
        is_paragraph = node.tag in PARAGRAPHS or node.tag in ("div", "section", "article", "main") and not node.blocky
        if not is_paragraph or not node.own or not node.own[0]:
            continue
        chars, _, commas = node.own
        points = 1.0 + commas + min(chars / 100, 3.0)
        up, share = node.parent, 1.0
        while up is not None and up.tag not in ("#root", "html") and share > 1e-6:
            if id(up) not in candidates:
                candidates[id(up)] = up
                up.points = LIKELY_TAGS.get(up.tag, 0.0)
            up.points += points * share
            up, share = up.parent, share / 2
    if not candidates:
        return None
    return max(candidates.values(), key=_discounted)


def _discounted(node: Element) -> float:
    chars, linked, _ = node.own or (0, 0, 0)
    return node.points * (1 - linked / chars) if chars else 0.0


def _drop_menus(best: Element) -> None:
    """Siblings of the best container and of its ancestors that are mostly links become chrome;
    all else stays, whatever its length or tag, and so do an article's links within a line."""
    node = best
    while node.parent is not None:
        up = node.parent
        for other in up.children:
            if isinstance(other, Element) and other is not node and not other.chrome and _is_menu(other):
                other.chrome = not up.article or other.tag in BLOCKS
        node = up


def _blocks(root: Element) -> list[list[str]]:
    """The pieces of text of each block below ``root``; a nested block splits the one around it."""
    out: list[list[str]] = [[]]
    stack: list[Element | str | None] = [root]
    while stack:
        node = stack.pop()
        if node is None:
            out.append([])
        elif isinstance(node, str):
            out[-1].append(node)
        elif not node.chrome or node is root:
            if node.tag in BLOCKS:
                out.append([])
                stack.append(None)
            stack.extend(reversed(node.children))
    return out


def main_text(html: str) -> str:
    root = parse(html)
    elements = _elements(root)
    _measure(elements)
    if _settle_names(root):
        elements = _elements(root)
        _measure(elements)
    best = _best(elements)
    if best is not None:
        _drop_menus(best)
    texts = (" ".join("".join(parts).split()) for parts in _blocks(root))
    return " ".join(t for t in texts if t)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(h) for h in filled(batch.column("html")).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return step

    kinds = dict(pages.dtypes)
    return map_batches(pages.select("page_id", "url", F.col("html").cast("string").alias("html")), make,
                       f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
