"""Main text of web pages by tree scoring.

A page is read into a tree of elements (missing end tags are closed as
browsers do).  Elements that never hold the main text (scripts, styles, forms,
navigation, headers and footers of the page, and elements whose class or id
names an advert, a sidebar, a notice or comments) are cut; a paragraph or
heading inside an ``article`` or ``main`` goes only if its class or id names
nothing else (``ad-box`` goes, ``tag-line`` stays).  Each paragraph
then gives points for its length and its commas to its ancestors, the nearer
the more; a container's points are discounted by the share of its text that
stands in links.  The best container is kept, together with the siblings that
score near it, or, like headings and longer paragraphs without links, read
like it.  An ``article`` or ``main`` element around the best container is taken
whole, and so is the page's only one if it has a quarter of the best's points.

Block elements end a piece of text, inline ones don't; white space inside a
block becomes one space and blocks are joined by one.

Defined cases: a null, empty or text-free page gives the empty text; a page
without any element is one block; unknown elements are inline containers;
character references are decoded once; ties go to the element that starts first.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import small_batches

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'=]|=\s*(?:\"[^\"]*\"|'[^']*')?|[\"'])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_SPACE = re.compile(r"\s+")

# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure",
         "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CUT = RAW | {"nav", "footer", "aside", "form", "button", "select", "option", "input", "svg", "math", "object", "embed", "canvas", "audio", "video", "map", "dialog", "menu", "head", "search"}
CLOSES_P = BLOCK - {"body", "html", "head", "caption", "legend", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt"} | {"li", "dd", "dt"}
INSIDE = {"li": ("li", {"ul", "ol", "menu", "dir"}), "dt": (("dt", "dd"), {"dl"}), "dd": (("dt", "dd"), {"dl"}), "tr": (("tr", "td", "th"), {"table"}),
          "td": (("td", "th"), {"tr", "table"}), "th": (("td", "th"), {"tr", "table"}), "option": ("option", {"select"}), "tbody": (("thead", "tbody", "tr", "td", "th"), {"table"})}

#: Words of a class, id or role that name something else than the main text,
#: unless the name goes on with one of the second set; the third always does.
UNWANTED = set("ad advert advertisement advertising sponsor sponsored promo promotion banner cookie consent gdpr notice notification alert popup modal overlay newsletter subscribe signup login nav navbar "
               "navigation menu breadcrumb header masthead footer footnav widget related recommended recommendation share sharing social pagination pager tag toolbar skip search complementary contentinfo".split())
WANTED = set("article body content main entry post story text".split())
ALWAYS = set("comment disqus respond reply sidebar side".split())
#: Words that only tell the shape of what the others name.
SHAPES = set("area bar block box container inner item link links list outer wrap wrapper".split())
CONTAINERS = {"article", "main"}
READING = {"p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "li", "dd"}


class Element:
    __slots__ = ("name", "label", "children", "parent", "points", "chars", "linked")

    def __init__(self, name: str, label: str, parent: Element | None):
        self.name, self.label, self.parent = name, label, parent
        self.children: list[Element | str] = []
        self.points, self.chars, self.linked = 0.0, 0, 0


def parse(page: str) -> Element:
    """The tree of a page."""
    root = node = Element("#root", "", None)
    pos, n = 0, len(page)
    while pos < n:
        at = page.find("<", pos)
        m = _TOKEN.match(page, at) if at >= 0 else None
        if m is None:
            stop = n if at < 0 else at + 1
            node.children.append(html.unescape(page[pos:stop]))
            pos = stop
            continue
        if at > pos:
            node.children.append(html.unescape(page[pos:at]))
        pos = m.end()
        if m["cdata"]:
            node.children.append(m["cdata"])
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            up = node
            while up is not root and up.name != name:
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        node = _implied(node, root, name)
        label = ""
        if m["attrs"]:
            label = " ".join(v for k, *vs in _ATTR.findall(m["attrs"]) for v in vs if v and k.lower() in ("class", "id", "role"))
            if any(k.lower() in ("hidden",) for k, *_ in _ATTR.findall(m["attrs"])):
                label += " modal"
        child = Element(name, label, node)
        node.children.append(child)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I).search(page, pos)
            pos = close.end()
        elif name not in VOID:
            node = child
    return root


def _implied(node: Element, root: Element, name: str) -> Element:
    """The element that a new one goes into, after implied end tags."""
    if name in INSIDE:
        closes, scope = INSIDE[name]
        up, found = node, None
        while up is not root and up.name not in scope:
            if up.name in closes:
                found = up
            up = up.parent
        if found is not None:
            node = found.parent
    if name in CLOSES_P:
        up = node
        while up is not root and up.name not in CLOSES_P and up.name not in ("td", "th", "button", "body", "html"):
            up = up.parent
        up = node
        while up is not root and (up.name not in BLOCK or up.name == "p"):
            if up.name == "p":
                return up.parent
            up = up.parent
    return node


def _cut(e: Element, inside_article: bool) -> bool:
    if e.name in CUT:
        return True
    if e.name == "header":
        return not inside_article
    if not e.label or e.name in ("html", "body") or e.name in CONTAINERS:
        return False
    reads = inside_article and e.name in READING
    return any(_names_other(name.lower(), inside_article, reads) for name in e.label.split())


def _names_other(name: str, inside_article: bool, reads: bool = False) -> bool:
    """A class, id or role names something else than the main text; that of an
    article's own paragraph or heading (``reads``) only if no other word is in it."""
    words = [w[:-1] if w.endswith("s") and w[:-1] in UNWANTED | ALWAYS else "reply" if w == "replies" else w for w in re.split(r"[-_:]+", name) if w]
    if not words or any(w in ALWAYS for w in words):
        return bool(words)
    found = [w for w in words if w in UNWANTED and not (inside_article and w == "header")]
    if reads and any(w not in UNWANTED | SHAPES for w in words):
        return False
    return bool(found) and words[-1] not in WANTED


def prune(root: Element) -> None:
    """Remove what is never main text (no recursion: pages can nest deeply)."""
    stack = [(root, False)]
    while stack:
        e, article = stack.pop()
        e.children = [c for c in e.children if isinstance(c, str) or not _cut(c, article)]
        stack += [(c, article or c.name in CONTAINERS) for c in e.children if not isinstance(c, str)]


def _post_order(root: Element) -> list[Element]:
    out, stack = [], [root]
    while stack:
        e = stack.pop()
        out.append(e)
        stack += [c for c in e.children if not isinstance(c, str)]
    return out[::-1]


def score(root: Element) -> list[Element]:
    """Points of every element; returns the elements, children before parents."""
    order = _post_order(root)
    own: dict[int, list[str]] = {}
    for e in order:
        texts = [c for c in e.children if isinstance(c, str)]
        size = sum(len(" ".join(t.split())) for t in texts)
        inner = [c for c in e.children if not isinstance(c, str)]
        e.chars = size + sum(c.chars for c in inner)
        e.linked = e.chars if e.name == "a" else sum(c.linked for c in inner)
        loose = [t for t in texts] + [t for c in inner if c.name not in BLOCK for t in own.get(id(c), ())]
        own[id(e)] = loose
        if e.name in BLOCK or e.name == "#root":
            text = " ".join(" ".join(loose).split())
            if len(text) >= 25 or (e.name in PARAGRAPHS and text):
                points = 1 + text.count(",") + min(len(text) / 100, 3)
                up, share = (e.parent if e.name in PARAGRAPHS else e), 1.0
                for divide in (1, 2, 3, 6, 9):
                    if up is None:
                        break
                    up.points += points * share / divide
                    up = up.parent
    return order


def density(e: Element) -> float:
    return e.linked / e.chars if e.chars else 0.0


def main_elements(root: Element) -> list[Element]:
    """The best container and the siblings that belong to it, in page order."""
    order = score(root)
    best = max(reversed(order), key=lambda e: (e.points * (1 - density(e))), default=root)
    up = best
    while up is not None:
        if up.name in CONTAINERS and up.chars:
            return [up]
        up = up.parent
    named = [e for e in order if e.name in CONTAINERS and e.chars]
    if len(named) == 1 and named[0].points >= best.points / 4:
        return named
    if best.parent is None or best.name in ("body", "html"):
        return [best]
    limit = max(10.0, best.points * (1 - density(best)) * 0.2)
    kept = []
    for s in best.parent.children:
        if isinstance(s, str):
            continue
        reads = s.name in ("p", "h1", "h2", "h3", "blockquote", "pre", "ul", "ol") and s.chars and (
            density(s) < 0.25 and s.chars > 80 or density(s) == 0 and (s.name.startswith("h") or s.chars <= 80))
        if s is best or s.points * (1 - density(s)) >= limit or reads:
            kept.append(s)
    return kept


def text_of(elements: list[Element]) -> str:
    """Blocks in page order, white space inside them as one space."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run:
            block = _SPACE.sub(" ", "".join(run)).strip()
            if block:
                blocks.append(block)
            run.clear()

    for e in elements:
        stack: list[Element | str | None] = [e]
        while stack:
            x = stack.pop()
            if x is None:
                end()
            elif isinstance(x, str):
                run.append(x)
            else:
                if x.name in BLOCK or x.name == "#root":
                    end()
                    stack.append(None)
                elif x.name == "br":
                    run.append(" ")
                stack += x.children[::-1]
        end()
    return " ".join(blocks)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    prune(root)
    return text_of(main_elements(root))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: the id, the url, ``text`` and ``n_chars`` (its code points)."""
    small_batches(pages.sparkSession, 500)

    def run(batches):
        for batch in batches:
            texts = [main_text(v.as_py()) for v in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column(url_col), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             names=[id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").cast("string").alias("html"))
    kind = lambda c: pages.schema[c].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind(id_col)}, `{url_col}` {kind(url_col)}, text string, n_chars long")
