"""Main text of web pages by composite text density.

The page is read into a tree of elements, with the usual implied ends. Subtrees that cannot be
article text are cut by element or by a word of their class, id or role: scripts, styles, menus,
headers, footers, sidebars, notices, adverts, forms, comments. Forms and what is named by such a word stay
if they hold the page's main element (its first main, else its first article, else its first h1) or,
on pages without main and article, more than half of the page's text. For every node left

    density = C / T * log(C / LC * T / LT, base ln(C / NLC * LC + LCb / Cb * C + e))

with C its characters, T its elements, LC and LT those in links, NLC the characters outside
links, LCb and Cb the body's (zeros count as one). Elements that only format text within a block
do not count as elements, so a paragraph is no thinner for its bold words. A block's sum is that
of its child blocks' densities. The article is the outermost article element around the block
with the largest sum and its sibling articles that are not mostly links, else the outermost main, else the last one on
the way up before further content is mostly links; all of it that is not cut is text. The least density from the largest-sum block up to the body
is the threshold, and outside the article only nodes that are denser take part.

Blocks are separated by one space, as white space within is; references are decoded once. Null
or empty pages, and pages with markup only, have empty text. Of equal sums the first in page
order wins. Pages without end tags, or cut off inside a tag, are read as far as they go;
nesting of any depth is walked without recursion. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from mainspool.llm.common import append

# Elements of the HTML standard, by how they are read.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_FORMAT = set("abbr b bdi bdo big br cite code del dfn em font i ins kbd mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = _BLOCK - set("body br caption dd dt html li tbody td tfoot th thead tr".split())
_ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
}

#: Elements that are never article text.
CUT = set("script style textarea title xmp iframe noembed noframes head nav aside footer button select template noscript svg canvas object menu dialog input label".split())

#: Words of a class, id or role that mark what is not article text.
CUT_WORDS = set(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side aside footer masthead cookie cookies consent gdpr notice popup modal newsletter subscribe signup login share sharing social "
    "related recommended comment comments disqus respond reply replies pagination pager toolbar topbar widget search skip alert dialog disclaimer complementary contentinfo".split()
)

#: Words that go with those in names of the same kind.
WITH_WORDS = set(
    "area article bar block body bottom box btn button buttons center col column container content count entry foot footer form group head header holder "
    "icon icons inner inline item items large left link links list main media mini mobile outer page panel pane post posts reader right row section "
    "sections site slot slots small stories story section thread title top unit user users vertical wrap wrapper zone".split()
)

#: Words of names of reader comments.
COMMENT_WORDS = {"comment", "comments", "disqus", "respond", "reply", "replies"}

#: Share of characters in links from which content counts as links.
LINK_SHARE = 0.5

_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# elements that no implied end reaches across
_SCOPES = set("body td th article section div ul ol menu dl table select".split())


@cache
def _apart(word: str) -> tuple[str, ...]:
    """The words that a word is put together of, if they are all known; else the word."""
    if word in CUT_WORDS or word in WITH_WORDS or len(word) > 40:
        return (word,)
    found: list[tuple[str, ...] | None] = [()]
    for end in range(1, len(word) + 1):
        # two letters are no part of a compound, but in front
        parts = (found[i] + (word[i:end],) for i in range(end) if found[i] is not None and (end - i > 2 or not i) and (word[i:end] in CUT_WORDS or word[i:end] in WITH_WORDS))
        found.append(next(parts, None))
    return found[-1] or (word,)


class Node:
    __slots__ = ("name", "parent", "children", "cut", "marked", "inside", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, name: str, parent: Node | None, cut: bool = False, marked: bool = False):
        self.name, self.parent, self.cut, self.marked = name, parent, cut, marked
        self.inside = name in ("article", "main") or parent is not None and parent.inside
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0


def _is_outside(parent: Node) -> bool:
    return parent.name in ("body", "html", "div")


def _is_cut(name: str) -> bool:
    return name in CUT


def _is_marked(name: str, attributes: str, parent: Node) -> bool:
    """Whether the element is cut unless it holds the page's main content."""
    if name == "form" or name == "header" and _is_outside(parent):
        return True
    if name in ("html", "body", "main") or "=" not in attributes:
        return False
    for found in _NAMED.finditer(attributes):
        for token in found[1].strip("\"'").split():
            words = {part for w in _WORD.findall(token) for part in _apart(w.lower())}
            if name == "article":  # a reader's comment may be one
                if words & COMMENT_WORDS and words <= CUT_WORDS | WITH_WORDS:
                    return True
            elif words & CUT_WORDS and (not parent.inside or words <= CUT_WORDS | WITH_WORDS):
                return True
            elif "header" in words and _is_outside(parent) and not parent.inside:
                return True
    return False


def parse(page: str) -> Node:
    """The page's element tree; text is in place among the children, decoded."""
    root = at = Node("html", None)
    pos, end = 0, len(page)
    # open elements by name, in the page and since the last that no implied end reaches across
    open_: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]

    def close(stop: Node) -> None:
        """End the open elements up to ``stop``."""
        nonlocal at
        last = stop.parent or stop
        while at is not last:
            open_[at.name] -= 1
            if at.name in _SCOPES:
                scopes.pop()
            scopes[-1][at.name] -= 1
            at = at.parent

    while pos < end:
        mark = _MARK.search(page, pos)
        text = page[pos : mark.start() if mark else end]
        if text:
            at.children.append(unescape(text))
        if not mark:
            break
        pos = mark.end()
        name = (mark[2] or mark[5] or "").lower()
        if not name or mark[5] and not mark[0].endswith(">"):
            continue
        if mark[1] or mark[4]:
            if open_[name] > 0:
                up = at
                while up.name != name:
                    up = up.parent
                close(up)
            continue
        if name in ("html", "body") and (name == "html" or any(isinstance(c, Node) and c.name == "body" for c in root.children)):
            continue
        ended = _ENDED_BY.get(name, frozenset()) | ({"p"} if name in _ENDS_P else frozenset())
        left = sum(scopes[-1][n] for n in ended)
        if left > 0:
            up = top = at
            while left > 0:  # all of them are above, none beyond the scope
                if up.name in ended:
                    left, top = left - 1, up
                up = up.parent
            close(top)
        node = Node(name, at, _is_cut(name), _is_marked(name, mark[3] or mark[6] or "", at))
        at.children.append(node)
        if name in _RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = stop.end() if stop else end
        elif name not in _VOID and not (mark[0].endswith("/>") and name in ("svg", "path")):
            at = node
            open_[name] += 1
            scopes[-1][name] += 1
            if name in _SCOPES:
                scopes.append(Counter())
    _cut_marked(root)
    return root


def _cut_marked(root: Node) -> None:
    """Cut the marked nodes that do not hold the page's main content."""
    nodes = _walk(root)
    if not any(n.marked for n in nodes):
        return
    first: dict[str, Node] = {}
    chars: dict[int, int] = {}
    for node in nodes:
        first.setdefault(node.name, node)
    for node in reversed(nodes):
        n = chars[id(node)] = chars.get(id(node), 0) + sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        if node.parent is not None:
            chars[id(node.parent)] = chars.get(id(node.parent), 0) + n
    up = main = first.get("main") or first.get("article") or first.get("h1")
    around = set()
    while up is not None:
        around.add(id(up))
        up = up.parent
    by_size = main is None or main.name == "h1"
    headline = _only_headline(nodes)
    for node in nodes:
        node.cut = node.cut or node.marked and id(node) not in around and node is not headline and not (by_size and 2 * chars[id(node)] > chars[id(root)])


def _only_headline(nodes: list[Node]) -> Node | None:
    """The header that holds the first h1, where no article or main has an h1 and the header is that of a part of the page."""
    first = next((n for n in nodes if n.name == "h1"), None)
    if first is None or any(n.name == "h1" and n.inside for n in nodes):
        return None
    up = first.parent
    while up is not None and up.name != "header":
        up = up.parent
    return up if up is not None and up.parent is not None and up.parent.name == "div" else None


def _walk(root: Node) -> list[Node]:
    """Nodes that are not cut, parents first, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.cut:
            out.append(node)
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    if not chars:
        return 0.0
    one = lambda x: x or 1
    base = log(chars / one(chars - link_chars) * link_chars + body_share * chars + e)
    # a base near one, of nodes without links, would make the logarithm grow without bound
    return chars / one(tags) * log(max(chars / one(link_chars) * one(tags) / one(link_tags), 1.0) + 1) / max(log(max(base, 1.0)) + 1, 1.0)


def measure(nodes: list[Node]) -> None:
    linked: dict[int, bool] = {}
    for node in nodes:
        linked[id(node)] = node.name == "a" or node.parent is not None and linked.get(id(node.parent), False)
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own
        node.link_chars += own if linked[id(node)] else 0
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + (node.name not in _FORMAT)
            up.link_tags += node.link_tags + (node.name == "a")
    top = nodes[0]
    share = top.link_chars / (top.chars or 1)
    for node in nodes:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        if node.parent is not None and node.name in _BLOCK:
            node.parent.sum += node.density


def _article(best: Node) -> list[Node]:
    """The article around the block with the largest sum, as its nodes."""
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    mains = [n for n in around if n.name == "main"]
    if articles := [n for n in around if n.name == "article"]:
        top = articles[-1]
        beside = top.parent.children if top.parent is not None else [top]
        return [n for n in beside if n is top or isinstance(n, Node) and n.name == "article" and not n.cut and n.link_chars <= LINK_SHARE * n.chars]
    if mains:
        return [mains[-1]]
    top = best
    for up in around[1:]:  # up to where what comes in is mostly links
        if up.link_chars - top.link_chars > LINK_SHARE * (up.chars - top.chars):
            break
        top = up
    return [top]


def content(root: Node) -> list[Node]:
    """The article's nodes, in page order."""
    nodes = _walk(root)
    if not nodes:
        return []
    measure(nodes)
    if not root.chars:
        return []
    best = max((n for n in nodes if n.name in _BLOCK), key=lambda n: n.sum)  # the first of equal ones
    threshold, up = best.density, best
    while up is not None:
        if up.chars:
            threshold = min(threshold, up.density)
        up = up.parent
    tops = _article(best)
    chosen = {id(n) for n in tops}
    articles = Counter(id(n.parent) for n in nodes if n.name == "article")
    for node in nodes:  # teasers among articles
        if node.name == "article" and node.link_chars > LINK_SHARE * node.chars and id(node) not in chosen:
            node.cut = articles[id(node.parent)] > 1
    above = set()
    up = tops[0]
    while up is not None:
        above.add(id(up))
        up = up.parent
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.cut:
            continue
        if id(node) in chosen:
            out.append(node)
        elif id(node) in above:
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        elif node.density > threshold and node.link_chars <= LINK_SHARE * node.chars and node.name in ("article", "main", "section", "div", "p", "h1"):
            out.append(node)
    return out


def text_of(nodes: list[Node]) -> str:
    parts: list[str] = []
    todo: list[Node | str] = list(reversed(nodes))
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
        elif not item.cut:
            if item.name in _BLOCK:
                parts.append(" ")
                todo.append(" ")
            todo += reversed(item.children)
    return " ".join("".join(parts).split())


def extract(page: str | None) -> str:
    return text_of(content(parse(page))) if page else ""


def main_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""

    def run(column: pa.Array) -> list[pa.Array]:
        texts = [extract(p) for p in column.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return append(pages, "text string, n_chars bigint", run, html, keep=keep)
