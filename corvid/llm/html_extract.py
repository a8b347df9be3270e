"""Main text of web pages by composite text density.

For every node of the page: characters per tag, adjusted for the share of
characters and tags in links, in relation to the body's share.  A node's
density sum is the sum of its children's densities; the subtree of the
largest sum holds the article.  The smallest density on the path from the
body to it is the threshold: other subtrees, off that path, whose density
reaches it are content too.  Where the path goes through an ``article`` or
``main`` element, that element is the subtree.  Menus, headers, footers,
sidebars, notices, adverts, forms and comments that say so by tag, or by a
whole word of class, id or role, are taken out of the tree first; not so one
that holds most of the page's characters outside links and its h1, or a form
that holds most of them or an article, unless an article or main is elsewhere.

Character references are decoded; text of block elements is joined by one
space; white space is one space.

Formulas (MathML) are text, but for their annotations; the text of an xmp
element is taken as it stands.  Text that a page does not show goes:
noscript, template, svg, iframe, and elements that are hidden by attribute
or style.

Defined cases: a null or empty html, and a page without text, give an
empty text; broken mark-up is read as far as it goes: unknown end tags are
ignored and open elements end with their parent; text outside a body
element belongs to the body; a head without an end tag ends at the body
or at the first text or element that cannot be in a head; a nav, aside,
header, footer or form that has no end tag ends where main or article begins.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import bounded_batches

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

# Element names of HTML by kind.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe template svg".split())
_MATH = set("math maction merror mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()) | _MATH
_CLOSES_P = set("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
# a formula's annotations are its source in another notation, which no reader sees
_DROP = set("head nav footer aside form button select dialog menu object audio video canvas map annotation annotation-xml".split()) | _RAW
_BAD = set(
    "ad ads adv advert adverts advertisement advertising promo promotion sponsor sponsored banner sidebar sidebars nav navbar navigation menu breadcrumb breadcrumbs"
    " masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social"
    " related recommended widget comment comments disqus reply replies pagination pager toolbar complementary contentinfo search dialog".split()
)
_IN_HEAD = set("base link meta noscript script style template title".split())  # all void or raw, so an open head is the innermost element
_SECTIONS = {"nav", "aside", "header", "footer", "form"}
# Compounds that are names of such parts in full.
_BAD |= {f"{a}-{b}" for a in "site page global main top primary secondary".split() for b in "nav navbar navigation menu footer sidebar".split()}
_BAD |= {f"{a}-{b}" for a in "ad ads advert sponsored".split() for b in "container wrapper box block slot unit banner".split()}
_BAD |= {f"{a}-{b}" for a in "cookie cookies consent gdpr".split() for b in "notice banner bar consent popup modal overlay message".split()}
_BAD |= {f"related-{x}" for x in "posts articles stories links news content".split()} | {f"{a}-{b}" for a in "share social sharing".split() for b in "buttons links icons bar share sharing media".split()}
_BAD |= {f"{a}-{b}" for a in "newsletter subscribe search login signup".split() for b in "form box signup popup modal".split()} | {"nav-bar", "nav-menu", "menu-bar", "side-bar", "breadcrumb-nav", "skip-link"}
_COMMENT = {"comment", "comments", "reply", "replies", "disqus", "comment-list", "comment-body", "comment-item", "comments-area", "comments-section", "comment-section", "comment-form", "disqus-thread"}
_BAD |= _COMMENT
_HEADER = {"header", "masthead", "banner", "site-header", "page-header", "global-header", "main-header", "top-header", "top-banner", "site-masthead"}


class _Node:
    __slots__ = ("tag", "parent", "children", "parts", "names", "hidden", "chars", "links", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: _Node | None, names: set[str], hidden: bool):
        self.tag, self.parent, self.names, self.hidden = tag, parent, names, hidden
        self.children: list[_Node] = []
        self.parts: list[str | _Node] = []  # texts and children, in order


def _attributes(raw: str) -> tuple[set[str], bool]:
    names, hidden = set(), False
    for k, *v in _ATTR.findall(raw) if raw else ():
        value, k = "".join(v).lower(), k.lower()
        if k == "hidden" or k == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif k in ("class", "id", "role"):
            # whole words, without a number at the end: sidebar-2, comment_123, ad300x250
            names |= {re.sub(r"-*\d[\dx]*$", "", w.replace("_", "-")) for w in value.split()}
    return names, hidden


class _Ends:
    """Which open sections of a kind are ended by a tag of their own, somewhere after a place in the page.

    The tags of a kind are read once: with the running sum of starts and ends
    and its least value from each tag on, a place is looked up by bisection.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks: dict[str, tuple[list[int], list[int], list[int]]] = {}

    def low(self, tag: str, at: int, opened: int) -> int:
        """The fewest of ``opened`` sections that stay open at any place from ``at`` on."""
        if tag not in self.marks:
            places, sums, total = [], [0], 0
            for m in re.compile(rf"<(/?){tag}[\s>]", re.I).finditer(self.page):
                total += -1 if m[1] else 1
                places.append(m.start())
                sums.append(total)
            least = list(accumulate(reversed(sums), min))[::-1]
            self.marks[tag] = places, sums, least
        places, sums, least = self.marks[tag]
        k = bisect_left(places, at)
        return max(0, opened + least[k] - sums[k])


def _outside(top: _Node, known: _Ends, at: int, tag: str) -> _Node:
    """The parent of the outermost open section that a main or article at this place ends, or ``top``."""
    opened: dict[str, list[_Node]] = {}
    ends: set[int] = set()
    n = top
    while n.parent:
        if n.tag in _SECTIONS:
            opened.setdefault(n.tag, []).append(n)
        n = n.parent
    for t, nodes in opened.items():
        if known.low(t, at, len(nodes)) or tag == "main" and t != "form":  # HTML allows main in none but a form
            ends.add(id(nodes[-1]))
    n = top
    while n.parent:
        top = n.parent if id(n) in ends else top
        n = n.parent
    return top


def _tree(page: str) -> _Node:
    root = top = _Node("body", None, set(), False)
    at, known = 0, _Ends(page)
    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            if top.tag == "head" and not page[at:end].isspace():
                top = top.parent
            top.parts.append(_html.unescape(page[at:end]))
        if not m:
            break
        at = m.end()
        if not (tag := (m[2] or "").lower()) or tag == "html":
            continue
        if not m[1] and tag not in _IN_HEAD:
            top = top.parent if top.tag == "head" else top
        if tag == "body":
            continue
        if m[1]:
            node = top
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                top = node.parent
            continue
        if tag in ("main", "article"):
            top = _outside(top, known, at, tag)
        if tag in _CLOSES_P or tag in _ENDS:
            ends, scope = ({"p"}, _CLOSES_P - {"p"} | {"li", "td", "th", "dd", "body"}) if tag in _CLOSES_P else (_ENDS[tag], _SCOPE[tag])
            node, last = top, None
            while node is not root and node.tag not in scope:
                last = node if node.tag in ends else last
                node = node.parent
            top = last.parent if last else top
        node = _Node(tag, top, *_attributes(m[3]))
        top.children.append(node)
        top.parts.append(node)
        if tag in _RAW or tag == "xmp":
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if tag == "xmp":  # its text is as it stands
                node.parts.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
        elif tag not in _VOID and not m[3].endswith("/"):
            top = node
    return root


def _walk(root: _Node) -> list[_Node]:
    """All nodes, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    return out


def _prune(root: _Node) -> None:
    """Take out what is no article by its own account."""
    nodes = _walk(root)
    holds = {id(n) for n in nodes if n.tag in ("article", "main") and not n.names & _COMMENT}
    heads = {id(n) for n in nodes if n.tag == "h1"}
    # characters outside links, and articles, in each subtree
    plain, named = {}, {}
    for n in reversed(nodes):
        gone = n.hidden or n.tag in _RAW or n.tag in ("a", "head")
        plain[id(n)] = 0 if gone else sum(len("".join(x.split())) for x in n.parts if isinstance(x, str)) + sum(plain[id(c)] for c in n.children)
        named[id(n)] = (id(n) in holds) + sum(named[id(c)] for c in n.children)
    for n in reversed(nodes):
        if n.parent and id(n) in holds:
            holds.add(id(n.parent))
        if n.parent and id(n) in heads:
            heads.add(id(n.parent))
    inside: set[int] = set()
    for n in nodes:
        if n.parent and (id(n.parent) in inside or n.parent.tag in ("article", "main")):
            inside.add(id(n))
    for n in nodes:
        if n.parent is None:
            continue
        bad = n.hidden or n.tag in _DROP or bool(n.names & _BAD)
        if n.tag == "header" or n.names & _HEADER:
            bad = bad or not (id(n) in inside and id(n) in heads)
        only = not n.hidden and not n.names & _COMMENT and named[id(n)] == named[id(root)]  # no article or main elsewhere
        most = only and 2 * plain[id(n)] > plain[id(root)]
        wraps = most and id(n) in heads and (n.tag in _SECTIONS or n.tag not in _DROP)
        wraps = wraps or n.tag == "form" and (most or only and id(n) in holds)
        if bad and not wraps and (n.tag in _DROP or id(n) not in holds):
            n.parent.children.remove(n)
            n.parent.parts[n.parent.parts.index(n)] = " "


def _measure(nodes: list[_Node]) -> None:
    for n in reversed(nodes):
        own = sum(len(" ".join(x.split())) for x in n.parts if isinstance(x, str))
        n.chars = own + sum(c.chars for c in n.children)
        n.tags = sum(c.tags + 1 for c in n.children)
        n.links = n.chars if n.tag == "a" else sum(c.links for c in n.children)
        n.link_tags = sum(c.link_tags for c in n.children) + (n.tag == "a")
    body = nodes[0]
    share = body.links / max(1, body.chars)
    for n in reversed(nodes):
        c, lc, t, lt = n.chars, max(1, n.links), max(1, n.tags), max(1, n.link_tags)
        base = math.log(c / max(1, c - n.links) * n.links + share * c + math.e)
        n.density = c / t * max(0.0, math.log(max(c / lc * t / lt, 1.0)) / math.log(base + 1)) if c else 0.0
        n.total = sum(x.density for x in n.children)


def _text(node: _Node, out: list[str]) -> None:
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.tag in _INLINE:
            todo += reversed(x.parts)
        else:
            todo += [" ", *reversed(x.parts), " "]


def main_text(page: str | None) -> str:
    root = _tree(page or "")
    _prune(root)
    nodes = _walk(root)
    _measure(nodes)
    best = max(nodes, key=lambda n: (n.total, n.chars))  # the first of equals, parents first
    path, n = [best], best
    while n.parent:
        n = n.parent
        path.append(n)
    named = [n for n in path if n.tag == "article"] or [n for n in path if n.tag == "main"]
    if named:
        chosen = [named[-1]]
    else:
        least = min(n.density for n in path)
        on_path, below = {id(n) for n in path}, {id(n) for n in _walk(best)}
        chosen, inside = [best], set()
        for n in nodes:
            if id(n) in on_path or id(n) in below:
                continue
            if n.parent and id(n.parent) in inside:
                inside.add(id(n))
            elif n.density >= least and n.chars and n.tag not in _INLINE:
                chosen.append(n)
                inside.add(id(n))
        place = {id(n): k for k, n in enumerate(nodes)}
        chosen.sort(key=lambda n: place[id(n)])
    out: list[str] = []
    for n in chosen:
        _text(n, out)
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    bounded_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([main_text(x) for x in s], dtype=object)

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
