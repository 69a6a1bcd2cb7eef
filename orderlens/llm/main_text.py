"""Operator 6: main text of web pages by tree scoring.

A page becomes a tree of block elements. Elements that are never main text are cut off: by tag (menus, asides, forms,
scripts, page headers and footers), when hidden, or by a word of their class, id or role that names a menu, notice,
advert, side column or reader comments. A form is treated like an element so named; what it asks for is always cut. A word that only tells of the layout ("no-comments", "has-sidebar", "ad-free")
names nothing, nor does a word for a part of an article, as "byline", inside one. An element so named stays nevertheless
if it holds the page's main element, its only articles, or most points of the page by paragraphs and share of links; one
named for comments, if it holds nearly all. Every paragraph then passes points for its length and commas to its ancestors,
fully to the parent and less to those above, ``LEVELS`` in all; a container's score is discounted by the share of its text that is link
text. The best container is taken, together with its siblings that score near it or hold prose; where it stands in an
article or main element, that element is taken whole. Lists of links outside such an element are left out, unless they
stand between two paragraphs. Where the text has no heading, a headline without a link in the page header comes before it.

The text of a block has its white space turned into single spaces and is trimmed; blocks are joined in page order by a
newline. Character references are decoded. Null, empty or textless pages give an empty text. Unclosed, stray and cut-off
tags are allowed; a comment without an end lasts to the end of the page. If cutting by class words leaves nothing, the page is read again without it.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is never main text.
CUT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video button select textarea "
    "datalist nav aside footer menu dialog control".split()
)
# Elements that do not break a line of text. Only links are kept as nodes, for their share of the text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var img br wbr input td th".split()
)
SPACED = frozenset(("br", "td", "th", "img"))
WHOLE = frozenset(("article", "main"))
KEPT = frozenset(("html", "body", "article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset(("p", "blockquote", "pre"))
HOLDERS = frozenset("article div dl figure ol section table ul".split())
LISTS = frozenset(("ul", "ol", "dl", "div", "table"))
# An element that begins closes these, up to the nearest element in the second set.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "option": (("option",), ("select",)),
}
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs byline comment "
    "comments commentlist consent cookie cookies copyright disqus disclaimer dock feedback foot footer gdpr header hidden "
    "infobar legal login masthead menu menus meta modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager paging pagination popup popular privacy promo promoted promotion recommended related remark "
    "replies reply respond rss search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags taboola teaser toc toolbar tooltip topbar trending widget widgets".split()
)
# Of these, names of reader comments, and names of parts that an article may have.
REMARKS = frozenset("comment comments commentlist disqus remark replies reply respond".split())
PARTS = frozenset("byline disclaimer header legal tags".split())
# Words that take the meaning from the next one, or from "header" as the next one.
LAYOUT = frozenset("has have no non not with without".split())
OWNERS = frozenset("article content entry post story".split())
# Share of a page's points from which a named element is taken for the text.
MOST, NEARLY_ALL = 0.5, 0.95
# Ancestors that get points from a paragraph, and the share of link text up to which a block is prose.
LEVELS, LINKED = 12, 0.25
# What names an element: a part that an article may have, reader comments, anything else, or that it is hidden.
PART, REMARK, OTHER, HIDDEN = 1, 2, 3, 4
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_TAG = re.compile(r"<[A-Za-z/!]")
# What may hold marks that are no comments, and a comment.
_RAW = re.compile(r"<!--|<(script|style)\b", re.IGNORECASE)
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("children", "chars", "links", "named", "parent", "points", "score", "tag", "whole")

    def __init__(self, tag: str, parent: Node | None, named: int = 0):
        self.tag, self.parent, self.named = tag, parent, named
        self.children: list = []
        self.chars = self.links = 0
        self.score = self.points = 0.0
        # Whether it stands in an article or main element.
        self.whole = parent is not None and (parent.whole or parent.tag in WHOLE)


def _named(value: str) -> int:
    """What the words of one name say, without those that tell of the layout only."""
    found = 0
    words = [w.lower() for w in _WORD.findall(value)]
    for i, word in enumerate(words):
        if word in NAMES:
            before, after = words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""
            if before in LAYOUT or after == "free" or (word == "header" and before in OWNERS):
                continue
            found = max(found, PART if word in PARTS else REMARK if word in REMARKS else OTHER)
    return found


def _names(attrs: list) -> int:
    """What class, id or role name other than main text, or that the element is hidden."""
    found = 0
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HIDDEN
        if name == "style" and value and _NONE.search(value):
            return HIDDEN
        if name in ("class", "id", "role") and value:
            for one in value.split():
                found = max(found, _named(one))
    return found


class Tree(HTMLParser):
    """Builds block nodes whose children are nodes, texts and (text, True) for link text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.link = False
        # Elements of each tag that are open, so that a stray end is seen at once.
        self.open: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            if tag == "a":
                self.link = True
            if tag in SPACED:
                self.at.children.append(" ")
            if attrs and tag not in VOID and _names(attrs):
                self.at = self._open(tag, _names(attrs))
            elif tag == "label" and self.open["form"]:
                self.at = self._open("control", 0)
            elif tag == "label" or (self.at.tag == tag and self.at.named):
                self.at = self._open(tag, self.at.named)
            return
        self.link = False
        if tag in VOID:
            if tag == "hr":
                self.at.children.append(Node("hr", self.at))
            return
        if tag in ("html", "body"):
            return
        self._close(("p",), ("article", "main", "section", "div", "td", "li", "blockquote", "table", "body"))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        named = _names(attrs) if tag not in KEPT else 0
        self.at = self._open(tag, max(named, OTHER) if tag == "form" else named)

    def _open(self, tag: str, named: int) -> Node:
        node = Node(tag, self.at, named)
        self.at.children.append(node)
        self.open[tag] += 1
        return node

    def _leave(self, node: Node) -> None:
        """Ends the element and all that are open in it."""
        while self.at is not node:
            self.open[self.at.tag] -= 1
            self.at = self.at.parent
        self.open[node.tag] -= 1
        self.at = node.parent

    def _close(self, tags, limits) -> None:
        if not any(self.open[t] for t in tags):
            return
        node = self.at
        while node.parent is not None and node.tag not in limits:
            if node.tag in tags:
                self._leave(node)
                return
            node = node.parent

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        if tag in SPACED:
            self.at.children.append(" ")
        if tag in ("html", "body"):
            return
        if tag == "label" and self.open["control"]:
            tag = "control"
        if not self.open[tag]:
            return
        node = self.at
        while node.parent is not None:
            if node.tag == tag:
                self._leave(node)
                self.link = False
                return
            if tag in INLINE and node.tag not in INLINE and node.tag != "control":
                return
            node = node.parent

    def handle_data(self, data):
        self.at.children.append((data, True) if self.link else data)


def _cut(node: Node, by_name: int) -> bool:
    """``by_name`` is the least that counts of what names an element; zero for nothing."""
    if node.tag in CUT or (by_name and node.named >= by_name):
        return True
    return node.tag == "header" and not node.whole  # of the page, unless it stands in an article


def _walk(root: Node, by_name: int) -> list[Node]:
    """The nodes that are not cut off, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node is not root and _cut(node, by_name):
            continue
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _measure(nodes: list[Node]) -> None:
    """Characters, link characters and points. A paragraph is a block that holds text of its own."""
    for node in nodes:
        node.chars = node.links = 0
        node.score = node.points = 0.0
    for node in reversed(nodes):  # children come after their parents
        own = ""
        for child in node.children:
            if isinstance(child, str):
                own += child
            elif isinstance(child, tuple):
                own += child[0]
                node.links += len(child[0].strip())
        own = " ".join(own.split())
        node.chars += len(own)
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.links += node.links
        if len(own) >= 25:
            points = 1 + own.count(",") + min(len(own) / 100, 3)
            node.points += points
            up = node if node.tag in ("div", "section", "article", "main") or up is None else up
            level = 0
            while up is not None and level < LEVELS:
                up.score += points / (1, 2, 6, 9)[min(level, 3)] if level < 4 else points / (3 * level)
                level += 1
                up = up.parent
        if node.parent is not None:
            node.parent.points += node.points


def _density(node: Node) -> float:
    return node.links / node.chars if node.chars else 0.0


def _unname(root: Node) -> None:
    """Takes the name from elements that are the page's text nevertheless, and from parts of an article."""
    nodes = _walk(root, HIDDEN)
    if not any(n.named for n in nodes):
        return
    _measure(nodes)
    wholes = {"main": [], "article": []}
    for node in nodes:
        if node.tag in WHOLE and node.chars:
            wholes[node.tag].append(node)
    # The page's main element, or else its articles where all stand in named elements, which are not for comments.
    above: set[int] = set()
    under: dict[int, bool] = {}
    for node in nodes:  # parents come first
        up = node.parent
        under[id(node)] = up is not None and (bool(up.named) or under[id(up)])
    for found in (wholes["main"], wholes["article"]):
        if found and all(under[id(n)] for n in found):
            seen: set[int] = set()
            for node in found:
                while (node := node.parent) is not None and id(node) not in seen:
                    seen.add(id(node))
                    if node.named != REMARK:
                        above.add(id(node))
    whole = root.points * (1 - _density(root))
    cleared: set[int] = set()
    for node in nodes:
        if not node.named:
            continue
        share = node.points * (1 - _density(node)) / whole if whole else 0.0
        if (
            id(node) in above
            or (node.named == PART and node.whole)
            or share > (NEARLY_ALL if node.named == REMARK else MOST)
            or (id(node.parent) in cleared and node.tag in INLINE and node.tag in (node.parent.tag, "label"))
        ):
            node.named = 0
            cleared.add(id(node))


def _best(nodes: list[Node]) -> list[Node]:
    """The best container and its siblings, or the article around it."""
    best = max(nodes, key=lambda n: n.score * (1 - _density(n)))
    if not best.score:
        best = max(nodes, key=lambda n: (n.tag in WHOLE and n.chars > 0, n.chars))
        return [best]
    up = best
    while up is not None:
        if up.tag in WHOLE:
            return [up]
        up = up.parent
    if best.parent is None:
        return [best]
    alive = set(map(id, nodes))
    least = max(2.0, 0.2 * best.score * (1 - _density(best)))
    out = []
    for node in best.parent.children:
        if not isinstance(node, Node) or id(node) not in alive:
            continue
        prose = _density(node) < LINKED and (node.chars > 0 if node.tag in PROSE else node.points > 0 and node.tag in HOLDERS)
        if node is best or prose or node.score * (1 - _density(node)) >= least:
            out.append(node)
    return out


def _links_only(node: Node) -> bool:
    return node.tag in LISTS and node.links > 0.7 * node.chars and not node.whole


def _between(node: Node) -> set[int]:
    """The lists of links among a node's children that stand between two blocks of prose."""
    full = [c for c in node.children if isinstance(c, Node) and c.chars > 0]
    prose = [c.tag in PROSE and _density(c) < LINKED for c in full]
    return {id(c) for c, a, b in zip(full[1:-1], prose, prose[2:], strict=False) if a and b and _links_only(c)}


def _headline(root: Node, tops: list[Node], by_name: int) -> Node | None:
    """The only headline of page headers, if it has no link and the text no heading."""
    if any(n.tag in HEADINGS for top in tops for n in _walk(top, by_name)):
        return None
    found, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        if inside and node.tag == "h1":
            found.append(node)
        elif node.tag not in CUT and not (by_name and node.named >= by_name and node.tag != "header"):
            inside = inside or (node.tag == "header" and not node.whole)
            stack += [(c, inside) for c in node.children if isinstance(c, Node)]
    linked = any(isinstance(c, tuple) for n in found for n in _walk(n, 0) for c in n.children)
    return found[0] if len(found) == 1 and not linked else None


def _text(tops: list[Node], by_name: int) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        block = " ".join("".join(run).split())
        if block:
            blocks.append(block)
        run.clear()

    spared: set[int] = set()
    for top in tops:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                run.append(item)
            elif isinstance(item, tuple):
                run.append(item[0])
            elif item is not top and _cut(item, by_name):
                continue
            elif item is not top and _links_only(item) and id(item) not in spared:
                continue
            else:
                if item.tag in INLINE:
                    stack += reversed(item.children)
                else:
                    end()
                    stack.append(None)
                    stack += reversed(item.children)
                    if not item.whole:
                        spared |= _between(item)
        end()
    return "\n".join(blocks)


def _whole_tags(html: str) -> str:
    """The page without a comment or a tag that its end cuts off."""
    at = 0
    while found := _RAW.search(html, at):
        if found[1]:
            end = re.compile("</" + found[1], re.IGNORECASE).search(html, found.end())
            if end is None:
                return html
            at = end.start()
        else:
            at = html.find("-->", found.end())
            if at < 0:
                return html[: found.start()]
    tail = _TAG.search(html, html.rfind(">") + 1)
    return html[: tail.start()] if tail else html


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = Tree()
    tree.feed(_whole_tags(html))
    tree.close()
    _unname(tree.root)
    for by_name in (PART, 0):
        nodes = _walk(tree.root, by_name)
        _measure(nodes)
        tops = _best(nodes)
        head = _headline(tree.root, tops, by_name)
        text = _text(([head] if head else []) + tops, by_name)
        if text:
            return text
    return ""


def extract(html: Column) -> Column:
    def run(pages: pa.Array) -> pa.Array:
        return pa.array((main_text(p.as_py()) for p in pages), pa.string(), size=len(pages))

    return F.arrow_udf(run, "string")(html)


def extracted(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``; repeated rows are read each, other columns are not."""
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), extract(F.col(html)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
