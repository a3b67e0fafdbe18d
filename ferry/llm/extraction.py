"""Main text of HTML pages by tree scoring.

Every block of running text earns points for its length and its commas, and passes them to its
ancestors, less with distance. Containers are discounted by the share of their text that lies in links, and the best
one is kept with those siblings that score near it.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ferry.llm.tables import with_results

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no running text of the article.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video map nav footer aside form button select "
    "option textarea input label fieldset menu dialog".split()
)
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Words of a class, id or role that name what surrounds an article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner banners breadcrumb breadcrumbs "
    "comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices alert popup modal overlay "
    "footer foot header masthead menu menus nav navbar navigation pager pagination related recommended share sharing social sidebar "
    "sidebars subscribe subscription newsletter signup login search toolbar widget widgets skip hidden complementary contentinfo "
    "search searchbox dialog sitemap copyright".split()
)
#: Words that tell readers' contributions even where their markup is that of articles.
READERS = frozenset("comment comments commentlist disqus respond reply replies".split())
PRIOR = {"article": 60.0, "main": 40.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}
PRIOR |= dict.fromkeys("address ol ul dl dd dt li".split(), -3.0)
#: A sibling of the best container is kept from this share of its score on.
SIBLING = 0.2
_CLOSES_P = BLOCKS - {"html", "body"}
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "names", "dropped", "parent", "children", "points", "letters", "linked")

    def __init__(self, tag: str, parent: Node | None, names: frozenset[str] = frozenset(), dropped: bool = False):
        self.tag, self.parent, self.names, self.dropped = tag, parent, names, dropped
        self.children: list[Node | str] = []
        self.points, self.letters, self.linked = PRIOR.get(tag, 0.0), 0, 0


class _Tree(HTMLParser):
    """A tree of elements and decoded text; tags left open are closed where HTML closes them.

    The depths of open elements are kept by tag, so that an end tag is answered without a walk, however deep the page.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.path: list[Node] = []
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._close("p", BLOCKS - {"p"})
        for same, inside in (("li", {"ul", "ol", "menu"}), ("td", {"tr", "table"}), ("th", {"tr", "table"}), ("tr", {"table"}), ("option", {"select"}), ("dt", {"dl"}), ("dd", {"dl"})):
            if tag == same:
                self._close(same, inside)
        got = {k: v or "" for k, v in attrs}
        names = frozenset(x.lower() for k in ("class", "id", "role") for x in _NAMES.findall(got.get(k, "")))
        style = got.get("style", "").replace(" ", "").lower()
        unseen = "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        node = Node(tag, self.at, names, unseen or tag in DROPPED)
        self.at.children.append(node)
        if tag not in VOID:
            self._open(node)

    def handle_startendtag(self, tag, attrs):
        # "<div/>" opens a div in HTML; void elements close themselves.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        depth = self._depth(tag)
        # An end tag of inline text does not close blocks, nor does one of a paragraph other blocks.
        within = tag not in BLOCKS and tag not in DROPPED or tag == "p"
        if depth >= 0 and not (within and self.blocks and self.blocks[-1] > depth):
            self._cut(depth)

    def _depth(self, tag: str) -> int:
        """Where the innermost open element of the tag is, or -1."""
        open_ = self.depths.get(tag)
        return open_[-1] if open_ else -1

    def _open(self, node: Node) -> None:
        self.at = node
        self.depths.setdefault(node.tag, []).append(len(self.path))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.path))
        self.path.append(node)

    def _cut(self, depth: int) -> None:
        """Close the element at the depth and what is open in it."""
        while len(self.path) > depth:
            tag = self.path.pop().tag
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()
        self.at = self.path[-1] if self.path else self.root

    def _close(self, tag: str, within: frozenset[str] | set[str]) -> None:
        depth = self._depth(tag)
        if depth >= 0 and all(self._depth(other) < depth for other in within):
            self._cut(depth)

    def handle_data(self, data):
        self.at.children.append(data)


def _walk(root: Node):
    """Nodes below in page order, parents first, without recursion: pages may nest deeply."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]


def _prune(root: Node) -> None:
    """Drop what is named as boilerplate, unless it wraps the article itself."""
    order = list(_walk(root))
    wraps: set[int] = set()
    for node in reversed(order):
        own = node.tag in ("article", "main") and not node.names & READERS
        if own and not node.dropped or id(node) in wraps:
            wraps.add(id(node))
            if node.parent:
                wraps.add(id(node.parent))
    inside: set[int] = set()
    for node in order:
        if node.tag in ("article", "main") or node.parent and id(node.parent) in inside:
            inside.add(id(node))
        named = bool(node.names & BOILERPLATE) and node.tag not in ("html", "body")
        header = node.tag == "header" and id(node) not in inside
        if (named or header) and (id(node) not in wraps or node.names & READERS):
            node.dropped = True
    for node in order:
        node.children = [c for c in node.children if isinstance(c, str) or not c.dropped]


def _blocks(root: Node) -> list[tuple[Node, str]]:
    """Blocks of text below a node, in page order, with white space made one space."""
    out: list[tuple[Node, list[str]]] = [(root, [])]
    stack: list[tuple[Node, int]] = [(root, 0)]
    owners = [root]
    while stack:
        node, i = stack.pop()
        if i == len(node.children):
            if node.tag in BLOCKS and len(owners) > 1:
                owners.pop()
                out.append((owners[-1], []))
            continue
        stack.append((node, i + 1))
        child = node.children[i]
        if isinstance(child, str):
            out[-1][1].append(child)
        elif child.tag == "br":
            out[-1][1].append("\n")
        else:
            if child.tag in BLOCKS:
                owners.append(child)
                out.append((child, []))
            stack.append((child, 0))
    joined = ((node, " ".join("".join(parts).split())) for node, parts in out)
    return [(node, text) for node, text in joined if text]


def _score(root: Node) -> None:
    for node in _walk(root):
        linked = node.tag == "a" or node.parent is not None and node.linked < 0
        for c in node.children:
            if isinstance(c, Node):
                c.linked = -1 if linked else 0
    order = list(_walk(root))
    in_link = {id(n) for n in order if n.linked < 0 or n.tag == "a"}
    for node in reversed(order):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        node.letters = own + sum(c.letters for c in node.children if isinstance(c, Node))
        below = sum(c.linked for c in node.children if isinstance(c, Node))
        node.linked = node.letters if id(node) in in_link else below
    for owner, text in _blocks(root):
        if owner.tag in ("li", "ul", "ol") and owner.linked * 2 > owner.letters:
            continue
        points = 1.0 + text.count(",") + min(len(text) / 100, 10.0)
        node, share = (owner if owner.tag in ("div", "section", "article", "main", "td", "body") else owner.parent or owner), 1.0
        for _ in range(4):
            node.points += points * share
            if not node.parent:
                break
            node, share = node.parent, share / 2


def _value(node: Node) -> float:
    return node.points * (1 - node.linked / node.letters) if node.letters else 0.0


def _whole(html: str) -> str:
    """Without a comment or tag that the page's end cuts off."""
    comment = html.rfind("<!--")
    if comment > html.rfind("</script") and html.find("-->", comment) < 0:
        html = html[:comment]
    tag = html.rfind("<")
    return html[:tag] if tag > html.rfind(">") and re.match(r"[A-Za-z/!]", html[tag + 1 : tag + 2]) else html


def main_text(html: str | None) -> str:
    """The article's text: its blocks in page order, joined by one space. Empty for an empty page."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(_whole(html))
    tree.close()
    _prune(tree.root)
    _score(tree.root)
    containers = [n for n in _walk(tree.root) if n.tag in BLOCKS and n.tag != "p" and n.letters]
    if not containers:
        return " ".join(t for _, t in _blocks(tree.root))
    best = max(containers, key=_value)
    while best.tag in ("li", "td", "tr", "tbody", "blockquote", "pre", "dd", "h1", "h2", "h3", "h4", "h5", "h6") and best.parent:
        best = best.parent
    if best.tag in ("article", "main", "body") or not best.parent:
        kept = [best]
    else:
        least = max(10.0, SIBLING * _value(best))
        kept = [c for c in best.parent.children if isinstance(c, Node) and (c is best or _belongs(c, best, least))]
    return " ".join(t for node in kept for _, t in _blocks(node))


def _belongs(node: Node, best: Node, least: float) -> bool:
    if not node.letters:
        return False
    density = node.linked / node.letters
    if node.tag in ("p", "h1", "h2", "h3", "blockquote", "pre"):
        return density < 0.25
    return node.tag in BLOCKS and density < 0.25 and _value(node) + (SIBLING * _value(best) if node.names & best.names else 0) >= least


def _extract(batch: pa.RecordBatch) -> list[pa.Array]:
    texts = [main_text(html) for html in batch.column(0).to_pylist()]
    return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """(row, text, n_chars) for every page; ``row`` is the page as it was.

    A null, empty or unreadable page has the empty text; repeated rows each come back; broken markup is
    read as far as it goes; nothing is cut off, however long or deep. Pages are independent of each other,
    so there is no shuffle.
    """
    return with_results(pages, {"html": F.col(html)}, _extract, "text string, n_chars bigint")
