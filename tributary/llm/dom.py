"""Web pages as trees of blocks, in the way browsers read broken markup.

Only what extraction needs is kept of a page: its blocks of text in order, the shape of the
tree they stand in, and which blocks stand in parts that are no article by their own words
(``nav``, ``class="cookie-notice"``). Runs of equal siblings (paragraphs, list items, table
rows) count as one node of the shape, so a long article has the shape of a short one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements nested deeper than this stand beside their parent; all text is kept.
DEEPEST = 200

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is no markup, and none of it is shown as text of the page.
_RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
_ENDS_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
_KEEPS_P = frozenset("body caption dd dt html legend optgroup option tbody td tfoot th thead tr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCOPE = frozenset("table td th caption button object html".split())
# Start tags that end an open element: what they end, and where to stop looking for it.
_ENDS = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "tbody": ("thead tbody tfoot caption", "table"), "tfoot": ("thead tbody caption", "table"),
    "thead": ("caption tbody", "table"), "option": ("option", "select"),
    "optgroup": ("option optgroup", "select"),
}
_ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in _ENDS.items()}

# Parts that are no article, by element name.
_NEVER = frozenset(
    "nav aside footer dialog menu select button label object svg template canvas audio video "
    "datalist noscript head math".split()
)
# By words of class, id and role. Words for places on a page say nothing inside an article.
_TOLD = frozenset(
    "ad ads advert adverts advertisement adsense adsbygoogle sponsor sponsored promo promotion "
    "comment comments commentlist disqus replies respond cookie cookies consent gdpr notice alert "
    "popup modal overlay newsletter subscribe subscription share sharing social related "
    "recommended recommendations paywall".split()
)
_PLACES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar widget header "
    "masthead topbar banner footer colophon copyright complementary contentinfo toolbar".split()
)

_END_TAG = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*>")
_TAG = re.compile(r"""<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMED = re.compile(
    r"""(?<![^\s/"'])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I
)


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    key: str
    parent: Node | None
    mark: str = ""  # "", "soft" (unless it holds the article) or "hard"
    core: str = ""  # "article", "main" or ""
    children: list[Node] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    depth: int = 0
    holds: bool = False
    shape: str = ""
    size: int = 1
    place: int = 0


@dataclass(slots=True)
class Page:
    title: str
    shape: str
    #: Number of the shape's node, text, and whether it may belong to the article.
    blocks: list[tuple[int, str, bool]]


def _words(attributes: str) -> tuple[dict[str, str], set[str]]:
    found: dict[str, str] = {}
    for name, a, b, c in _NAMED.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    words = set()
    for name in ("class", "id", "role"):
        for token in found.get(name, "").lower().split():
            parts = [p for p in re.split(r"[^a-z]+", token) if p]
            words |= {"".join(parts), *parts[:1], *parts[-1:]}
    return found, words


class _Reader:
    """Builds the tree and gathers blocks, tag by tag."""

    def __init__(self) -> None:
        self.root = Node("html", "html", None)
        self.stack: list[tuple[str, Node]] = [("html", self.root)]
        self.nodes = [self.root]
        self.texts: list[tuple[Node, str, int]] = []
        self.run: list[str] = []
        self.linked = 0  # characters of the run that stand in links
        self.links = 0  # open links
        self.open: dict[str, int] = {}  # open elements by name
        self.muted = 0  # open inline elements whose text is none of the page's
        self.title: str | None = None

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                node = self.stack[-1][1]
                node.blocks.append(len(self.texts))
                self.texts.append((node, text, self.linked))
            self.run.clear()
        self.linked = 0

    def text(self, data: str) -> None:
        if self.stack[-1][0] == "head":
            if not data.strip():
                return
            self.pop(len(self.stack) - 1)
        if not self.muted:
            data = unescape(data)
            self.run.append(data)
            if self.links:
                self.linked += sum(map(len, data.split()))

    def pop(self, to: int) -> None:
        """Closes the elements from ``to`` on."""
        if any(tag in _BLOCKS for tag, _ in self.stack[to:]):
            self.flush()
        for tag, _ in self.stack[to:]:
            self.open[tag] -= 1
            self.links -= tag == "a"
            self.muted -= tag.startswith("!")
        del self.stack[to:]

    def find(self, names: frozenset[str], stop: frozenset[str]) -> int:
        if not any(self.open.get(name) for name in names):
            return 0
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i][0]
            if tag in names:
                return i
            if tag in stop:
                break
        return 0

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and any(t == tag for t, _ in self.stack[:3]):
            return
        if self.stack[-1][0] == "head" and tag not in ("meta", "link", "base", *_RAW):
            self.pop(len(self.stack) - 1)
        if tag == "br":
            self.run.append(" ")
            return
        block = tag in _BLOCKS
        if block:
            if self.muted and tag in ("article", "main"):  # something was not closed
                self.pop(next(i for i, (t, _) in enumerate(self.stack) if t[0] == "!"))
            if tag not in _KEEPS_P and (i := self.find(frozenset(("p",)), _SCOPE)):
                self.pop(i)
            if tag in _ENDS and (i := self.find(*_ENDS[tag])):
                self.pop(i)
            self.flush()
        if tag in _VOID:
            return
        node = self.stack[-1][1]
        if block or tag == "head":
            if node.depth < DEEPEST:
                node = self.node(tag, attributes, node)
        elif tag in _NEVER or (attributes and _words(attributes)[1] & (_TOLD | _PLACES)):
            self.run.append(" ")
            self.muted += 1
            tag = "!" + tag
        elif tag == "a":
            self.links += 1
        self.stack.append((tag, node))
        self.open[tag] = self.open.get(tag, 0) + 1

    def node(self, tag: str, attributes: str, parent: Node) -> Node:
        named, words = _words(attributes) if attributes else ({}, set())
        own = re.match(r"[a-zA-Z_-]+(?=\s|$)", named.get("class", "").strip())
        node = Node(tag, f"{tag}.{own[0]}" if own else tag, parent, depth=parent.depth + 1)
        inside = parent.holds  # whether an article or main is open around
        if tag == "article" and not words & _TOLD:
            node.core = "article"
        elif tag == "main" or named.get("role", "").lower() == "main":
            node.core = "main"
        elif named.get("itemprop", "").lower() == "articlebody":
            node.core = "article"
        elif tag in ("html", "body"):
            pass
        elif tag in _NEVER:
            node.mark = "hard"
        elif tag == "form" or words & _TOLD:
            node.mark = "soft"
        elif not inside and (tag == "header" or words & _PLACES):
            node.mark = "soft"
        node.holds = inside or bool(node.core)
        parent.children.append(node)
        self.nodes.append(node)
        return node

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.run.append(" ")
        elif tag in _HEADINGS:
            if i := self.find(_HEADINGS, _SCOPE):
                self.pop(i)
        elif tag in _BLOCKS or tag == "head":
            stop = frozenset(("table",)) if tag not in ("table",) else frozenset()
            if i := self.find(frozenset((tag,)), _SCOPE if tag == "p" else stop):
                self.pop(i)
        elif i := self.find(frozenset((tag, "!" + tag)), _BLOCKS):
            self.pop(i)


def _read(html: str) -> _Reader:
    reader = _Reader()
    at, size = 0, len(html)
    while at < size:
        i = html.find("<", at)
        if i < 0:
            reader.text(html[at:])
            break
        if i > at:
            reader.text(html[at:i])
        following = html[i + 1 : i + 2]
        if following.isascii() and following.isalpha():
            found = _TAG.match(html, i) or _LOOSE_TAG.match(html, i)
            if not found:
                break  # a tag that never ends
            tag, at = found[1].lower(), found.end()
            if tag in _RAW:
                end = _ENDS_RAW[tag].search(html, at)
                if tag == "title" and reader.title is None:
                    body = html[at : end.start() if end else size]
                    reader.title = " ".join(unescape(body).split())
                if not end:
                    break
                closed = html.find(">", end.end())
                at = closed + 1 if closed >= 0 else size
            else:
                reader.start(tag, found[2])
        elif html.startswith("<!--", i):
            end = html.find("-->", i + 2)
            at = end + 3 if end >= 0 else size
        elif following == "/" and (found := _END_TAG.match(html, i)):
            reader.end(found[1].lower())
            at = found.end()
        elif following in ("!", "?", "/"):
            end = html.find(">", i)
            at = end + 1 if end >= 0 else size
        else:
            reader.text("<")
            at = i + 1
    reader.pop(1)
    reader.flush()
    return reader


def _shapes(nodes: list[Node]) -> None:
    """Shape and size of each node, children first; equal neighbours are one node."""
    for node in reversed(nodes):
        inner, last = [], None
        for child in node.children:
            if child.shape != last:
                inner.append(child.shape)
                node.size += child.size
                last = child.shape
        node.shape = f"{node.key}({','.join(inner)})" if inner else node.key
    for node in nodes:  # parents first; numbers go down the tree, the first child before others
        at, last = node.place + 1, None
        for child in node.children:
            if last is not None and child.shape != last.shape:
                at += last.size
            child.place, last = at, child


def page(html: str | None) -> Page:
    """The blocks of a page; a null page is empty.

    White space in a block (by Unicode) becomes single blanks, a line break too, and blocks
    without other text are left out. A block may belong to the article if nothing around it
    is marked as something else and, where the page has ``article`` elements, it stands in
    one of them, or else in its ``main`` element if there is one.
    """
    reader = _read(html or "")
    nodes = reader.nodes
    _shapes(nodes)
    # Marks by words give way where all that calls itself the article stands under such.
    holders: set[Node] = set()
    marked: set[Node] = set()
    free = False
    for node in nodes:
        if node.mark or node.parent in marked:
            marked.add(node)
        if node.core:
            free = free or node not in marked
            up = node.parent
            while up is not None and up not in holders:
                holders.add(up)
                up = up.parent
    if free:
        holders.clear()
    out: set[Node] = set()  # marked parts with all in them
    cores: dict[str, set[Node]] = {"article": set(), "main": set()}
    for node in nodes:  # parents first
        up = node.parent
        if up in out or node.mark == "hard" or (node.mark == "soft" and node not in holders):
            out.add(node)
            continue
        for kind, members in cores.items():
            if node.core == kind or up in members:
                members.add(node)
    inside = next((members for members in cores.values() if members), None)
    chars: dict[int, int] = {}
    linked: dict[int, int] = {}
    for node, text, links in reader.texts:
        chars[node.place] = chars.get(node.place, 0) + len(text.replace(" ", ""))
        linked[node.place] = linked.get(node.place, 0) + links
    blocks = []
    for node, text, _ in reader.texts:
        if inside is None:  # lists of links are menus
            menu = node.tag in ("li", "dd", "td") and linked[node.place] >= chars[node.place]
            blocks.append((node.place, text, node not in out and not menu))
        else:
            blocks.append((node.place, text, node in inside))
    return Page(reader.title or "", reader.root.shape, blocks)
