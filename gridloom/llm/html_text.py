"""Main text of web pages by composite text density.

A page becomes a tree. For every node the text density is its characters per
tag, adjusted by the share of characters and tags that are links against the
page's own link share. The density sum of a node adds up the densities of its
block children; the node with the largest sum holds the article, and where an
article element holds that node, the outermost one does. All of it is article
text. The smallest density on the path from the node up to the body is the
threshold: blocks beside the path count as article text when they reach it. On a
page without an article element a block of less text, as density grows with
length, and a run of loose text need a part of the threshold only, and headings
need none. A body that is the node itself leaves out its lists of links.

Elements that are no text of an article by their name (menus, headers, footers,
sidebars, forms, scripts), that are hidden, or whose role, class or id says so in
every part of a word (``cookie-notice``, ``comments``) are cut off before. A class
or id that says so in a part only (``share-of-voice``) is no more than a hint:
such an element goes where its density is below the threshold.

Every pass over a page takes time in proportion to its length, however it is
nested and whatever is left open.

Defined results: a null or empty page, and one without text, gives an empty
text; broken markup never fails (open elements end with their parent, stray
end tags are ignored, an unclosed tag is text); equal sums go to the node that
comes first; repeated rows give repeated results; an empty table gives an empty
result; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bound_batches

# Element names of HTML and words that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noframes".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark "
                    "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr").split())
DROPPED = frozenset(("aside button canvas datalist dialog fieldset footer form frameset head header iframe input "
                     "label link menu meta nav noframes noscript object option script select style svg template "
                     "textarea title").split())
ENDS_PARAGRAPH = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                            "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
                            "table ul").split())
#: A start tag ends an open element of these names, unless one of the second set lies between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th"]), frozenset(["table"])),
}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MARKS = frozenset(("ad ads advert adverts advertisement advertisements advertising adslot adbox sponsor sponsored promo "
                   "promotion banner nav navbar navigation navi menu breadcrumb breadcrumbs header masthead topbar "
                   "footer sidebar sidepanel cookie cookies consent gdpr notice notices popup modal overlay newsletter "
                   "subscribe subscription signup login comment comments commentlist respond replies disqus feedback "
                   "share sharing social related recommended widget toolbar pagination pager skip").split())
#: Parts of a class or id that say nothing about the text.
NEUTRAL = frozenset(("area bar block body bottom box btn button buttons container content count field form holder icon "
                     "icons inner item items left line link links list main media outer page panel posts right row section "
                     "site slot text thread title top unit wrap wrapper").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_MARKED = frozenset("html body main article".split())
#: Share of the threshold that a block beside the path needs on a page without an article element.
BESIDE = 0.5
_NOT_ITSELF = frozenset("has with no without hide".split())

_TAG = re.compile(
    r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
_MARK_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NOT_SPACE = re.compile(r"\S+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
#: The kinds of elements that end one another; a node knows the outermost open one of each.
_KINDS = list(dict.fromkeys(ENDS.values()))
_KIND_OF = {name: _KINDS.index(kind) for name, kind in ENDS.items()}
_KIND_NAMES = frozenset().union(*[names | walls for names, walls in _KINDS])


class Node:
    __slots__ = ("name", "parent", "items", "dropped", "hinted", "chars", "tags", "link_chars", "link_tags", "density",
                 "total", "paragraph", "ends", "in_body")

    def __init__(self, name: str, parent: Node | None, dropped: bool, hinted: bool = False):
        self.name, self.parent, self.dropped, self.hinted = name, parent, dropped, hinted
        self.items: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.in_body = False
        #: The paragraph that a block inside would end, and the outermost element of each kind that one of its kind ends.
        self.paragraph: Node | None = self if name == "p" else parent.paragraph if parent and name in INLINE else None
        self.ends: tuple[Node | None, ...] = parent.ends if parent else (None,) * len(_KINDS)
        if name in _KIND_NAMES:
            self.ends = tuple(None if name in walls else was or (self if name in names else None)
                              for (names, walls), was in zip(_KINDS, self.ends))


def _boilerplate(name: str, attrs: str) -> tuple[bool, bool]:
    """Whether an element is no article text, and whether its class or id hints at it."""
    if name in DROPPED:
        return True, False
    hinted = False
    if name in NEVER_MARKED or not attrs:
        return False, False
    for key, *values in _MARK_ATTR.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
        if key == "role" and ROLES & set(value.split()):
            return True, False
        if key in ("class", "id"):
            for word in value.split():
                parts = {p for p in re.split(r"[^a-z0-9]+", word) if not p.isdigit()} - {""}
                if not _NOT_ITSELF & parts and MARKS & parts:
                    if not parts - MARKS - NEUTRAL:
                        return True, False
                    hinted = True
    return False, hinted


def parse(page: str) -> list[Node]:
    """All nodes in page order; the first is the root."""
    root = Node("#root", None, False)
    nodes, top, at, text = [root], root, 0, 0
    opened: Counter[str] = Counter()
    last = page.rfind(">")

    def close(until: Node) -> None:
        """End all open elements up to and with this one."""
        nonlocal top
        while True:
            node, top = top, top.parent
            opened[node.name] -= 1
            if node is until:
                return

    def flush(end: int) -> None:
        if text < end:
            top.items.append(page[text:end])

    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            flush(at)
            stop = page.find("-->", at + 4)
            at = text = stop + 3 if stop >= 0 else len(page)
            continue
        if at > last:
            break  # no tag ends any more: the rest is text, but for a comment
        if page.startswith(("<!", "<?"), at):
            flush(at)
            at = text = page.find(">", at) + 1
            continue
        m = _TAG.match(page, at)
        if not m:
            at += 1
            continue
        flush(at)
        at = text = m.end()
        name = (m["name"] or m["name2"]).lower()
        if m["end"] or m["end2"]:
            if opened[name]:
                seek = top
                while seek.name != name:
                    seek = seek.parent
                close(seek)
            continue
        if name in ENDS_PARAGRAPH and top.paragraph:
            close(top.paragraph)
        if name in _KIND_OF and top.ends[_KIND_OF[name]]:
            close(top.ends[_KIND_OF[name]])
        cut, hinted = _boilerplate(name, m["attrs"] or m["attrs2"] or "")
        node = Node(name, top, top.dropped or cut, hinted)
        top.items.append(node)
        nodes.append(node)
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            at = text = stop.start() if stop else len(page)
            if not stop:
                continue
        if name not in VOID:
            top = node
            opened[name] += 1
    if at < 0 or at > last:
        rest = page[text:]
        comment = rest.find("<!--")
        if rest and comment:
            top.items.append(rest if comment < 0 else rest[:comment])
    return nodes


def _size(text: str) -> int:
    return sum(len(word) for word in _NOT_SPACE.findall(text))


def _measure(nodes: list[Node]) -> None:
    """Characters, tags and their link parts of every node that was not cut off, bottom up."""
    for node in reversed(nodes):
        if node.dropped:
            continue
        own = sum(_size(html.unescape(x)) for x in node.items if isinstance(x, str))
        node.chars += own
        if node.name == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags


def text_density(chars: int, tags: int, link_chars: int, link_tags: int, body: Node) -> float:
    if not chars:
        return 0.0
    plain = chars - link_chars
    per_tag = chars / max(1, tags)
    shape = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    base = math.log(chars / max(1, plain) * link_chars + body.link_chars / max(1, body.chars) * chars + math.e)
    # Without links on the page the base is 1; the guard keeps the same factor for all its nodes.
    return per_tag * math.log(max(shape, 1.0)) / math.log(max(base, 1.1))


def _blocks(node: Node) -> list[Node]:
    return [x for x in node.items if isinstance(x, Node) and not x.dropped and x.name not in INLINE]


def _link_list(node: Node) -> bool:
    return node.link_tags >= 2 and 2 * node.link_chars > node.chars


def _add_text(node: Node, threshold: float, out: list[str]) -> None:
    """Text of a subtree, with a space at every block edge and line break; hints count below the threshold."""
    stack: list[Node | str] = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.dropped and not (x.hinted and x is not node and x.density < threshold):
            edge = x.name not in INLINE or x.name == "br"
            if edge:
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed([html.unescape(i) if isinstance(i, str) else i for i in x.items]))


def main_text(page: str) -> str:
    nodes = parse(page)
    _measure(nodes)
    body = next((n for n in nodes if n.name == "body" and not n.dropped), nodes[0])
    if not body.chars:
        return ""
    live = [n for n in nodes if not n.dropped]
    for node in live:
        node.density = text_density(node.chars, node.tags, node.link_chars, node.link_tags, body)
        node.in_body = node is body or (node.parent is not None and node.parent.in_body)
    best = body
    for node in live:
        if node.name not in INLINE:
            node.total = sum(child.density for child in _blocks(node) if not child.hinted)
            if node.total > best.total and node.in_body:
                best = node
    path, up = [best], best
    while up is not body and up.parent is not None:
        up = up.parent
        path.append(up)
    threshold = min(n.density for n in path)
    article = next((n for n in reversed(path) if n.name == "article"), None)
    out: list[str] = []
    _add_beside(body, {id(n) for n in path}, article or best, threshold, threshold * (1 if article else BESIDE), out)
    return " ".join("".join(out).split())


def _add_beside(body: Node, on_path: set[int], chosen: Node, threshold: float, beside: float, out: list[str]) -> None:
    """The chosen node, and of what lies around it the text that is as dense as asked for."""
    def add_run(run: list[Node | str]) -> None:
        inline = [x for x in run if isinstance(x, Node)]
        chars = sum(_size(html.unescape(x)) for x in run if isinstance(x, str)) + sum(x.chars for x in inline)
        density = text_density(chars, sum(x.tags + 1 for x in inline), sum(x.link_chars for x in inline),
                               sum(x.link_tags for x in inline), body)
        if chars and density >= beside:
            for x in run:
                _add_text(x, threshold, out) if isinstance(x, Node) else out.append(html.unescape(x))

    no_article = chosen.name != "article"
    stack: list[Node | list[Node | str]] = [body]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            add_run(node)
        elif node is chosen and node is not body:
            _add_text(node, threshold, out)
        elif node is chosen:
            # The body itself: all its text but lists of links and hinted blocks that are thin.
            for x in node.items:
                if isinstance(x, str):
                    out.append(html.unescape(x))
                elif x.name in INLINE or not (_link_list(x) or (x.hinted and x.density < threshold)):
                    _add_text(x, threshold, out)
                else:
                    out.append(" ")
        elif id(node) in on_path:
            out.append(" ")
            stack.extend(reversed(_runs(node, on_path)))
        elif node.chars and not node.hinted and (
                (node.density >= beside and not _link_list(node)) or (no_article and node.name in HEADINGS)):
            _add_text(node, threshold, out)
        elif no_article and any(x.name in HEADINGS for x in _blocks(node)) and len(_blocks(node)) == 1:
            _add_text(node, threshold, out)  # a heading in a wrapper
        else:
            out.append(" ")


def _runs(node: Node, on_path: set[int]) -> list[Node | list[Node | str]]:
    """Block children and nodes of the path, and between them the runs of loose text and inline children."""
    out: list[Node | list[Node | str]] = []
    for x in node.items:
        if isinstance(x, Node) and x.dropped:
            continue
        if isinstance(x, Node) and (x.name not in INLINE or id(x) in on_path):
            out.append(x)
        elif out and isinstance(out[-1], list):
            out[-1].append(x)
        else:
            out.append([x])
    return out


def extract_batch(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: main_text(page) if page else "")


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; no shuffle."""
    text = F.pandas_udf(extract_batch, "string")(F.coalesce(F.col("html"), F.lit("")))
    return (bound_batches(pages).select("page_id", "url", text.alias("text"))
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
