"""Main text of web pages by consensus of their host.

Each page's containers are scored by the paragraph text they hold, less what is in links; the smallest container with most of
it wins, or the article element around it.  Its path is generalised (tags and classes from the root, digits masked), and
the pages of a host vote on paths with their scores.  Pages are then extracted anew with the paths that got at least
``QUORUM`` of their host's votes, the strongest that a page has first; a page without any of them uses its own winner.

From the chosen container goes what is not article text: elements that by tag, class, id, role or visibility are menus, page
headers, footers, sidebars, notices, adverts, forms, scripts, styles or comments.  Block-level elements end a block;
character references are decoded, white space in a block becomes one space, and blocks are joined by line feeds.

Null and empty pages give an empty text; a null or unreadable url votes with the host ''.  Every row gives one row, repeated
or not.  Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.store import written

QUORUM = 0.25
#: Share of the page's paragraph text that a container must hold to win.
MOST = 0.6
#: A block shorter than this counts for no container: buttons, bylines, menu points.
SHORT = 25

CONTAINERS = frozenset("html body main article section div td table center details fieldset".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd tr th tbody thead tfoot caption blockquote pre figure figcaption hr address summary header footer nav aside form".split())
DROPPED = frozenset("head nav footer aside form button select textarea noscript template iframe svg canvas object dialog menu label option audio video map".split())
# Elements without content; nothing closes them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class names, ids and roles that mark what is no article text.
MARKS = frozenset(
    "ad ads adbox advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus"
    " footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification popup promo promoted promotion related"
    " reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
PAGE_HEADER = frozenset("header masthead topbar".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|$) | <(script|style|title|xmp)\b.*?(?:</\1\s*>|$) | <[!?][^>]*> | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""",
    re.DOTALL | re.VERBOSE | re.IGNORECASE,
)
# Every attribute with its value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Za-z]+")
_DIGITS = re.compile(r"\d+")


class _Node:
    __slots__ = ("dropped", "links", "marked", "parent", "path", "tag", "text", "titled")

    def __init__(self, tag: str, path: str, parent: _Node | None, dropped: bool, marked: bool) -> None:
        self.tag, self.path, self.parent, self.dropped, self.marked = tag, path, parent, dropped, marked
        self.text = self.links = 0
        self.titled = False


def _read_attributes(source: str) -> tuple[str, bool]:
    """The generalised classes, and whether the element is no article text."""
    classes, dropped = "", False
    for name, a, b, c in _ATTRIBUTE.findall(source):
        value, name = a or b or c, name.lower()
        if name == "hidden":
            dropped = True
        elif name == "style":
            dropped = dropped or "display:none" in value.replace(" ", "").lower()
        elif name == "aria-hidden":
            dropped = dropped or value.lower() == "true"
        elif name in ("class", "id", "role"):
            dropped = dropped or not MARKS.isdisjoint(w.lower() for w in _WORD.findall(value))
            if name == "class":
                classes = "".join("." + _DIGITS.sub("#", x) for x in sorted(value.split()))
    return classes, dropped


def parse(source: str) -> tuple[list[tuple[_Node, str]], list[_Node]]:
    """Blocks of a page in order, each with the container it stands in, and all containers."""
    root = _Node("", "", None, False, False)
    nodes, blocks, stack = [root], [], [root]
    pieces: list[str] = []
    link = 0
    linked = 0

    def close_block() -> None:
        nonlocal pieces, linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            blocks.append((stack[-1], text))
            if len(text) >= SHORT:
                stack[-1].text += len(text)
                stack[-1].links += min(linked, len(text))
        pieces, linked = [], 0

    at = 0
    for token in _TOKEN.finditer(source):
        if token.start() > at:
            piece = source[at : token.start()]
            pieces.append(piece)
            linked += len(piece) if link else 0
        at = token.end()
        tag = token[3]
        if not tag:
            continue
        tag = tag.lower()
        if token[2]:
            if tag == "a":
                link = max(0, link - 1)
            if tag in BLOCKS:
                close_block()
            if any(n.tag == tag for n in stack[1:]):
                close_block()
                while stack.pop().tag != tag:
                    pass
            continue
        if tag == "a":
            link += 1
        if tag == "br":
            pieces.append(" ")
            continue
        block = tag in BLOCKS
        if block or tag in DROPPED:
            close_block()
            if stack[-1].tag == "p":  # another block ends a paragraph
                stack.pop()
            if tag == "body":
                while len(stack) > 1 and stack[-1].tag == "head":
                    stack.pop()
        classes, marked = _read_attributes(token[4]) if token[4] and not token[4].isspace() else ("", False)
        dropped = tag in DROPPED
        if tag in ("h1", "main"):
            for n in stack:
                n.titled = True
        if not marked and (tag == "header" or (classes and not PAGE_HEADER.isdisjoint(w.lower() for w in _WORD.findall(classes)))):
            marked = not any(n.tag in ("article", "main") for n in stack)
        if tag in VOID or token[4].endswith("/") or not (tag in CONTAINERS or dropped or marked):
            continue
        if not block:
            close_block()
        node = _Node(tag, f"{stack[-1].path}>{tag}{classes}", stack[-1], dropped, marked)
        nodes.append(node)
        stack.append(node)
    pieces.append(source[at:])
    close_block()
    for node in nodes[1:]:
        # Names such as "has-sidebar" stand on the whole page, too: what holds its title and text is not dropped by name.
        named = node.marked and not (node.titled and node.tag != "header")
        node.dropped = node.dropped or named or node.parent.dropped
    return blocks, nodes


def winner(nodes: list[_Node]) -> tuple[_Node | None, int]:
    """The container of a page's article, and its score."""
    score = {id(n): 0 for n in nodes}
    for node in nodes:
        own = 0 if node.dropped else max(0, node.text - 2 * node.links)
        above: _Node | None = node
        while own and above is not None:
            score[id(above)] += own
            above = above.parent
    total = score[id(nodes[0])]
    if not total:
        return None, 0
    best = nodes[0]
    for node in nodes:  # parents come before their children
        if score[id(node)] >= MOST * total and node.parent is best:
            best = node
    around: _Node | None = best
    while around is not None:
        if around.tag in ("article", "main"):
            best = around
            break
        around = around.parent
    return best, score[id(best)]


def main_text(source: str, paths: list[str]) -> str:
    """The blocks in the container on the first of ``paths`` that the page has, or else in its own winner."""
    blocks, nodes = parse(source)
    chosen: list[_Node] = []
    for path in paths:
        chosen = [n for n in nodes if n.path == path and not n.dropped and n.parent is not None]
        if chosen:
            break
    if not chosen:
        own, _ = winner(nodes)
        chosen = [own] if own is not None else [n for n in nodes if n.tag == "body"][:1] or nodes[:1]
    inside = {id(n) for n in chosen}
    for node in nodes:
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
    return "\n".join(text for node, text in blocks if id(node) in inside and not node.dropped)


def _vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [winner(parse(source or "")[1]) for source in batch.column(1).to_pylist()]
        paths = pa.array([n.path if n is not None else None for n, _ in found], pa.string())
        part = pa.RecordBatch.from_arrays([batch.column(0), paths, pa.array([s for _, s in found], pa.int64())], ["host", "path", "score"])
        yield part.filter(paths.is_valid())


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(s or "", p or []) for s, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): per host the paths that won, the strongest first; at most ``1 / QUORUM`` of them."""
    votes = pages.mapInArrow(_vote, "host string, path string, score long").groupBy("host", "path").agg(F.sum("score").alias("votes"))
    # Few rows per host: one for each path that some page chose.
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    strong = votes.join(total, "host").where(F.col("votes") >= QUORUM * F.col("total"))
    ranked = strong.groupBy("host").agg(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("p"))
    return ranked.select("host", F.col("p.path").alias("paths"))


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    paths = written(host_paths(rows.select("host", "html")), "host-paths")
    # The join splits a host with very many pages; the paths have one row per host.
    joined = rows.join(paths, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
