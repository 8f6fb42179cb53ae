"""Main text of web pages by site template removal.

A page is read into its tree of block elements.  Every subtree gets a hash of its tag, its place
(the tags and classes above it), its text and its children; Spark counts, per host, the pages that
hold each subtree, and subtrees that recur across many pages of a host are its template and are
deleted.  Copies of one article must not make it a template, so pages of a host with the same longest
block of text count once.

How often is many depends on where a subtree is: outside an ``<article>`` (or main part) structural
subtrees (menus, divisions, tables, ...) go from ``SHARE`` of the host's pages on, and prose (paragraphs,
headings, list items, cells, plain divisions) from ``PROSE_SHARE``; inside one, where sentences repeat by
themselves, only what nearly all pages hold (``INNER_SHARE``, ``INNER_PAGES``) goes.  A host of few pages
shows no template, so elements that are never main text (navigation, headers, footers, asides, forms,
hidden elements, and those whose role, class or id names a menu, notice, advert, comments and so on) go as well;
scripts, styles and comments are never read.

The text is what is left of the article (of several, all; else of the main part, else of the body): block by
block in page order, character references decoded, white space inside a block one space, blocks joined by a
line end.  ``<br>`` is white space.

Only one row of subtree hashes per page is shuffled.  The templates are written and their size is checked: up to
``BROADCAST_HASHES`` hashes they are broadcast, beyond that pages meet them by host and one of ``SALTS`` numbers, so
that a hot host's pages are spread.

Defined cases: null html and html without text give an empty string; a null url or one without ``://`` is
of the host ''; unclosed, crossing and stray tags are read much as browsers do (a paragraph ends
at the next block); repeated rows count as one page; an empty table gives an empty result; of other columns those
asked for are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.shared import written

#: A structural subtree is template from this share of a host's pages on (and ``MIN_PAGES``).
SHARE, MIN_PAGES = 0.01, 3
PROSE_SHARE = 0.5
INNER_SHARE, INNER_PAGES = 0.8, 10
#: Template hashes of all hosts (8 bytes each) that are broadcast; more are joined by a shuffle over so many salts.
BROADCAST_HASHES, SALTS = 1_000_000, 32

# Names of HTML, and words that mark what is not main text.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_GONE = {"head", "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "nav", "header", "footer", "aside",
         "menu", "form", "button", "select", "option", "datalist", "fieldset", "dialog", "audio", "video", "textarea", "title", "noembed", "noframes"}
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "li", "dt", "dd", "td", "th", "tr", "caption"}
_BLOCKS = _PROSE | {"html", "body", "div", "section", "article", "main", "ul", "ol", "li", "dl", "dt", "dd", "table", "caption", "thead", "tbody",
                    "tfoot", "tr", "td", "th", "address", "center", "details", "summary", "figure", "hgroup", "hr", "legend", "search"} | _GONE
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
_MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
          "cookie", "cookies", "consent", "gdpr", "notice", "newsletter", "subscribe", "subscription", "signup", "login", "paywall", "popup", "modal", "overlay",
          "sidebar", "aside", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "masthead", "header",
          "footer", "footnav", "comment", "comments", "disqus", "respond", "replies", "related", "recommended", "recommendations", "share", "sharing",
          "social", "widget", "skip"}
#: Open elements that end where the element named begins.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "td": ("td", "th"), "th": ("td", "th"),
           "tr": ("tr", "td", "th"), "thead": ("thead", "tbody", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
           "tfoot": ("thead", "tbody", "tr", "td", "th")}
#: Elements that such an end does not reach through.
_WALLS = {"ul", "ol", "dl", "table", "select", "menu", "article", "section", "main", "body", "html", ""}
#: Elements below this depth are siblings (as browsers do from 512 on).
MAX_DEPTH = 200
#: Outside an article, a list with this share of its text in three links or more is a menu.
LINKED, LINKS = 0.8, 3

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)"
                    r"|<([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|=)*)(>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.S)
_CLASS_WORD = re.compile(r"[a-z]+")


class Node:
    """A block element, a link or a marked inline element; its texts and elements in page order."""

    __slots__ = ("tag", "names", "gone", "marked", "inline", "parts")

    def __init__(self, tag: str, names: str = "", gone: bool = False, marked: bool = False):
        self.tag, self.names, self.gone, self.marked = tag, names, gone or marked, marked
        self.inline = tag not in _BLOCKS
        self.parts: list = []


def _node(tag: str, attributes: str) -> Node:
    if not attributes:
        return Node(tag, gone=tag in _GONE)
    a = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
    names = f"{a.get('class', '')} {a.get('id', '')}".strip().lower()
    role = a.get("role", "").lower()
    gone = (tag in _GONE or role in _ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
            or "display:none" in a.get("style", "").replace(" ", "").lower())
    marked = bool(names) and tag not in ("html", "body", "main") and not _MARKS.isdisjoint(_CLASS_WORD.findall(names))
    if role in ("main", "article"):
        tag = role
    elif "articlebody" in a.get("itemprop", "").lower():
        tag = "article"
    return Node(tag, names, gone, marked)


def parse(html: str) -> Node:
    """The page as a tree of block elements, links and marked elements; other markup is left out."""
    root = Node("")
    stack, at, n, articles = [root], 0, len(html), 0

    def is_open(names, walls=()) -> bool:
        for node in reversed(stack):
            if node.tag in names:
                return True
            if node.tag in walls:
                return False
        return False

    def close(names) -> None:
        while stack[-1].tag not in names:
            stack.pop()
        stack.pop()

    while at < n:
        m = _TOKEN.search(html, at)
        upto = m.start() if m else n
        if at < upto:
            stack[-1].parts.append(html[at:upto])
        if m is None:
            break
        at = m.end()
        if m[1] is not None:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].parts.append(" ")
            elif is_open((tag,), () if tag in _BLOCKS else _BLOCKS):
                close((tag,))
        elif m[2] is not None:
            tag = m[2].lower()
            if not m[4]:
                break  # cut off inside a tag
            if tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|$)", re.I).search(html, at)
                at = end.end() if end else n
                continue
            if tag in _BLOCKS and is_open(("p",), _WALLS):
                close(("p",))
            if tag in _VOID:
                if tag in ("br", "hr"):
                    stack[-1].parts.append(" " if tag == "br" else Node("hr"))
                continue
            while tag in _CLOSES and is_open(_CLOSES[tag], _WALLS):
                close(_CLOSES[tag])
            node = _node(tag, m[3])
            if node.inline and not node.gone and tag != "a":
                continue
            if node.tag in ("article", "main") and not node.gone:
                articles += 1
                if articles == 1:  # what holds the page's article is no menu or notice, whatever its class
                    for x in stack:
                        x.gone = x.gone and not x.marked
            if len(stack) > MAX_DEPTH:
                stack.pop()
            stack[-1].parts.append(node)
            stack.append(node)
    return root


def _digest(*parts: str) -> int:
    """A signed 64-bit hash."""
    h = xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def squeezed(text: str) -> str:
    return " ".join(unescape(text).split())


class Subtree(NamedTuple):
    hash: int
    node: Node
    kind: int  # 0: structural, 1: prose, 2: inside an article or main part


def subtrees(root: Node) -> tuple[list[Subtree], int]:
    """The subtrees of a page that hold text, and the hash of its longest block outside gone elements."""
    found: list[Subtree] = []
    longest = (-1, 0)

    def walk(node: Node, place: int, inner: bool, gone: bool) -> int | None:
        nonlocal longest
        inner, gone = inner or node.tag in ("article", "main"), gone or node.gone
        here = _digest(str(place), node.tag, node.names)
        own, run, blocks = [], [], 0

        def flush() -> None:
            nonlocal longest
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                own.append(text)
                if not gone and len(text) > longest[0]:
                    longest = (len(text), _digest(text))

        for x in node.parts:
            if isinstance(x, str):
                run.append(x)
            elif x.inline:
                if not x.gone:
                    run.extend(_inline(x))
            else:
                flush()
                h = walk(x, here, inner, gone)
                if h is not None:
                    blocks += 1
                    own.append(f"\x1e{h}")
        flush()
        if not own:
            return None
        h = _digest(str(here), *own)
        if node.tag not in ("", "html", "body", "main", "article"):
            prose = node.tag in _PROSE or node.tag == "div" and not blocks and not node.names
            found.append(Subtree(h, node, 2 if inner else 1 if prose else 0))
        return h

    walk(root, 0, False, False)
    return found, longest[1]


def _inline(node: Node) -> list[str]:
    out: list[str] = []
    for x in node.parts:
        if isinstance(x, str):
            out.append(x)
        elif not x.gone:
            out.append(" " if not x.inline else "")
            out.extend(_inline(x))
    return out


def _links(node: Node) -> tuple[int, int, int]:
    """Links, characters in links, and all characters of an element."""
    n, linked, every = 0, 0, 0
    for x in node.parts:
        if isinstance(x, str):
            every += len(x.strip())
        elif not x.gone:
            a, b, c = _links(x)
            n, linked, every = n + a + (x.tag == "a"), linked + (c if x.tag == "a" else b), every + c
    return n, linked, every


def main_blocks(root: Node, deleted: set[int]) -> list[str]:
    """Text blocks of the main part, without gone elements and the nodes (by ``id``) in ``deleted``."""
    articles: list[Node] = []
    mains: list[Node] = []

    def look(node: Node) -> None:
        for x in node.parts:
            if isinstance(x, str) or x.gone or id(x) in deleted:
                continue
            if x.tag == "article":
                articles.append(x)
                continue
            if x.tag == "main":
                mains.append(x)
            look(x)

    look(root)
    for group in (articles, mains[:1], [root]):
        blocks: list[str] = []
        for node in group:
            _blocks(node, deleted, blocks, node.tag == "article")
        if blocks:
            return blocks
    return []


def _blocks(node: Node, deleted: set[int], out: list[str], article: bool) -> None:
    run: list[str] = []

    def flush() -> None:
        text = squeezed("".join(run))
        run.clear()
        if text:
            out.append(text)

    for x in node.parts:
        if isinstance(x, str):
            run.append(x)
        elif x.inline:
            if not x.gone:
                run.extend(_inline(x))
        else:
            flush()
            if x.gone:
                if article and (x.tag == "header" or "header" in x.names):  # an article's own header holds its headings
                    for h in _headings(x):
                        _blocks(h, deleted, out, article)
            elif id(x) not in deleted and (article or not _menu(x)):
                _blocks(x, deleted, out, article)
    flush()


def _menu(node: Node) -> bool:
    if node.tag not in ("ul", "ol"):
        return False
    n, linked, every = _links(node)
    return n >= LINKS and linked >= LINKED * every


def _headings(node: Node) -> list[Node]:
    out: list[Node] = []
    for x in node.parts:
        if not isinstance(x, str) and not x.gone:
            out.extend([x] if re.fullmatch("h[1-6]", x.tag) else _headings(x))
    return out


# ---- the operator ------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, lower-cased; else ''."""
    found = F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


_COUNTED = "host string, page bigint, content bigint, subtrees array<struct<hash:bigint,kind:int>>"


def _described(batches):
    """Per page: its host, the hash of the whole page, of its longest block, and its distinct subtrees."""
    for b in batches:
        pages, contents, lists = [], [], []
        for html in b.column("html").to_pylist():
            found, longest = subtrees(parse(html or ""))
            pages.append(_digest(html or ""))
            contents.append(longest)
            lists.append([{"hash": h, "kind": k} for h, k in sorted({(s.hash, s.kind) for s in found})])
        yield pa.RecordBatch.from_arrays(
            [b.column("host"), pa.array(pages, pa.int64()), pa.array(contents, pa.int64()),
             pa.array(lists, pa.list_(pa.struct([("hash", pa.int64()), ("kind", pa.int32())])))], names=["host", "page", "content", "subtrees"])


def templates(pages: DataFrame) -> DataFrame:
    """``host, template``: the hashes of each host's recurring subtrees (``pages``: ``host, html``)."""
    rows = pages.select("host", "html").mapInArrow(_described, _COUNTED)
    # a subtree counts once per host and content; all partial counts are made before the shuffles
    held = rows.select("host", "content", F.explode("subtrees").alias("s")).groupBy("host", "content", "s.hash").agg(F.max("s.kind").alias("kind"))
    counts = held.groupBy("host", "hash").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n"))
    hosts = rows.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    share = F.when(F.col("kind") == 2, INNER_SHARE).when(F.col("kind") == 1, PROSE_SHARE).otherwise(SHARE)
    least = F.when(F.col("kind") == 2, INNER_PAGES).otherwise(MIN_PAGES)
    often = counts.filter(F.col("n") >= least).join(hosts, "host").filter(F.col("n") >= share * F.col("pages"))
    # at most (subtrees of a page) / SHARE hashes a host
    return often.groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("template"))


def _with_template(rows: DataFrame, broadcast_hashes: int) -> DataFrame:
    found = written(templates(rows), "html-templates")
    if (found.agg(F.sum(F.size("template"))).first()[0] or 0) <= broadcast_hashes:
        return rows.join(F.broadcast(found), "host", "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(found, ["host", "salt"], "left")


def extracted(pages: DataFrame, carry: Sequence[str] = ("page_id", "url"), broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """The ``carry`` columns, ``text`` and ``n_template`` (subtrees deleted as the host's template) of each row of
    ``pages`` (``url``, ``html``)."""
    rows = pages.select(F.struct(*carry).alias("carried"), host_of(F.col("url")).alias("host"), "html")
    told = _with_template(rows, broadcast_hashes).select("carried", "html", "template")
    carried = told.schema["carried"].dataType.simpleString()

    def run(batches):
        seen: dict[bytes, frozenset] = {}
        for b in batches:
            texts, counts = [], []
            for html, template in zip(b.column("html").to_pylist(), b.column("template"), strict=True):
                root = parse(html or "")
                deleted: set[int] = set()
                if template.is_valid:
                    key = template.values.to_numpy().tobytes()
                    if key not in seen:
                        if len(seen) > 1000:
                            seen.clear()
                        seen[key] = frozenset(template.values.to_pylist())
                    deleted = {id(s.node) for s in subtrees(root)[0] if s.hash in seen[key]}
                texts.append("\n".join(main_blocks(root, deleted)))
                counts.append(len(deleted))
            yield pa.RecordBatch.from_arrays([b.column("carried"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                                             names=["carried", "text", "n_template"])

    return told.mapInArrow(run, f"carried {carried}, text string, n_template bigint").select("carried.*", "text", "n_template")
