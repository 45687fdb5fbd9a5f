"""HTML extraction (3): site template removal, then the main text of what is left.

Every page becomes an element tree.  Spark counts the hashes of all element
subtrees per host, once for each distinct page of the host; a subtree found on
``MIN_PAGES`` pages recurs.  A second pass over the pages deletes template
subtrees and the elements whose tag, role or class names say that they are not
text (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
comments), and joins the text blocks of the article - of ``<article>`` or
``<main>`` where the page has one, else of the body.  Names are class and
id tokens, and an element with a layout's name, or a form, that wraps the page's
text is not dropped.  A name joined with ``-`` or ``_`` counts if its other
parts are plain nouns of layout (``comments-area``).  Hidden elements are dropped.

Outside an article every recurring subtree is template, a plain text block from
``MIN_SHARE`` of the host's pages.  Inside, plain text blocks are text that
several articles share and stay, others are template from ``MIN_SHARE``.  Where
several pages hold the same article all its subtrees recur: what recurs on no
more pages than most of the article's text (``SHARED`` of the text of a page
without article) is not template, unless, outside an article, it is on more
than ``HOST_WIDE`` of the host's pages.

Recurring subtrees are broadcast as sorted keys of host and hash while their
size stays under ``BROADCAST_BYTES``, else joined by that key.

Defined cases: null or empty html gives an empty text; a page whose url has no
host is not compared with others; broken markup is closed as a browser would;
repeated pages count once for templates and each keep their row; other columns
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import staged
from sparkrec.llm.urls import host_of

MIN_PAGES = 4
MIN_SHARE = 0.05
SHARED = 0.8
HOST_WIDE = 0.75
BROADCAST_BYTES = 32 << 20
KEY_BYTES = 16

TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)([^>\"']*)")
UNQUOTED = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[-_]+")

# Element names of HTML by the part they play.
RAW = set("script style textarea title xmp iframe noembed noframes".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td "
             "tfoot th thead tr ul".split())
TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
WALLS = set("ul ol dl table select article main section div body html nav aside footer header form".split())
DROPPED = set("head nav footer aside script style noscript template iframe svg canvas button select textarea "
              "title object dialog menu".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
DROPPED_NAMES = set("nav navbar navigation menu sidebar aside ad ads advert adverts advertisement advertising sponsor "
                    "sponsored promo cookie cookies consent notice notices gdpr popup modal newsletter subscribe "
                    "subscription signup share sharing social comment comments respond disqus breadcrumb breadcrumbs "
                    "related recommended widget footer copyright pagination pager login".split())
COMMENT_NAMES = set("comment comments respond disqus".split())
#: Dropped names that a layout also gives to what surrounds the text.
WRAPPER_NAMES = set("nav navigation sidebar aside widget".split())
#: What a dropped name may be joined with and still name the thing itself (``comments-area``, ``site-footer``); a
#: name with any other part (``has-sidebar``, ``comments-open``) describes something else.
NEUTRAL_PARTS = set("site page main post entry area list section banner button buttons bar box block wrapper wrap container "
                    "inner outer item items link links form title top bottom left right global primary secondary content "
                    "header message reader user reply thread panel group text".split())


def name_kinds(names: frozenset[str]) -> frozenset[str]:
    """The dropped names that the class and id tokens ``names`` are, or are joined from."""
    out = names & DROPPED_NAMES
    for name in names:
        if "-" in name or "_" in name:
            parts = set(NAME_PARTS.split(name)) - {""}
            if parts <= DROPPED_NAMES | NEUTRAL_PARTS:
                out |= parts & DROPPED_NAMES
    return out


class Node:
    __slots__ = ("tag", "names", "kinds", "role", "hidden", "parts", "hash", "text", "links")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.names, self.kinds, self.role, self.hidden = tag, frozenset(), frozenset(), "", False
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if key in ("class", "id"):
                    self.names |= frozenset(value.split())
                elif key == "role":
                    self.role = value.strip()
                elif key == "hidden":
                    self.hidden |= value != "until-found"
                elif key == "style":
                    self.hidden |= "display:none" in "".join(value.split())
            if self.names:
                self.kinds = name_kinds(self.names)
        self.parts: list = []
        self.hash, self.text, self.links = 0, False, tag in ("a", "img")

    def close(self) -> None:
        digest = [self.tag, *sorted(self.names)]
        for p in self.parts:
            if isinstance(p, Node):
                digest.append(str(p.hash))
                self.text |= p.text
                self.links |= p.links
            elif words := p.split():
                digest.append(" ".join(words))
                self.text = True
        self.hash = xxhash.xxh64_intdigest("\x00".join(digest)) - (1 << 63)

    def dropped(self) -> bool:
        """Never text, whatever it holds."""
        return self.tag in DROPPED or self.role in DROPPED_ROLES or self.hidden

    def named(self, inside: bool) -> bool:
        """Not text by its names or as a form, unless it wraps the page's text."""
        return (self.tag == "form" or bool(self.kinds)
                or (not inside and (self.tag == "header" or "header" in self.names)))

    def article(self) -> bool:
        return self.tag in ("article", "main") or self.role == "main"


def parse(page: str) -> Node:
    """The element tree; text of comments, scripts, styles and titles is left out."""
    root = Node("html", "")
    stack, at, shown = [root], 0, 0  # shown: where text that is not yet in the tree begins
    held: dict[str, int] = {}  # open elements of each tag

    def pop() -> None:
        node = stack.pop()
        held[node.tag] = held.get(node.tag, 0) - 1
        node.close()

    def text_to(end: int) -> None:
        if end > shown:
            stack[-1].parts.append(entities.unescape(page[shown:end]))

    while (open_at := page.find("<", at)) >= 0:
        m = TAG.match(page, open_at + 1)
        if not m:
            if page.startswith("!--", open_at + 1):
                end = page.find("-->", open_at + 4)
                end = end + 3 if end >= 0 else len(page)
            elif page[open_at + 1:open_at + 2] in ("!", "?"):
                end = page.find(">", open_at) + 1
                if not end:
                    break  # no tag ends from here on: the rest is text
            else:
                at = open_at + 1
                continue
            text_to(open_at)
            shown = at = end
            continue
        end = m.end()
        while (mark := page[end:end + 1]) in ("'", '"') and mark:
            close = page.find(mark, end + 1)
            end = page.find(">", end) if close < 0 else UNQUOTED.match(page, close + 1).end()
            if end < 0:
                break
        if end < 0 or end >= len(page):
            break
        text_to(open_at)
        tag, attributes = m[2].lower(), page[m.start(3):end]
        shown = at = end + 1
        if m[1]:
            if held.get(tag, 0) > 0:
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in ("html", "body"):
            continue
        over = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        if any(held.get(t, 0) > 0 for t in over):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in over:
                    while len(stack) > depth:
                        pop()
                    break
                if stack[depth].tag in WALLS:
                    break
        node = Node(tag, attributes)
        stack[-1].parts.append(node)
        if tag in RAW:
            raw_end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            shown = at = raw_end.start() if raw_end else len(page)
        if tag in VOID or (attributes.endswith("/") and tag not in BLOCKS and tag not in RAW):
            node.close()
        else:
            stack.append(node)
            held[tag] = held.get(tag, 0) + 1
    text_to(len(page))
    while stack:
        pop()
    return root


def walk(root: Node, into: Callable[[Node], bool] = lambda n: True) -> Iterator[Node]:
    """Elements, each before those inside it."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(p for p in node.parts if isinstance(p, Node) and into(p))


def subtree_hashes(root: Node) -> list[int]:
    """Hashes of the distinct subtrees that hold text, the whole page's first."""
    found = dict.fromkeys(n.hash for n in walk(root) if n.text)
    found.pop(root.hash, None)
    return [root.hash, *found]


def own_sizes(root: Node) -> dict[Node, int]:
    """Characters outside links of each element that can be text."""
    nodes = list(walk(root, lambda n: not n.dropped()))
    sizes: dict[Node, int] = {}
    for n in reversed(nodes):
        sizes[n] = 0 if n.tag == "a" else sum(sizes.get(p, 0) if isinstance(p, Node) else len(p.strip()) for p in n.parts)
    return sizes


def articles(root: Node, into: Callable[[Node], bool]) -> list[Node]:
    """Outermost articles with text, of the root and the elements that ``into`` admits, in page order."""
    starts, todo = [], [root]
    while todo:
        node = todo.pop()
        if node is not root and (node.dropped() or not into(node)):
            continue
        if node.article():
            starts.append(node)
        else:
            todo.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return [n for n in starts if n.text]


def shared_by(texts: list[tuple[int, int]], share: float) -> int:
    """The most pages that ``share`` of the text is on; ``texts`` are (pages, characters)."""
    left = share * sum(size for _, size in texts)
    for n, size in sorted(texts, reverse=True):
        left -= size
        if left <= 0:
            return n
    return 0


def main_text(root: Node, recurring: Mapping[int, int], pages: int = 0, min_share: float = MIN_SHARE) -> str:
    """Blocks of the article in page order, joined by a blank line.

    ``recurring`` has the number of pages by subtree hash, ``pages`` is the host's.

    Articles outside named elements come first; articles in or of named
    elements are taken if they hold more than the page without them, those of
    comments only if nothing else is left.
    """
    sizes = own_sizes(root)
    holders: set[Node] = set()  # forms around an article or main
    for n in sizes:
        if n.article() and n.text or any(isinstance(p, Node) and p in holders for p in n.parts):
            holders.add(n)

    def wraps(node: Node) -> bool:
        """A form or an element of a joined layout name around an article, or of a layout's name around most of the page."""
        if not node.kinds <= WRAPPER_NAMES:
            return False
        return node in holders and not node.names & DROPPED_NAMES or 2 * sizes[node] > sizes[root]

    def shown(inside: bool) -> Callable[[Node], bool]:
        return lambda node: not (node.dropped() or node.named(inside) and not wraps(node))

    def copies(starts: list[Node], inside: bool) -> int:
        """The number of pages that hold the same text as this one."""
        texts = []
        for node in (n for start in starts for n in walk(start, shown(inside))):
            n = recurring[node.hash] if node.hash in recurring else 1
            if node.tag != "a" and (inside or n <= HOST_WIDE * pages):
                texts.append((n, sum(len(p.strip()) for p in node.parts if isinstance(p, str))))
        return shared_by(texts, 0.5 if inside else SHARED)

    def template(node: Node, inside: bool, same: int) -> bool:
        if node.hash not in recurring or node.tag in ("article", "main"):
            return False
        n, plain = recurring[node.hash], node.tag in TEXT_BLOCKS and not node.links
        if (inside and plain) or ((inside or plain) and n < min_share * pages):
            return False
        return n > same or (not inside and n > HOST_WIDE * pages)

    def blocks_of(starts: list[Node], inside: bool) -> str:
        same, seen = copies(starts, inside) if recurring else 0, shown(inside)
        blocks: list[str] = []
        run: list[str] = []

        def flush() -> None:
            if words := "".join(run).split():
                blocks.append(" ".join(words))
            run.clear()

        for start in starts:
            work: list = [(p, False) for p in reversed(start.parts)]
            while work:
                part, ends = work.pop()
                if ends:
                    flush()
                elif isinstance(part, str):
                    run.append(part)
                elif part.tag == "br":
                    run.append(" ")
                elif seen(part) and not template(part, inside, same):
                    if part.tag in BLOCKS:
                        flush()
                        work.append((part, True))
                    work.extend((p, False) for p in reversed(part.parts))
            flush()
        return "\n\n".join(blocks)

    if starts := articles(root, lambda n: not n.named(n.article()) or wraps(n)):
        return blocks_of(starts, True)
    wrapped = blocks_of(articles(root, lambda n: not n.kinds & COMMENT_NAMES), True)
    page = blocks_of([root], False)
    return max(wrapped, page, key=len) or blocks_of(articles(root, lambda n: True), True)


def host_key(host: str) -> int:
    return xxhash.xxh64_intdigest(host) - (1 << 63)


def page_keys(rows: DataFrame, name: str) -> DataFrame:
    """(``name``, page, keys) of ``rows`` (``name``, host, html): the host's key and those of all subtrees with text."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, found = [], []
            for host, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hashes, key = subtree_hashes(parse(page)), host_key(host)
                pages.append(hashes[0])
                found.append([key, *(h ^ key for h in hashes[1:])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pages, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             [name, "page", "keys"])

    kind = rows.schema[name].dataType.simpleString()
    return rows.select(name, "host", "html").filter("host != '' AND html IS NOT NULL").mapInArrow(
        keys, f"{name} {kind}, page long, keys array<long>")


def recurring_keys(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(key, n): subtrees on many distinct pages of their host; the host's own key has all its pages."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").withColumn("own", F.col("host"))
    distinct = page_keys(rows, "own").groupBy("own", "page").agg(F.first("keys").alias("keys"))
    counts = distinct.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= min_pages)


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``pages`` (page_id, url, html) as (page_id, url, text, n_chars)."""
    counts = staged(recurring_keys(pages, min_pages), "templates")
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    small = KEY_BYTES * counts.count() <= BROADCAST_BYTES
    if small:
        found = counts.orderBy("key").toArrow()
        shared = pages.sparkSession.sparkContext.broadcast((found["key"].to_numpy(), found["n"].to_numpy()))
        rows = rows.withColumn("found", F.lit(None).cast("array<struct<key:bigint,n:bigint>>"))
    else:
        rows = rows.withColumn("doc", F.xxhash64("host", "html"))
        each = page_keys(rows, "doc").groupBy("doc").agg(F.first("keys").alias("keys"))
        held = each.select("doc", F.explode("keys").alias("key")).hint("merge").join(counts, "key")
        held = held.groupBy("doc").agg(F.collect_list(F.struct("key", "n")).alias("found"))
        rows = rows.hint("merge").join(held, "doc", "left")

    def looked_up(root: Node, key: int) -> dict[int, int]:
        keys, n = shared.value
        own = np.array([0, *subtree_hashes(root)[1:]], np.int64) ^ np.int64(key)
        at = np.searchsorted(keys, own)
        at[at == len(keys)] = 0
        hit = np.flatnonzero(keys[at] == own) if len(keys) else []
        return dict(zip((own[hit] ^ np.int64(key)).tolist(), n[at[hit]].tolist()))

    def text(page: str | None, host: str, found: list | None) -> str:
        if not page:
            return ""
        root, key = parse(page), host_key(host)
        known = {} if not host else looked_up(root, key) if small else {f["key"] ^ key: f["n"] for f in found or ()}
        return main_text(root, known, known.pop(0, 0), min_share)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(map(text, *(batch.column(c).to_pylist() for c in (2, 3, 4))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())],
                                             ["page_id", "url", "text"])

    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"
    out = rows.select("page_id", "url", "html", "host", "found").mapInArrow(texts, schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))
