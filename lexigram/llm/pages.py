"""Main text of web pages: per-host templates are found by counting element subtrees, and cut out.

*Pass 1* parses every page into a tree of its block elements and hashes each subtree (tag, class, id, text, children). Spark
counts on how many pages of its host, and of its section of the host (the path up to the last slash), a subtree stands; pages
of equal main text count once, so copies of an article don't make its paragraphs a template. Beside the article, subtrees on at
least ``MIN_PAGES`` pages of a host are templates, however many pages it has. Within it, where a table or list may be the
article's own, they are templates only if they also stand on ``SHARE`` of the pages of the section or the host.

*Pass 2* gives each page the templates that it holds, drops them, and writes out the rest of the article.

Besides templates, elements that say what they are go: navigation, headers, footers, asides, forms, scripts, styles, comments,
and elements whose class, id or role names a menu, advert, notice, sidebar, reader comments and the like. The article is what
stands in ``article`` elements, else in ``main`` or its like, else in the body. Headings of a header within it stay, be it one by tag
or by class or id. Paragraphs within
an article element are templates only as notices, on at least ``NOTICE_PAGES`` pages and ``NOTICE_SHARE`` of the host's pages: a line
that many stories share is text. Headings, list items, cells and the like within it are never taken for a template.

Blocks are joined by one newline in page order; white space within a block, ``br`` included, is one blank; character references
are decoded. Unclosed elements end where HTML ends them or with their parent. Null or empty html gives an empty text; pages
without a host, or on a host with fewer than ``MIN_PAGES`` pages, have no templates. Rows that repeat give repeated results.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigram.llm.common import map_batches
from lexigram.session import stored

MIN_PAGES = 4
SHARE = 0.5
NOTICE_PAGES, NOTICE_SHARE = 20, 0.95

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|object|svg|math|textarea|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_BLANKS = re.compile(r"\s+")

#: Elements within a line of text; they don't end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter nobr output picture"
    " progress q ruby rb rp rt s samp small source span strike strong sub sup time tt u var wbr br link meta".split()
)
_VOID = frozenset("area base col embed hr param track".split())
_DROPPED = frozenset("head nav footer aside form menu dialog button fieldset audio video canvas map".split())
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt figcaption td th tr tbody caption address".split())
#: Text blocks that may be notices within an article; ``_MARKS`` keep the keys of notices and of what stands within an article apart.
_NOTICES = frozenset("p pre blockquote address".split())
BESIDE, NOTICE, WITHIN = range(3)
_MARKS = (0, 0x5DEECE66D, 0x2545F4914F6CDD1D)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Starting one of these ends an open one of those.
_ENDS = {t: frozenset([t]) for t in ("li", "tr", "option")}
_ENDS |= {t: frozenset(["dt", "dd"]) for t in ("dt", "dd")} | {t: frozenset(["td", "th"]) for t in ("td", "th")}
_BARRIERS = frozenset("ul ol dl table body article main section div".split())

#: The word by which an element within an article says that it is its header.
_HEADER = re.compile(r"(?:(?<=[\s_-])|^)header(?=$|[\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar".split())
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?\w*|consent|gdpr|notice|notification|popup|modal|overlay"
    r"|newsletter|subscri\w+|share|sharing|social|breadcrumbs?|menu|nav|navbar|navigation|sidebar|side|related|recommend\w*"
    r"|comments?|replies|disqus|respond|footer|header|masthead|toolbar|pagination|pager|widgets?|login|signup|disclaimer)(?:$|[\s_-])",
    re.I,
)


class Node:
    __slots__ = ("tag", "named", "role", "main", "children", "key", "chars")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.key, self.chars = tag, [], 0, 0
        self.named = self.role = ""
        self.main = tag in ("article", "main")
        if attributes:
            names = []
            for name, value in _ATTRIBUTE.findall(attributes):
                value, name = value.strip("\"'"), name.lower()
                if name in ("class", "id"):
                    names.append(value)
                elif name == "role":
                    self.role = value.lower()
                elif name == "itemprop":
                    self.main |= value.lower() == "articlebody"
                elif name == "hidden" or value.lower() == "true":
                    self.role = "hidden"
            self.named = " ".join(names)
            self.main |= self.role == "main"

    def dropped(self, by_name: bool = True) -> bool:
        """Whether the element itself says that it isn't part of an article."""
        if self.tag in _DROPPED or self.role in _ROLES or self.role == "hidden":
            return True
        return by_name and bool(self.named) and self.tag not in ("html", "body", "main") and bool(_NAMED.search(self.named))

    def headed(self) -> bool:
        """Whether the element is a header, and nothing else that isn't part of an article, by its tag or names."""
        if self.dropped(False):
            return False
        return self.tag == "header" and not self.dropped() or bool(_HEADER.search(self.named)) and not _NAMED.search(_HEADER.sub("", self.named))


def parse(html: str) -> Node:
    """The tree of block elements; children are nodes and pieces of text, a blank for each ``br``."""
    root = Node("html")
    stack, done = [root], 0

    def close(at: int) -> None:
        del stack[at:]

    for m in _MARKUP.finditer(html):
        if m.start() > done:
            stack[-1].children.append(unescape(html[done : m.start()]))
        done = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br":
                stack[-1].children.append(" ")
            continue
        if m["end"]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == tag:
                    close(at)
                    break
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        ends = _ENDS.get(tag, frozenset(["p"]))
        for at in range(len(stack) - 1, 0, -1):
            if stack[at].tag in ends or stack[at].tag == "p":
                close(at)
                break
            if stack[at].tag in _BARRIERS:
                break
        node = Node(tag, m["attributes"] or "")
        stack[-1].children.append(node)
        if tag not in _VOID and not (m["attributes"] or "").endswith("/"):
            stack.append(node)
    if done < len(html):
        stack[-1].children.append(unescape(html[done:]))
    return root


def _post_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in node.children if isinstance(c, Node))
    return out[::-1]


def hash_subtrees(root: Node) -> None:
    """Set ``key`` (a 64-bit hash of tag, names, text and children) and ``chars`` (of visible text) of every node."""
    for node in _post_order(root):
        parts, chars = [node.tag, node.named], 0
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"\x00{child.key}")
                chars += child.chars
            else:
                text = " ".join(child.split())
                parts.append(text)
                chars += len(text)
        node.key, node.chars = xxhash.xxh64_intdigest("\x01".join(parts)) - 2**63, chars


def _main_nodes(root: Node) -> list[Node]:
    """Outermost article elements; else outermost elements that hold the main text; else the whole page.

    Names like "with-sidebar" may stand on an element around the article: they only count where an article is found besides.
    """
    tests, empty = (lambda n: n.tag == "article", lambda n: n.main), []
    for wanted, by_name in [(t, b) for b in (True, False) for t in tests]:
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node is not root and node.dropped(by_name):
                continue
            if wanted(node):
                found.append(node)
            else:
                todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
        if any(n.chars for n in found):
            return found
        empty = empty or found
    return empty or [root]


def _kind(node: Node, in_article: bool, whole: bool) -> int | None:
    """What a subtree must be to be a template; None if it can't be one."""
    if whole:
        return WITHIN
    if not in_article:
        return BESIDE
    if node.tag not in _TEXT_BLOCKS:
        return WITHIN
    return NOTICE if node.tag in _NOTICES else None


def removable(root: Node) -> list[tuple[int, int]]:
    """Keys of the subtrees that may be templates, and their kinds."""
    mains = _main_nodes(root)
    whole = mains == [root]
    around = {id(n) for n in mains}
    for node in _post_order(root):
        if any(id(c) in around for c in node.children if isinstance(c, Node)):
            around.add(id(node))
    keys, todo = set(), [(root, False)]
    while todo:
        node, in_main = todo.pop()
        if node.chars and id(node) not in around and node.tag not in ("body", "head"):
            if (kind := _kind(node, in_main, whole)) is not None:
                keys.add((node.key ^ _MARKS[kind], kind))
        in_main = in_main or (node in mains and not whole)
        todo.extend((c, in_main) for c in node.children if isinstance(c, Node))
    return sorted(keys)


def main_text(root: Node, templates: frozenset[int] = frozenset()) -> str:
    """Blocks of the article, without templates and what isn't article.

    Names that leave nothing of a page of several paragraphs without an article don't count.
    """
    text = _blocks_text(root, templates, True)
    if text or _main_nodes(root) != [root] or sum(n.tag == "p" and n.chars > 0 for n in _post_order(root)) < 2:
        return text
    return _blocks_text(root, templates, False)


def _blocks_text(root: Node, templates: frozenset[int], by_name: bool) -> str:
    blocks: list[list[str]] = [[]]
    mains = _main_nodes(root)
    whole = mains == [root]

    def template(node: Node) -> bool:
        kind = _kind(node, True, whole)
        return kind is not None and node.key ^ _MARKS[kind] in templates

    def walk(top: Node) -> None:
        todo: list = [(top, False)]
        while todo:
            item, headings = todo.pop()
            if item is None:
                blocks.append([])
                continue
            if isinstance(item, str):
                if not headings:
                    blocks[-1].append(item)
                continue
            if item is not top:
                header = not whole and item.headed()
                if (item.dropped(by_name) and not header) or template(item):
                    continue
                headings = (headings or header or item.tag == "header") and item.tag not in _HEADINGS
            blocks.append([])
            todo.append((None, False))
            todo.extend((c, headings) for c in reversed(item.children))

    for node in mains:
        walk(node)
    texts = (_BLANKS.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n".join(t for t in texts if t)


def host(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)


def section(url: Column) -> Column:
    """The path of a URL up to its last slash."""
    return F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+((?:/[^/?#]*)*/)", 1)


def subtrees(pages: DataFrame) -> DataFrame:
    """``(page, host, section, content, subtree, kind)``: the distinct removable subtrees of each page. ``pages``: page, host,
    section, html."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(6)]
        for page, name, part, html in zip(*(c.to_pylist() for c in batch.columns)):
            root = parse(html)
            hash_subtrees(root)
            content = xxhash.xxh64_intdigest(main_text(root)) - 2**63
            for key, kind in removable(root):
                for column, value in zip(columns, (page, name, part, content, key, kind)):
                    column.append(value)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        names = ["page", "host", "section", "content", "subtree", "kind"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    schema = "page bigint, host string, section string, content bigint, subtree bigint, kind int"
    return map_batches(pages.select("page", "host", "section", "html"), make, schema)


def _scoped(found: DataFrame) -> DataFrame:
    """Subtrees once for their host (a scope), and once more for their section if that counts for their kind."""
    whole = F.col("host")
    part = F.concat_ws(" ", "host", "section")
    return found.withColumn("scope", F.explode(F.when(F.col("kind") == WITHIN, F.array(whole, part)).otherwise(F.array(whole))))


def templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(scope, subtree)`` of the templates, from ``subtrees``; a scope is a host, or a host and a section."""
    once = _scoped(found).select("scope", "content", "subtree", "kind").distinct()
    counts = once.groupBy("scope", "subtree", "kind").agg(F.count(F.lit(1)).alias("n"))
    least = F.when(F.col("kind") == NOTICE, max(min_pages, NOTICE_PAGES)).otherwise(min_pages)
    often = stored(counts.where(F.col("n") >= least), "counts")
    parts = found.select("host", F.concat_ws(" ", "host", "section").alias("part"), "content").distinct()
    scopes = parts.select(F.explode(F.array("host", "part")).alias("scope"), "content").distinct()
    totals = stored(scopes.groupBy("scope").agg(F.count(F.lit(1)).alias("pages")), "totals")
    share = F.when(F.col("kind") == NOTICE, NOTICE_SHARE).otherwise(SHARE)
    shared = often.where(F.col("kind") != BESIDE).join(totals, "scope").where(F.col("n") >= share * F.col("pages"))
    return often.where(F.col("kind") == BESIDE).select("scope", "subtree").unionByName(shared.select("scope", "subtree"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` (page_id, url, html, ...) as ``(page_id, url, text)``."""
    html = F.coalesce("html", F.lit(""))
    named = {"host": host(F.col("url")), "section": section(F.col("url")), "page": F.xxhash64("page_id", "url", "html")}
    keyed = pages.select("page_id", "url", html.alias("html")).withColumns(named)
    found = stored(subtrees(keyed.where("host != ''")), "subtrees")
    often = stored(templates(found, min_pages), "templates")
    held = _scoped(found).join(often, ["scope", "subtree"]).groupBy("page").agg(F.collect_set("subtree").alias("templates"))
    held = stored(held, "held")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for html, keys in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            root = parse(html)
            hash_subtrees(root)
            texts.append(main_text(root, frozenset(keys or ())))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    # html is shuffled once, at any size; the templates of a page are the smaller side and are hashed
    rows = keyed.join(held.hint("shuffle_hash"), "page", "left").select("page_id", "url", "html", "templates")
    return map_batches(rows, make, "page_id bigint, url string, text string")


def report(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
