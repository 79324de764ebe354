"""Main text of web pages by site template removal.

Each page is parsed once into its blocks of text. Every element's subtree, whatever it is named, gets a
hash of its tags and texts and of the tags above it. Spark counts per host on how many pages with
different other text the same subtree stands at the same place; where ``least`` or more such pages
have it, it is template, and is deleted on every page of the host. Counted are different remaining
texts, not pages, so copies of one page do not vote; the bar is a number of pages and does not grow
with the host. Two things are never template: an element that holds more than half of the page's
text or a marked article, and a single text block (paragraph, heading, item; in a marked article also a
list or table) whose container differs from page to page, since sites do publish articles that
quote the same passages.

What is never article by its element (menus, headers, footers, sidebars, forms, scripts, styles) is
left out on all hosts. Names in class, id and role are weak evidence: an element is left out if one of
its names consists of words for such parts only, and neither holds more than half of the text nor,
as readers' comments may, all of it. Where a page marks its article, only that is kept.

Text: references decoded, white space inside a block one space, trimmed, blocks in page order
joined by one line feed. Null html counts as empty; a null url is a host without template.
Repeated rows are pages of their own. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from series_lake.llm.staging import BROADCAST_KEYS, semi_by_key, staging

#: Pages of a host with different other text that make a subtree template.
LEAST = 5

# Element names of the HTML standard by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head script style noscript template nav footer aside form iframe object embed svg math canvas audio video button select option textarea input label dialog menu title xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th figcaption caption summary".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
# An opening tag that ends an open one of these, unless one of the others is in between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"})}
# In a marked article only these may be template: lists, tables and quotes are its content.
PARTS = frozenset("div section aside nav header footer form details dialog fieldset center hgroup".split())
# Words in class, id and role for what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager share sharing social related recommended recommendations comments comment commentlist disqus reply replies respond "
    "footer masthead toolbar login signup search skip widget widgets complementary contentinfo".split()
)
PAGE_MARKS = frozenset(("header",))
READERS = frozenset("comments comment commentlist disqus reply replies respond".split())
# Words that say nothing about an element beside a mark.
PLAIN = frozenset("area bar bottom box block col column container inner item items left links list outer panel posts primary right secondary section site slot text thread top unit wrap wrapper".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<""",
    re.S,
)
NAME = re.compile(r"[^\s]+")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[a-z0-9]+")


class _Node:
    __slots__ = ("article", "children", "comments", "dropped", "gone", "hash", "holds_article", "kept", "marked", "named", "parent", "path", "size", "sum", "tag")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[_Node | str] = []
        self.holds_article = self.marked = self.named = self.comments = self.dropped = self.gone = False
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.path = zlib.crc32(tag.encode("utf-8", "replace"), parent.path) if parent is not None else 0
        self.hash = self.kept = self.size = self.sum = 0


def _by_element(tag: str, in_article: bool) -> bool:
    return tag in DROPPED or (tag == "header" and not in_article)


def _named_so(tag: str, attributes: str, in_article: bool) -> frozenset[str]:
    """The marks in a name of the element that consists of marks and plain words only."""
    found: frozenset[str] = frozenset()
    if tag in ("html", "body") or (tag in ("article", "main") and not in_article) or "=" not in attributes:
        return found
    marks = MARKS if in_article else MARKS | PAGE_MARKS
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in NAME.findall(value.strip("\"'").lower()):
                words = frozenset(WORDS.findall(token))
                if words & marks and words <= marks | PLAIN:
                    found |= words & marks
    return found


def parse(page: str) -> _Node:
    """The element tree; misnested and unclosed tags are tolerated."""
    root = _Node("", None)
    outermost: list[_Node] = []
    at, position, end = root, 0, len(page)
    while position < end:
        m = TOKEN.match(page, position)
        position = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            piece = m.group()
            if piece.startswith("<![CDATA["):
                at.children.append(piece[9:].removesuffix("]]>"))
            elif not piece.startswith(("<!", "<?")):
                at.children.append(html.unescape(piece))
            continue
        tag, closing, attributes = name.lower(), m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if closing:
            node = at
            while node.parent is not None and node.tag != tag:
                node = node.parent
            if node.parent is not None:
                at = node.parent
            continue
        if tag in CLOSES_P:
            at = _ended(at, {"p"}, {"article", "section", "div", "td", "th", "li", "body", "button", "table"})
        if tag in ENDS:
            at = _ended(at, *ENDS[tag])
        node = _Node(tag, at)
        names = _named_so(tag, attributes, at.article)
        node.named, node.comments = bool(names), bool(names & READERS)
        node.dropped = _by_element(tag, at.article)
        node.marked = node.named or node.dropped
        at.children.append(node)
        if tag in ("article", "main") and not at.article:
            outermost.append(node)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, position)
            position = end if stop is None else page.find(">", stop.start()) + 1 or end
            continue
        at = node
    _mark_holders(outermost)
    return root


def _above(node: _Node) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _mark_holders(articles: list[_Node]) -> None:
    """Marks the elements around the page's articles. Articles inside a marked element (a list of
    teasers, say) only count if there is no other, and then only if no element name marks it."""
    clear = [a for a in articles if not any(n.marked for n in _above(a))]
    for article in clear or [a for a in articles if not any(n.dropped for n in _above(a))]:
        for node in _above(article):
            node.holds_article = True


def _ended(at: _Node, tags: set[str], barriers: set[str]) -> _Node:
    node = at
    while node.parent is not None and node.tag not in barriers:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return at


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _measure(root: _Node) -> bool:
    """Hashes every subtree, sizes the texts and decides what names leave out. Whether the page marks
    its article."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, _Node)]
    for node in reversed(order):
        parts = []
        for c in node.children:
            if isinstance(c, str):
                parts.append(c)
                node.size += len("".join(c.split()))
            else:
                parts.append(f"<{c.hash}>")
                node.size += 0 if c.dropped else c.size
        node.hash = _digest(f"{node.path}|{node.tag}|{' '.join(''.join(parts).split())}")
    marked = root.holds_article
    total = sum(n.size for n in order if n.article and not n.parent.article and n.holds_article) if marked else root.size
    for node in order:  # outer elements come first
        above = node.parent is not None and node.parent.gone
        by_name = node.named and not node.holds_article and (2 * node.size <= total or (node.comments and node.size < total))
        node.gone = above or (node.dropped and not node.holds_article) or by_name
    return marked


def described(page: str) -> tuple[list[tuple[str | None, list[int]]], list[tuple[int, int]]]:
    """(text, numbers of subtrees) of the page's blocks in order, the text None where it is not of the
    article; and (hash, rest) of the subtrees that may be template, ``rest`` naming the page's
    other text."""
    root = parse(page)
    marked = _measure(root)
    blocks: list[tuple[str | None, list[_Node]]] = []
    buffer: list[str] = []
    path: list[_Node] = []
    total = kept = 0

    def in_text() -> bool:
        return not path[-1].gone and (not marked or path[-1].article)

    def flush() -> None:
        nonlocal total, kept
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            name, size = _digest(text), len(text) if in_text() else 0
            total += name
            kept += size
            for n in path:
                n.sum += name
                n.kept += size
            blocks.append((text if in_text() else None, list(path)))

    walk: list[tuple[str, _Node | str]] = [("open", root)]
    while walk:
        step, item = walk.pop()
        if step == "text":
            buffer.append(item)
        elif step == "close":
            if item.tag in BLOCKS or item is root:
                flush()
            path.pop()
        elif item.gone and item.tag not in BLOCKS and not path[-1].gone:
            continue  # a word or button inside a line
        else:
            if item.tag in BLOCKS and path:
                flush()
            elif item.tag == "br":
                buffer.append(" ")
            path.append(item)
            walk.append(("close", item))
            walk += [("text", c) if isinstance(c, str) else ("open", c) for c in reversed(item.children)]

    number: dict[int, int] = {}
    subtrees: list[tuple[int, int]] = []
    out = []
    for text, above in blocks:
        own = []
        for n in above:
            if n.tag not in BLOCKS or n.tag in ("html", "body", "article", "main") or n.tag in TEXT_BLOCKS or n.holds_article:
                continue
            if (n.article and n.tag not in PARTS) or 2 * n.kept > kept:
                continue
            if id(n) not in number:
                number[id(n)] = len(subtrees)
                rest = (total - n.sum) & (2**64 - 1)
                subtrees.append((n.hash, rest - 2**64 if rest >= 2**63 else rest))
            own.append(number[id(n)])
        out.append((text, own))
    return out, subtrees


def blocks_of(page: str) -> list[tuple[str, list[int], list[int]]]:
    """(text, hashes of the subtrees that may be template, their rests) of the blocks that may be
    article, in page order."""
    blocks, subtrees = described(page)
    return [(text, [subtrees[k][0] for k in own], [subtrees[k][1] for k in own]) for text, own in blocks if text is not None]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = pa.list_(pa.struct([("text", pa.string()), ("of", pa.list_(pa.int32()))]))
    subtree = pa.list_(pa.struct([("hash", pa.int64()), ("rest", pa.int64())]))
    for batch in batches:
        blocks, subtrees = [], []
        for page in batch.column("html"):
            own, trees = described(page.as_py() or "")
            blocks.append([{"text": t if t is None else t.encode("utf-8", "replace").decode(), "of": of} for t, of in own])
            subtrees.append([{"hash": h, "rest": r} for h, r in trees])
        others = [i for i, c in enumerate(batch.schema.names) if c != "html"]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in others], pa.array(blocks, block), pa.array(subtrees, subtree)], names=[*[batch.schema.names[i] for i in others], "blocks", "subtrees"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, text, n_chars and n_template (blocks of the page under a template subtree, those that
    names leave out included), a row per page."""
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    with staging(spark, "html") as area:
        read = pages.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
            F.xxhash64(host).alias("host"), F.col(url_col).isNotNull().alias("hosted"), F.col(html_col).cast("string").alias("html"),
        )
        kinds = [F.lit(None).cast(k) for k in ("array<struct<text:string,of:array<int>>>", "array<struct<hash:bigint,rest:bigint>>")]
        added = read.select(kinds[0].alias("blocks"), kinds[1].alias("subtrees")).schema
        parsed = area.write(read.mapInArrow(_parsed, StructType([*read.drop("html").schema.fields, *added.fields])), keep=True)
        found = parsed.where("hosted").select("row", "host", F.explode("subtrees").alias("s")).select("row", "host", "s.hash", "s.rest")
        places = found.select("host", "hash", "rest").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
        template = area.write(places.where(F.col("n") >= least).select("host", "hash"))
        hits = area.write(semi_by_key(found, template, ["host", "hash"]).groupBy("row").agg(F.collect_set("hash").alias("hits")), keep=True)
        area.drop(template)
        # The texts stay where they are as long as the hits are few enough to be sent to them.
        few = (hits.agg(F.sum(F.size("hits"))).first()[0] or 0) <= BROADCAST_KEYS
        none = F.array().cast("array<bigint>")
        joined = parsed.join(F.broadcast(hits) if few else hits, "row", "left").withColumn("hits", F.coalesce("hits", none))
        gone = F.filter(F.transform("subtrees", lambda s, i: F.when(F.array_contains("hits", s["hash"]), i)), lambda i: i.isNotNull())
        joined = joined.withColumn("gone", F.when(F.size("hits") > 0, gone).otherwise(F.array().cast("array<int>")))
        free = F.filter("blocks", lambda b: ~F.arrays_overlap(b["of"], F.col("gone")))
        joined = joined.withColumn("free", F.when(F.size("gone") == 0, F.col("blocks")).otherwise(free))
        text = F.array_join(F.col("free.text"), "\n")
        return joined.select("page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars"), (F.size("blocks") - F.size("free")).alias("n_template"))
