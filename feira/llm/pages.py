"""Main text of web pages: site templates found by counting element subtrees per host.

A first pass hashes every block element with all below it. Subtrees on MANY different pages of
their host recur. What recurs may be a menu, but also an article that is on the host several
times: printed, with tracking parameters, syndicated. The two differ in what is left of the
pages without it. So a page votes for the recurring subtrees it holds if at least OWN of its
text lies in none of them, and a subtree is template if pages with MANY different texts of
their own vote for it: copies of one article have no text of their own to vote with. Of a page
that marks its article, the article is its own text.

A second pass reads each page again, deletes the templates and everything that its markup
declares to be no article (menus, forms, adverts and the like), and writes the remaining
blocks as lines. Where a page marks its article, only that is kept. Counts never delete
an element that lies in an article or a main part, or that holds one.

Recurring subtrees on a large share of their host's pages are few, and go to all its pages at
once; the others go only to the pages that hold them, by a join on host and subtree.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.near_duplicates import possibly
from feira.llm.text import map_arrow, small_batches
from feira.plans.tables import staged

MANY = 5  # different pages of a host that make a subtree recur, and that must vote for a template
OWN = 0.2  # of a page's text that must lie in no recurring subtree for the page to vote
HELD = 50_000  # host's subtrees whose voters a task remembers at a time
COMMON = 0.1  # of a host's pages: subtrees on so many go to all its pages; changes no result

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+>|[^<>]*+>?)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|>|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu"
    " nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
# Elements that a start tag closes if they are open, up to the nearest boundary.
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "body": frozenset(["head"]),
}
BOUNDARY = frozenset("ul ol dl table article main section div aside nav footer header form body html select menu".split())
DROPPED = frozenset(
    "head nav aside footer form button select dialog menu template svg canvas object audio video"
    " script style textarea title noscript iframe xmp noembed noframes datalist option".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
# Whole tokens of class and id attributes. Names that content bears as well (banner, menu, notice,
# related, social, widget ...) are not among them: the counts of the host decide there.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments"
    " commentlist comment-list comments-area comment-form consent cookie cookies cookie-banner cookie-bar"
    " cookie-consent cookie-notice disqus disqus_thread footer page-footer site-footer gdpr header"
    " site-header masthead modal nav navbar nav-bar main-nav site-nav navigation newsletter popup promo"
    " promoted replies share sharing sidebar signup sponsor sponsored subscribe".split())
COMMENTS = frozenset("comment comments comment-body reply replies disqus respond".split())
KEPT = frozenset(["html", "body", "main", "article"])


def digest(parts: Iterable[str]) -> int:
    """A hash of 64 bits of strings in order."""
    data = "\0".join(parts).encode("utf-8", "replace")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


class Element:
    __slots__ = (
        "tag", "names", "parts", "block", "dropped", "doubted", "in_article", "in_main", "from_block", "holds_main")

    def __init__(self, tag, names, block, parent, dropped, doubted, from_block):
        # Doubted by its name alone: dropped when it ends, unless it holds an article or a main part.
        self.doubted = doubted
        self.tag, self.names, self.block, self.from_block = tag, names, block, from_block
        # An inline element adds to what its block holds.
        self.parts = [] if block or parent is None else parent.parts
        self.holds_main = False
        if not block:
            self.parts.append(f"<{tag}>")
        self.dropped = dropped or (parent is not None and parent.dropped)
        self.in_article = not dropped and (tag == "article" or (parent is not None and parent.in_article))
        self.in_main = not dropped and (tag == "main" or "main" in names[:1] or (parent is not None and parent.in_main))


class Page:
    """One reading of a page: its blocks and the hashes of its block elements."""

    def __init__(self, source: str, template: frozenset[int] = frozenset()) -> None:
        self.template = template
        self.blocks: list[tuple[str, bool, bool]] = []  # text, in an article, in the main part
        self.subtrees: list[tuple[int, int, int]] = []  # hash, first block, block past the last
        self.articles = self.mains = False
        self._line: list[str] = []
        self._open: list[Element] = []
        self._count: dict[str, int] = {}
        self._read(source)
        while self._open:
            self._pop()
        self._flush(None)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            less = source.find("<", at)
            if less < 0:
                self._text(source[at:])
                return
            if less > at:
                self._text(source[at:less])
            m = TOKEN.match(source, less)
            if m is None:
                self._text("<")
                at = less + 1
                continue
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                self._start(tag, m[3])
                if tag in RAW:
                    end = RAW_END[tag].search(source, at)
                    at = n if end is None else end.start()
            elif m[1]:
                self._end(m[1].lower())

    def _text(self, text: str) -> None:
        top = self._open[-1] if self._open else None
        text = html.unescape(text) if "&" in text else text
        if top is not None:
            top.parts.append(text)
            if top.dropped:
                return
        self._line.append(text)

    def _start(self, tag: str, attributes: str) -> None:
        names: list[str] = []
        roles, hidden = set(), False
        if attributes and ("=" in attributes or "hidden" in attributes):
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                words = (a or b or c).lower().split()
                if name.lower() == "role":
                    roles.update(words)
                else:
                    names += words
            hidden = HIDDEN.search(attributes) is not None
        block = tag in BLOCK
        if block:
            if self._count.get("p") and tag not in ("option", "select", "legend"):
                self._close({"p"})
            if tag in CLOSES:
                self._close(CLOSES[tag])
        parent = self._open[-1] if self._open else None
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                if block:
                    self._flush(parent)
                elif parent is None or not parent.dropped:
                    self._line.append(" ")
                if parent is not None:
                    parent.parts.append(f"<{tag}>")
            return
        found = DROPPED_NAMES.intersection(names)
        main = ["main"] if "main" in roles else []
        doubted = False
        if tag in KEPT:
            dropped = tag == "article" and bool(COMMENTS.intersection(names))
        else:
            inside = parent is not None and (parent.in_article or parent.in_main)
            dropped = tag in DROPPED or hidden or bool(DROPPED_ROLES & roles) or tag == "header" and not inside
            doubted = not dropped and not main and bool(found - {"header"} if inside else found)
        if block or dropped or doubted:
            self._flush(parent)
        element = Element(tag, main + names, block, parent, dropped, doubted, len(self.blocks))
        if not element.dropped and (tag in ("article", "main") or main):
            for around in self._open:
                around.doubted, around.holds_main = False, True
        if not element.dropped:
            self.articles = self.articles or tag == "article"
            self.mains = self.mains or tag == "main" or bool(main)
        self._open.append(element)
        self._count[tag] = self._count.get(tag, 0) + 1

    def _close(self, tags) -> None:
        """Close the nearest open element of tags, if no boundary lies between."""
        for k in range(len(self._open) - 1, -1, -1):
            tag = self._open[k].tag
            if tag in tags:
                while len(self._open) > k:
                    self._pop()
                return
            if tag in BOUNDARY:
                return

    def _end(self, tag: str) -> None:
        if not self._count.get(tag):
            return
        while self._open:
            found = self._open[-1].tag == tag
            self._pop()
            if found:
                return

    def _pop(self) -> None:
        element = self._open.pop()
        self._count[element.tag] -= 1
        parent = self._open[-1] if self._open else None
        if element.block or element.dropped or element.doubted:
            self._flush(element)
        if element.doubted:
            self._delete(element.from_block)
        if not element.block:
            return
        number = digest([element.tag, " ".join(element.names), " ".join("".join(element.parts).split())])
        if parent is not None:
            parent.parts.append(f"<{number}>")
        main = element.in_article or element.in_main or element.holds_main
        if len(self.blocks) > element.from_block and element.tag not in KEPT and not main:
            if number in self.template:
                self._delete(element.from_block)
            else:
                self.subtrees.append((number, element.from_block, len(self.blocks)))

    def _delete(self, block: int) -> None:
        """Delete the blocks from here on, and the subtrees that hold no others."""
        del self.blocks[block:]
        while self.subtrees and self.subtrees[-1][1] >= block:
            self.subtrees.pop()

    def _flush(self, element: Element | None) -> None:
        if self._line:
            line = " ".join("".join(self._line).split())
            if line:
                self.blocks.append((line, element is not None and element.in_article, element is not None and element.in_main))
            self._line = []

    def kept(self) -> list[int]:
        """The places of the blocks that make up the text."""
        marked = 1 if self.articles else 2 if self.mains else None
        return [i for i, b in enumerate(self.blocks) if marked is None or b[marked]]

    def text(self) -> str:
        return "\n".join(self.blocks[i][0] for i in self.kept())

    def lines(self) -> list[tuple[int, int, int]]:
        """(place, code points, hash) of each block of the text."""
        out = []
        for i in self.kept():
            line = self.blocks[i][0]
            out.append((i, len(line), digest([line])))
        return out


def host(url: Column) -> Column:
    pattern = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)"
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), pattern, 1)


READ = (  # body: hash of all blocks
    "host string, page long, size int, body long, found array<struct<subtree: long, first: int, past: int>>,"
    " lines array<struct<at: int, chars: int, hash: long>>"
)


def subtrees(pages: DataFrame) -> DataFrame:
    """READ: the block elements and the lines of text of each page of (host, page, size, html)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [
            pa.list_(pa.struct([("subtree", pa.int64()), ("first", pa.int32()), ("past", pa.int32())])),
            pa.list_(pa.struct([("at", pa.int32()), ("chars", pa.int32()), ("hash", pa.int64())])),
        ]
        for batch in batches:
            for some in small_batches(batch, 3):
                read = [Page(source or "") for source in some.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array([digest(b[0] for b in p.blocks) for p in read], pa.int64()),
                     pa.array([[dict(zip(("subtree", "first", "past"), x)) for x in p.subtrees] for p in read], kinds[0]),
                     pa.array([[dict(zip(("at", "chars", "hash"), x)) for x in p.lines()] for p in read], kinds[1])],
                    ["host", "page", "size", "body", "found", "lines"],
                )

    return map_arrow(pages, run, READ)


def recurring(found: DataFrame, many: int, common: float) -> DataFrame:
    """(host, subtree, common) of the subtrees on many different pages of their host; common
    if they are on a large share of its pages."""
    # The page itself, as subtree 0, counts the host's pages.
    ids = F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), F.col("found")["subtree"]))
    each = found.select("host", "body", F.explode(ids).alias("subtree"))
    counts = each.distinct().groupBy("host", "subtree").agg(F.count("*").alias("pages"))
    counts = staged(counts.where((F.col("pages") >= many) | (F.col("subtree") == 0)), "subtrees")
    sizes = counts.where("subtree = 0").select("host", F.col("pages").alias("all_pages"))
    return staged(counts.where("subtree != 0").join(sizes, "host").select(
        "host", "subtree", (F.col("pages") >= F.lit(common) * F.col("all_pages")).alias("common")
    ), "recurring")


def shared(found: DataFrame, chosen: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(host, template): for each host the common ones of the chosen subtrees, at most 1 / share
    times as many as in a page; and (host, page, size, own): the others, for each page that
    holds any. Written first, so that Spark knows their size."""
    by_host = chosen.where("common").groupBy("host").agg(F.collect_set("subtree").alias("template"))
    held = found.select("host", "page", "size", F.explode(F.array_distinct(F.col("found")["subtree"])).alias("subtree"))
    by_page = held.join(chosen.where("not common").drop("common"), ["host", "subtree"]).groupBy(
        "host", "page", "size"
    ).agg(F.collect_set("subtree").alias("own"))
    return staged(by_host, name), staged(by_page, f"{name}-of-pages")


def with_shared(rows: DataFrame, by_host: DataFrame, by_page: DataFrame, *columns: str) -> DataFrame:
    """The columns of rows (with host, page, size) and the subtrees shared with them. Only rows
    that may hold a rarer one are shuffled."""
    marked = possibly(rows, by_page, "page")
    own = marked.where("_maybe").join(by_page, ["host", "page", "size"], "left")
    rest = marked.where("not _maybe").withColumn("own", F.lit(None).cast("array<long>"))
    both = own.select("host", *columns, "own").unionByName(rest.select("host", *columns, "own"))
    return both.join(by_host, "host", "left").select("host", *columns, "template", "own")


def vote(
    found: list[dict], lines: list[dict], recurs: frozenset[int], least: float,
) -> tuple[int | None, set[int]]:
    """The hash of a page's own text, or None if that is too little to vote with, and the
    recurring subtrees it holds."""
    held, covered = set(), set()
    for x in found:
        if x["subtree"] in recurs:
            held.add(x["subtree"])
            covered.update(range(x["first"], x["past"]))
    own = [x for x in lines if x["at"] not in covered]
    chars = sum(x["chars"] for x in lines)
    if not own or sum(x["chars"] for x in own) < least * chars:
        return None, held
    return digest(str(x["hash"]) for x in own), held


def templates(found: DataFrame, many: int = MANY, least: float = OWN, common: float = COMMON) -> DataFrame:
    """(host, subtree, common) of the recurring subtrees that pages with many different texts
    of their own hold. A task sends at most many votes for a subtree, or HELD at a time."""
    recurs = recurring(found, many, common)
    voters = with_shared(found, *shared(found, recurs, "recurring-of-hosts"), "found", "lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes: dict[tuple, set[int]] = {}

        def sent() -> pa.RecordBatch:
            rows = [(h, subtree, own) for (h, subtree), texts in votes.items() for own in texts]
            votes.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64())], ["host", "subtree", "own"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                both = frozenset(row["template"] or ()).union(row["own"] or ())
                own, held = vote(row["found"], row["lines"], both, least) if both else (None, ())
                for subtree in held if own is not None else ():
                    texts = votes.setdefault((row["host"], subtree), set())
                    if len(texts) < many:
                        texts.add(own)
            if len(votes) > HELD:
                yield sent()
        yield sent()

    votes = map_arrow(voters, run, "host string, subtree long, own long").distinct()
    enough = votes.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= many)
    return staged(recurs.join(enough.drop("n"), ["host", "subtree"]), "templates")


def main_text(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", many: int = MANY,
) -> DataFrame:
    """key, url, text and n_chars (code points) of each page.

    A null page is empty and has an empty text; a page without a host, or with a null url,
    counts to the host ''. Repeated rows and other copies of a page are read each but vote once.
    A very long page is read whole, by itself. Other columns are ignored, whatever their names.
    An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{source}`"), F.lit(""))
    named = pages.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), text.alias("html"),
        host(F.col(f"`{url}`")).alias("host"), F.xxhash64(text).alias("page"), F.octet_length(text).alias("size"),
    )
    found = staged(subtrees(named.select("host", "page", "size", "html")), "page-subtrees")
    joined = with_shared(
        named, *shared(found, templates(found, many), "templates-of-hosts"), "key", "url", "html"
    ).drop("host")
    kind = named.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, 2):
                columns = [some.column(k).to_pylist() for k in (2, 3, 4)]
                texts = [Page(s, frozenset(t or ()).union(o or ())).text() for s, t, o in zip(*columns)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()),
                     pa.array(list(map(len, texts)), pa.int64())], [key, "url", "text", "n_chars"],
                )

    return map_arrow(joined, run, f"`{key}` {kind}, url string, text string, n_chars long")
