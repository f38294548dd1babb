"""HTML extraction: the main text of pages, without site templates.

A page is parsed to elements where Spark has read it. Site templates are found by counting: each subtree's
hash goes to Spark with its host, which counts the different page contents that the subtree stands beside.
Subtrees that stand beside many are templates of that host and are deleted, wherever in a page they are.

What counting can't see (menus and adverts that differ from page to page, and all of a host of few pages) is
left to rules, which look at the page without its templates: elements that are navigation, headers, footers,
sidebars, notices, adverts, forms, scripts or reader comments by their tag, role or class are left out, but
no element that holds a page's article or main element or, without those, the bulk of its text; an article
(or else a main element) bounds the text where there is one.

A page's content is named by its longest block that isn't frequent on its host, by counts of the different
page texts that hold each block: copies of one article count once and are no template, and boilerplate that
is longer than the pages' own blocks names no content.
Only containers and wrappers can be templates, never inline elements, paragraphs, headings, items or cells.

Counts come from partial aggregation on (host, subtree, content); a host that holds a third of all pages
is many keys. The templates of a host come back as one array, broadcast while the table is small.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.bpe import spans
from noticeworks.llm.shared import ascii_lower, bundled, others, unbundled, unused, written

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
LEFT_OUT = frozenset("head script style noscript template iframe nav footer aside form button select option textarea title svg object canvas dialog menu input label fieldset".split())
CONTAINERS = frozenset("div section ul ol dl table aside nav figure details header footer".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Those of them that may be a wrapper of the whole page.
WRAPPERS = frozenset("nav footer aside form header menu fieldset dialog object canvas label".split())
#: Words of a class, id or role that mark what isn't main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar side aside widget footer header masthead cookie cookies consent notice alert popup modal newsletter subscribe signup login share sharing "
    "social comment comments commentlist respond discussion disqus reply replies related recommended complementary contentinfo search pagination pager".split()
)
#: Words that leave a compound name such as `site-header` a mark; others (`has-sidebar`, `article-header`) end it.
FRAMES = frozenset(
    "site page top bottom left right primary secondary global inner outer wrapper wrap container box bar block section area slot unit list item items link links button buttons icon icons form "
    "panel region row col column group main sub mini mobile desktop sticky fixed body author meta less".split()
)
#: An open element on the left ends where one of those on the right starts.
ENDS = {
    "p": frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset(["body"]),
}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
#: Attributes with whole quotes, up to the end of the tag.
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
#: A page with more tags than this whose quotes never end has the rest of its tags end at the first `>`.
OPEN_QUOTES = 8
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@lru_cache(100_000)
def is_mark(token: str) -> bool:
    """Whether a name of a class, id or role marks what isn't main text: each word of it is a mark or a frame, at least one a mark."""
    found = _WORD.findall(token)
    return not MARKS.isdisjoint(found) and all(w in MARKS or w in FRAMES for w in found)


class Page:
    """The elements of a page. Element i has a parent, a subtree hash and flags; runs hold the text in page
    order. Every step of the parser costs a constant number of steps or ends an element for good, so pages of
    deeply nested or never closed elements take time in proportion to their length."""

    def __init__(self, source: str):
        self.tags, self.parents, self.hashes = ["#root"], [-1], [0]
        self._marks = [""]  # why an element is left out by itself: its "tag", its "class", or not at all
        self._inside = [False]  # in an article or main element
        self.runs: list[tuple[int, str | None]] = []  # (element, text), or (element, None) where a block starts or ends
        self._digests = [xxhash.xxh3_64()]
        self._open = [0]
        self._count: dict[str, int] = {}  # open elements by tag
        self._closable: list[int] = []  # places in _open of elements in ENDS, and of containers
        self._containers: list[int] = []
        self._parse(source)
        while self._open:
            self._close()

    def left_out(self, gone: set[int] | frozenset[int] = frozenset()) -> list[bool]:
        """Which elements the rules leave out of a page without the elements `gone`. An element that may be a
        wrapper stays if it holds a main element, at least half of the text of the page's articles or, where
        a page has neither, three quarters of its text."""
        n = len(self.tags)
        hidden = [False] * n
        for i in range(1, n):
            hidden[i] = hidden[self.parents[i]] or i in gone or (self._marks[i] == "tag" and self.tags[i] not in WRAPPERS)
        all_, plain, articles, mains = [0] * n, [0] * n, [0] * n, [False] * n
        for element, text in self.runs:
            if text is not None and not hidden[element]:
                size = len(text.strip())
                all_[element] += size
                plain[element] += size
        # children have higher numbers than their parents
        for i in range(n - 1, 0, -1):
            up, tag, mark = self.parents[i], self.tags[i], self._marks[i]
            if hidden[i]:
                continue
            all_[up] += all_[i]
            # navigation and the like by its tag is no part of the text; forms may be
            plain[up] += 0 if mark == "tag" and tag not in ("form", "fieldset") else plain[i]
            articles[up] += all_[i] if tag == "article" and not mark else articles[i]
            mains[up] |= mains[i] or tag == "main"
        found = [False] * n
        for i in range(1, n):
            mark = self._marks[i]
            out = bool(mark) or i in gone
            if mark and not hidden[i]:
                if mains[0] or articles[0]:
                    out = not (mains[i] or (articles[i] and 2 * articles[i] >= articles[0]))
                elif mark == "class" or self.tags[i] in ("form", "fieldset"):
                    out = not (plain[i] and 4 * plain[i] >= 3 * plain[0])
            found[i] = found[self.parents[i]] or out
        return found

    def _parse(self, source: str) -> None:
        at, last, open_quotes = 0, source.rfind(">"), 0
        while at < len(source):
            m = _TAG.search(source, at)
            if m is None or (m[2] and m.start() > last):
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                if m[0].startswith("<![CDATA["):
                    self._text(html.escape(m[0][9:].removesuffix("]]>")))
                continue
            end = _QUOTED.match(source, at) if open_quotes < OPEN_QUOTES else None
            open_quotes += end is None
            stop = end.end() if end else source.index(">", at) + 1
            attributes, at = source[at : stop - 1], stop
            name = name.lower()
            if m[1]:
                self._end(name)
                continue
            self._start(name, attributes)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at, last + 1)
                if close.start() > last:  # never closed: all the rest is in it
                    self._digests[self._open[-1]].update(source[at:].encode())
                    return
                self._digests[self._open[-1]].update(source[at : close.start()].encode())
                at = close.end()
                self._close()
            elif name in VOID:
                self._close()
        if at < len(source):
            self._text(source[at:])

    def _start(self, name: str, attributes: str) -> None:
        # inline elements inside a paragraph end with it
        while self._closable:
            over = self._closable[-1]
            if name not in ENDS[self.tags[self._open[over]]] or (self._containers and self._containers[-1] > over):
                break
            while len(self._open) > over:
                self._close()
        parent = self._open[-1]
        inside = self._inside[parent]
        mark = "tag" if name in LEFT_OUT or (name == "header" and not inside) else ""
        if not mark and attributes and name not in ("html", "body", "main"):
            names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)).lower()
            if names and not (name == "article" and "comment" not in names) and any(map(is_mark, names.split())):
                mark = "class"
        element, place = len(self.tags), len(self._open)
        self.tags.append(name)
        self.parents.append(parent)
        self.hashes.append(0)
        self._marks.append(mark)
        self._inside.append(inside or name in ("article", "main"))
        self._digests.append(xxhash.xxh3_64(name.encode()))
        self._open.append(element)
        self._count[name] = self._count.get(name, 0) + 1
        if name in ENDS:
            self._closable.append(place)
        if name in CONTAINERS:
            self._containers.append(place)
        if name in BLOCKS:
            self.runs.append((element, None))

    def _text(self, text: str) -> None:
        element = self._open[-1]
        self.runs.append((element, text))
        self._digests[element].update(" ".join(text.split()).encode())

    def _end(self, name: str) -> None:
        if self._count.get(name):
            while self.tags[self._open[-1]] != name:
                self._close()
            self._close()

    def _close(self) -> None:
        element = self._open.pop()
        place = len(self._open)
        if place:
            self._count[self.tags[element]] -= 1
        for stack in (self._closable, self._containers):
            if stack and stack[-1] == place:
                stack.pop()
        value = self._digests[element].intdigest()
        self._digests[element] = None
        self.hashes[element] = value - (1 << 64) if value >> 63 else value
        if self._open:
            self._digests[self._open[-1]].update(b"\x00" + value.to_bytes(8, "little"))
            if self.tags[element] in BLOCKS:
                self.runs.append((self._open[-1], None))

    def candidates(self) -> list[int]:
        """Elements that may be templates: the containers and wrappers, in an article or not, whatever the rules say of them."""
        return [i for i, tag in enumerate(self.tags) if tag in CONTAINERS or tag in WRAPPERS]

    def kept(self, templates: frozenset[int] | set[int] = frozenset()) -> list[bool]:
        """Which elements' own text is main text: templates go first, and the rules and bounds see what is left."""
        gone = {i for i in self.candidates() if self.hashes[i] in templates} if templates else frozenset()
        out = self.left_out(gone)
        # the articles, or else main elements, that aren't left out bound the text
        bounds: set[int] = set()
        for name in ("article", "main"):
            bounds = bounds or {i for i, t in enumerate(self.tags) if t == name and not out[i]}
        within = [not bounds]
        for i in range(1, len(self.tags)):
            within.append(within[self.parents[i]] or i in bounds)
        return [a and not b for a, b in zip(within, out, strict=True)]

    def blocks(self, templates: frozenset[int] | set[int] | None = frozenset()) -> list[str]:
        """The blocks of main text: character references decoded, white space runs one space. templates None: all blocks, by no rule."""
        kept, out, part = [True] * len(self.tags) if templates is None else self.kept(templates), [], []
        for element, text in [*self.runs, (0, None)]:
            if text is None:
                if part:
                    block = " ".join(html.unescape("".join(part)).split())
                    if block:
                        out.append(block)
                    part = []
            elif kept[element]:
                part.append(text)
        return out


def signatures(pages: DataFrame, html_col: str, host: Column) -> DataFrame:
    """For each page its host, the hashes of its text, of its blocks (longest first) and of the subtrees that may be templates."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda text: xxhash.xxh3_64_intdigest(text.encode()) >> 1
        longs = pa.list_(pa.int64())
        for part, sources in (x for b in it for x in spans(b, "html")):
            texts, blocks, found = [], [], []
            for source in sources:
                page = Page(source or "")
                own = page.blocks(None)  # no word list has a say in what is counted
                texts.append(digest("\n".join(own)))
                blocks.append([digest(x) for x in dict.fromkeys(sorted(own, key=len, reverse=True))])
                found.append(sorted({page.hashes[i] for i in page.candidates()}))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.int64()), pa.array(blocks, longs), pa.array(found, longs)], names=["host", "page", "blocks", "subtrees"])

    return pages.select(host.alias("host"), F.col(html_col).alias("html")).mapInArrow(run, "host string, page long, blocks array<long>, subtrees array<long>")


def _frequent(rows: DataFrame, item: str, beside: str, least: int, share: float) -> DataFrame:
    """(host, item) of the items that stand beside at least `least` and at least `share` of the host's different values
    of `beside`. rows: host, `beside` and an array `items`; the values of a host are counted by rows with a null item."""
    pairs = rows.select("host", beside, F.explode(F.concat(F.array(F.lit(None).cast("long")), "items")).alias(item)).distinct()
    counts = written(pairs.groupBy("host", item).agg(F.count("*").alias("n")).where((F.col("n") >= least) | F.col(item).isNull()), f"{item}s")
    all_ = counts.where(F.col(item).isNull()).select(F.col("host").alias("_host"), F.col("n").alias("_all"))
    often = counts.where(F.col(item).isNotNull()).join(all_, F.col("host") == F.col("_host")).where(F.col("n") >= share * F.col("_all"))
    return written(often.select("host", item), f"frequent-{item}s")


def _with_host_array(rows: DataFrame, key: str, items: DataFrame, item: str, name: str) -> DataFrame:
    """rows with the items of their host as an array column; null where it has none."""
    of = unused(rows, "of")
    of_host = items.groupBy(F.col("host").alias(of)).agg(F.collect_list(item).alias(name))
    if items.count() <= BROADCAST_TEMPLATES:
        of_host = F.broadcast(of_host)
    return rows.join(of_host, F.col(key) == F.col(of), "left").drop(of)


#: Rows of templates (about 24 bytes each) that are broadcast; more are joined by shuffle.
BROADCAST_TEMPLATES = 500_000


def site_templates(pages: DataFrame, html_col: str, host: Column, min_contents: int, min_share: float) -> DataFrame:
    """(host, subtree): the hashes of each host's templates, counted over all pages."""
    seen = written(signatures(pages, html_col, host), "signatures")
    shared = _frequent(seen.select("host", "page", F.col("blocks").alias("items")), "block", "page", min_contents, min_share)
    own = _with_host_array(seen, "host", shared, "block", "_shared")
    # the longest block that isn't frequent; pages of frequent blocks only have one content together
    content = F.coalesce(F.get(F.array_except("blocks", F.coalesce("_shared", F.array().cast("array<long>"))), F.lit(0)), F.lit(-1))
    return _frequent(own.select("host", content.alias("content"), F.col("subtrees").alias("items")), "subtree", "content", min_contents, min_share)


def extract_text(pages: DataFrame, html_col: str = "html", url_col: str = "url", min_contents: int = 10, text_col: str = "text", min_share: float = 0.1, by_templates: bool = True) -> DataFrame:
    """pages without html_col, with the main text (blocks joined by one space; empty if none) in text_col.

    A subtree is a template of its host if it stands beside at least `min_contents` different contents and
    beside at least `min_share` of the host's different contents. by_templates=False leaves the rules alone.
    Null html is an empty page; a null url is a host of its own; repeated rows are extracted alike. Nothing
    is cut from long pages. Other columns stay, whatever their names. An empty table gives no rows.
    """
    host = ascii_lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[^:/?#]*://([^/?#]*)", 1))
    keep, source, key, known = others(pages, html_col, text_col), "html", "host", "templates"
    ready = pages.select(bundled(pages, keep), F.col(html_col).alias(source), host.alias(key))
    if by_templates:
        templates = site_templates(pages, html_col, host, min_contents, min_share)
        ready = _with_host_array(ready, key, templates, "subtree", known)
    else:
        ready = ready.withColumn(known, F.lit(None).cast("array<long>"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sources in (x for b in it for x in spans(b, source)):
            texts = [" ".join(Page(page or "").blocks(set(found or ()))) for page, found in zip(sources, part.column(known).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    out = ready.select("row", source, known).mapInArrow(run, ready.select("row", F.lit("").alias("text")).schema)
    return out.select(*unbundled(keep), F.col("text").alias(text_col))


def op7_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
