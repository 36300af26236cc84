"""Main text of web pages: site templates found by counting element subtrees per host.

Each page is parsed once. Every block-level element becomes a hash of its subtree
(names of elements and their text, without attributes). A subtree found on at least
``MIN_PAGES`` pages of a host, and on ``GROWTH`` times the square root of their number, is
part of its template (5 pages on a host of up to 400, 8 of 1,000, 250 of a million), and
the text inside it is deleted from all the host's pages. Pages of a host with the same
text are copies and count as one. The page as a whole (``html``, ``body``) and elements
around main content are never template. What cannot recur, as on a host
with few pages, is told by names: elements for navigation, forms, scripts and the like,
and elements whose class, id or role says so, are left out while parsing. A class or id
says so if it, or its first or last part, is such a word, unless it tells of a state
(``no-sidebar``, ``has-comments``). Class and id are not heeded on elements around a
page's only main content. If a page marks
its main content (``article``, ``main``), only that is kept, and its paragraphs,
headings, lists and tables are never taken for template, though the same quotation may
stand in many articles of a host.

A host has at most (subtrees per page) times the square root of its pages / ``GROWTH``
template subtrees. Pages of a host are not gathered: counts are combined before the
shuffle. Few template subtrees go to all tasks as sorted arrays; otherwise each page's
subtrees are joined with them one by one, so that no page meets the list of its host.

Defined results: null or empty html has the empty text; a null url, or one without
``://``, belongs to the host with the empty name. Elements left open end with the
element around them or with the page. Repeated rows count as one page and
get equal results. An empty table gives no rows. Pages of any length and depth are
parsed whole, in time linear in both. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabaudit.llm import frames
from tabaudit.llm.text import slices
from tabaudit.llm.url_rules import host_of
from tabaudit.session import materialize

MIN_PAGES = 5
GROWTH = 0.25
# Host and subtree pairs that may be sent to all tasks.
BROADCAST_SUBTREES = 500_000

# Their content is not text of the page.
_RAW = "script|style|noscript|template|textarea|title|iframe|svg|object|select"
_DROPPED_TAGS = set(
    "nav header footer aside menu dialog button input label fieldset audio video canvas head".split()
)
_DROPPED_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
    "menu", "menubar", "toolbar",
}
# Words in class or id that tell what is not main text.
_DROPPED_WORDS = set(
    "ad ads adsbygoogle adslot adv alert alerts advert adverts advertisement advertising banner banners breadcrumb breadcrumbs "
    "comment comments commentlist cookie cookies consent disqus footer header masthead menu modal "
    "nav navbar navigation newsletter sidenav submenu topbar gdpr notice notices notification popup promo promoted pagination "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget widgets".split()
)
# Elements whose class may tell by its first or last word what they are: parts of a page, not of a text.
_PARTS = {"div", "section", "ul", "ol", "dl", "table"}
# Within main content, tables and lists of steps or terms belong to the text.
_PARTS_OF_MAIN = {"div", "section", "ul"}
_MAIN_TAGS = {"article", "main"}
# Marked content stands for the page if it is at least this share of what is kept.
MAIN_SHARE = 0.4
_WHOLE_PAGE = {"html", "body"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
# A block start closes an open paragraph; items, cells and rows close their like.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_CLOSE_SCOPE = {"ul", "ol", "dl", "table", "select"}
# Text flow that stays inside main content even if it recurs.
_FLOW = set(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "figure article main".split()
)

# What follows the name of an element, up to its end; quoted values may hold any character.
_INSIDE = r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+"
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"'/]++|\"[^\"]*\"|'[^']*'|/(?!>))*+/>"
    rf"|<({_RAW})(?=[\s/>])(?:{_INSIDE}>|[^>]*>).*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_INSIDE})>|</?[a-zA-Z!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z0-9]+")
# Names that begin so tell a state or a subject, not what the element is.
_STATES = set("no not non has have with without hide show category tag".split())


def _is_hidden(tag: str, attributes: list[tuple[str, str]]) -> bool:
    """Whether the element is left out for its kind, whatever it encloses."""
    return tag in _DROPPED_TAGS or any(
        name == "hidden"
        or (name == "aria-hidden" and value == "true")
        or (name == "role" and value in _DROPPED_ROLES)
        for name, value in attributes
        if tag not in _WHOLE_PAGE
    )


def _is_named(tag: str, attributes: list[tuple[str, str]], in_main: bool) -> bool:
    """Whether class or id tells that the element is no main text.

    Headings, paragraphs, items and rows may be called anything. Of the rest, only parts of a
    page are told by a word in a longer class; other elements need a class that is such a
    word as a whole, and so do all ids, as sections carry their titles there.
    """
    if tag in _WHOLE_PAGE or tag == "main" or (tag in _BLOCKS and tag not in _PARTS and tag != "article"):
        return False
    slugs = tag in (_PARTS_OF_MAIN if in_main else _PARTS)
    for name, value in attributes:
        if name == "id" and value in _DROPPED_WORDS:
            return True
        if name != "class":
            continue
        for token in value.split():
            if token in _DROPPED_WORDS:
                return True
            # What follows two hyphens is a variant; two underscores lead to a part of a block.
            for piece in token.split("--")[0].split("__") if slugs else ():
                words = _WORDS.findall(piece)
                if not words or words[0] in _STATES:
                    continue
                if words[0] in _DROPPED_WORDS or words[-1] in _DROPPED_WORDS:
                    return True
    return False


def _attributes(inside: str) -> list[tuple[str, str]]:
    """Names and values, lower case; the first of equal names counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(inside):
        found.setdefault(name.lower(), value.strip("\"'").lower().strip())
    return list(found.items())


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


@dataclass
class Parsed:
    """A page's block elements, each after its parent, and its blocks of text.

    ``hashes`` has null for elements that enclose main content, which are no template;
    ``parents`` and ``within`` (the innermost element of each block) have -1 for none.
    """

    hashes: list[int | None]
    parents: list[int]
    texts: list[str]
    within: list[int]

    def gone(self, template: set[int]) -> list[bool]:
        """Whether each block lies in an element whose hash is in ``template``."""
        deleted: list[bool] = []
        for own, parent in zip(self.hashes, self.parents):
            deleted.append(own in template or (parent >= 0 and deleted[parent]))
        return [e >= 0 and deleted[e] for e in self.within]


def parse(page: str) -> Parsed:
    """The page's elements and blocks; what is left out, and what is outside main content, is missing."""
    parsed, around, forms, _ = _parse(page, frozenset())
    if forms:
        parsed, around, _, _ = _parse(page, forms)
    if around:
        again, _, _, holds = _parse(page, forms | around)
        # A teaser in a block of related links does not stand for the page.
        return again if holds else parsed
    return parsed


class _Open:
    """An element that is not closed yet."""

    __slots__ = ("tag", "element", "dropped", "main", "cause", "kind")

    def __init__(self, tag: str, element: int, dropped: bool, main: bool, cause: int, kind: bool):
        self.tag, self.element, self.dropped, self.main = tag, element, dropped, main
        # Start of the outermost element left out for its name or as a form, else -1; whether any is for its kind.
        self.cause, self.kind = cause, kind


def _parse(page: str, spared: frozenset[int]) -> tuple[Parsed, frozenset[int], frozenset[int], bool]:
    """The page parsed with the elements starting at ``spared`` kept whatever their names.

    Also returns the starts of elements left out for their names that enclose main
    content, if there is main content nowhere else; those of forms around most of the text,
    as pages are that some generators make; and whether marked content stands for the page.

    Every name and text is added to its innermost block element alone; an element's hash
    goes to its parent, so the work does not grow with depth.
    """
    parts: list[list[str]] = []  # by element: names, texts, and hashes of closed children
    out = Parsed([], [], [], [])
    in_main: list[bool] = []  # by block
    main_elements: set[int] = set()  # elements that are no template, whatever recurs
    stack: list[_Open] = []
    n_open: Counter[str] = Counter()
    around: set[int] = set()
    in_form: Counter[int] = Counter()  # characters left out, by the form's start
    buffer: list[str] = []

    def flush():
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                out.texts.append(text)
                out.within.append(stack[-1].element if stack else -1)
                in_main.append(bool(stack and stack[-1].main))

    def note(piece: str):
        if stack and stack[-1].element >= 0:
            parts[stack[-1].element].append(piece)

    def close(depth: int):
        while len(stack) > depth:
            last = stack[-1]
            if last.tag in _BLOCKS:
                flush()
            stack.pop()
            n_open[last.tag] -= 1
            inner = stack[-1].element if stack else -1
            if last.element != inner:  # its own element ends
                own = _digest(" ".join(" ".join(parts[last.element]).split()))
                parts[last.element] = []
                out.hashes[last.element] = own
                if inner >= 0:
                    parts[inner].append(f"<{own}>")
            else:
                note("/")

    def add(text: str):
        if text:
            text = html.unescape(text) if "&" in text else text
            note(text)
            if not (stack and stack[-1].dropped):
                buffer.append(text)
            elif stack[-1].cause in forms and not stack[-1].kind:
                in_form[stack[-1].cause] += len(text.strip())

    def close_like(tags, stop):
        """Close the innermost open element of ``tags``, unless one of ``stop`` is further in."""
        if any(n_open[t] for t in tags):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in tags:
                    close(depth)
                    return
                if stack[depth].tag in stop:
                    return

    forms: set[int] = set()
    at = 0
    for token in _TOKEN.finditer(page):
        add(page[at : token.start()])
        at = token.end()
        slash, tag, attributes = token.group(2), token.group(3), token.group(4)
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if n_open[tag]:
                close_like({tag}, ())
            elif tag in _BLOCKS:
                flush()
            continue
        if tag in _BLOCKS:
            close_like({"p"}, _BLOCKS)
            close_like(_CLOSES.get(tag, ()), _CLOSE_SCOPE)
            flush()
        if tag in _VOID or attributes.endswith("/"):
            if tag == "br":
                buffer.append(" ")
            continue
        above = stack[-1] if stack else _Open("", -1, False, False, -1, False)
        kind, named = above.kind, False
        if attributes.strip() or tag in _DROPPED_TAGS or tag == "form":
            pairs = _attributes(attributes)
            if _is_hidden(tag, pairs):
                kind = True
            elif token.start() not in spared:
                named = tag == "form" or _is_named(tag, pairs, above.main)
        cause = token.start() if named and above.cause < 0 else above.cause
        if tag == "form" and cause == token.start():
            forms.add(cause)
        dropped = kind or cause >= 0
        if dropped and tag in _MAIN_TAGS and not kind and not named:
            around.add(cause)
        main = above.main or (tag in _MAIN_TAGS and not dropped)
        if main and not above.main:
            element = above.element
            while element >= 0 and element not in main_elements:
                main_elements.add(element)
                element = out.parents[element]
        element = above.element
        if tag in _BLOCKS and tag not in _WHOLE_PAGE and not (main and tag in _FLOW):
            element = len(parts)
            parts.append([])
            out.hashes.append(None)
            out.parents.append(above.element)
        stack.append(_Open(tag, element, dropped, main, cause, kind))
        n_open[tag] += 1
        note(tag)
    add(page[at:])
    flush()
    close(0)
    for element in main_elements:
        out.hashes[element] = None
    kept, marked = sum(map(len, out.texts)), sum(len(t) for t, m in zip(out.texts, in_main) if m)
    holds = marked > 0 and marked >= MAIN_SHARE * kept
    if holds:
        out.within = [e for e, m in zip(out.within, in_main) if m]
        out.texts = [t for t, m in zip(out.texts, in_main) if m]
    large = frozenset(form for form, size in in_form.items() if size > kept)
    return out, frozenset() if marked else frozenset(around), large, holds


_PARSED = (
    "page_id long, url string, host string, content long, subtrees array<long>, hashes array<long>, "
    "parents array<int>, texts array<string>, within array<int>"
)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            pages = [parse(page or "") for page in part.column("html").to_pylist()]
            columns = {c: part.column(c) for c in ("page_id", "url", "host")}
            columns["content"] = pa.array([_digest("\n".join(p.texts)) for p in pages], pa.int64())
            columns["subtrees"] = pa.array(
                [sorted({h for h in p.hashes if h is not None}) for p in pages], pa.list_(pa.int64())
            )
            columns["hashes"] = pa.array([p.hashes for p in pages], pa.list_(pa.int64()))
            columns["parents"] = pa.array([p.parents for p in pages], pa.list_(pa.int32()))
            columns["texts"] = pa.array([p.texts for p in pages], pa.list_(pa.string()))
            columns["within"] = pa.array([p.within for p in pages], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)


def template_subtrees(
    parsed: DataFrame, min_pages: int = MIN_PAGES, growth: float = GROWTH
) -> DataFrame:
    """``host`` and ``subtree`` of the subtrees that recur across a host's distinct pages."""
    # Copies may differ in what is left out of the text; one of them stands for all.
    distinct = materialize(
        parsed.groupBy("host", "content").agg(F.min("subtrees").alias("subtrees")), "distinct-pages"
    )
    pages = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counted = (
        distinct.select("host", F.explode("subtrees").alias("subtree"))
        .groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    recurring = counted.join(frames.broadcast_if_few(pages), "host")
    return recurring.filter(F.col("n") >= F.lit(growth) * F.sqrt("pages")).select("host", "subtree")


_TEXT = "page_id long, url string, text string, n_blocks_deleted long"


def _without(template_of: Callable[[dict], set[int]]):
    """Deletes the blocks that lie in a subtree of the template of their page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page in batch.to_pylist():
                parsed = Parsed(*(page[c] for c in ("hashes", "parents", "texts", "within")))
                gone = parsed.gone(template_of(page))
                kept = [t for t, deleted in zip(parsed.texts, gone) if not deleted]
                rows.append((page["page_id"], page["url"], "\n\n".join(kept), sum(gone)))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["page_id", "url", "text", "n_blocks_deleted"],
            )

    return run


_PAGE = ["page_id", "url", "host", "hashes", "parents", "texts", "within"]


def _joined(parsed: DataFrame, subtrees: DataFrame) -> DataFrame:
    """Pages with ``template``, by shuffle: pages with equal subtrees ask once for each of these."""
    pages = parsed.withColumn("asked", F.xxhash64("subtrees"))
    asked = pages.select("host", "asked", F.explode("subtrees").alias("subtree")).distinct()
    found = asked.join(subtrees, ["host", "subtree"]).groupBy("host", "asked")
    joined = pages.join(found.agg(F.collect_list("subtree").alias("template")), ["host", "asked"], "left")
    return joined.select(*_PAGE, "template")


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    growth: float = GROWTH,
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_blocks_deleted`` (as template) of every page."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        F.col(html_col).alias("html"),
    )
    parsed = materialize(rows.mapInArrow(_parse_batches, _PARSED), "parsed-pages")
    subtrees = materialize(template_subtrees(parsed, min_pages, growth), "template")
    if subtrees.limit(BROADCAST_SUBTREES + 1).count() > BROADCAST_SUBTREES:
        of_row = _without(lambda page: set(page["template"] or ()))
        return _joined(parsed, subtrees).mapInArrow(of_row, _TEXT)
    lists = subtrees.groupBy("host").agg(F.collect_list("subtree").alias("listed"))
    template = {r.host: set(r.listed) for r in lists.toLocalIterator()}
    of_host = _without(lambda page: template.get(page["host"], set()))
    return parsed.select(*_PAGE).mapInArrow(of_host, _TEXT)
