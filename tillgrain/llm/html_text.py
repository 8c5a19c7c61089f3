"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a run of words and tags. Words score above zero, tags below, with weights learned
from labelled pages: those that mark their article with an element of ``CONTENT_TAGS``. One linear
scan finds the contiguous run with the highest score. The run is then fitted to the content element
that shares most words with it, if one agrees well, and its blocks are read out without what is never
article text: menus, headers and footers of the page, asides, forms, adverts, notices, comments,
scripts and styles. Elements end where HTML lets their end tags be left out; a form or a marked element
that holds the article itself is kept.

Character references are decoded once; white space inside a block becomes one blank; blocks are
joined by an empty line in page order. A null page, or one without words, gives the empty text. A tag
cut off at the end of the page ends it. Repeated rows give a result each; an empty table gives no
rows; other columns are left out. Where no page of the sample is labelled, ``DEFAULT`` weights hold.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.llm.tables import query, table, whole_text

CONTENT_TAGS = ("article", "main")
CONTAINERS = frozenset((*CONTENT_TAGS, "section", "div", "body", "td"))
#: Elements that are never article text; ``header`` only outside of an article.
JUNK_TAGS = frozenset("nav footer aside script style noscript template iframe object svg canvas "
                      "button select textarea input label menu dialog head title audio video "
                      "header annotation annotation-xml".split())
#: Words in a class, id or role that mark such an element.
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion recommended related respond reader-comments search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget navigation banner "
    "complementary contentinfo alert".split())
#: Words that may stand beside such a word in a slug, as in "site-footer" or "cookie-bar".
BESIDE = frozenset(
    "site page main global top bottom left right primary secondary inner outer upper lower area articles "
    "bar block body box btn button buttons card container entry field fixed floating form group "
    "holder icon icons inline item items layout link links list mobile module overlay panel "
    "placeholder post posts reader row section slot sticky stories tag text title toggle unit wrap "
    "wrapper zone content".split())
#: Marks of comments; only these mark an ``article`` or ``main`` itself.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reader-comments respond".split())
#: A marked element with this share of the words around it holds the article and is not left out.
MOST = 0.8
#: A content element below a mark needs this share of the page's words to undo the mark.
LEAST_MAIN = 1 / 3
RAW_TAGS = ("script", "style", "textarea", "title", "noscript", "iframe", "template")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option "
    "p pre section summary table tbody tfoot thead tr ul title head script style noscript".split())
SPACE_TAGS = frozenset("br td th img".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
CELLS = frozenset("td th caption".split())
TABLE_TAGS = frozenset("td th caption tr thead tbody tfoot table".split())
#: What a start tag ends where no end tag stood, and what that doesn't reach beyond: fixed by HTML, but
#: for media and labels around a paragraph.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", *CELLS)),
    "dt": (("dt", "dd"), ("dl", *CELLS)),
    "dd": (("dt", "dd"), ("dl", *CELLS)),
    "option": (("option",), ("select", "datalist", *CELLS)),
    "optgroup": (("option", "optgroup"), ("select", *CELLS)),
    "td": (("td", "th", "caption"), ("table", "tr")),
    "th": (("td", "th", "caption"), ("table", "tr")),
    "tr": (("td", "th", "tr", "caption"), ("table",)),
    "thead": (("tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tbody": (("tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
    "tfoot": (("tr", "thead", "tbody", "tfoot", "caption"), ("table",)),
}
P_ENDS = (("p",), ("button", "object", "table", "template", "audio", "canvas", "label", "svg", "video",
                   *CELLS))
#: An attribute: a name and, after "=", its value. A quote opens only as the first of a value.
VALUE = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    rf"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{VALUE})?+)?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({VALUE})?+)?+")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW_TAGS}
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
DEFAULT = {"": 1.0, "p": -0.2, "b": -0.1, "i": -0.1, "em": -0.1, "strong": -0.1, "br": -0.1,
           "h1": -0.5, "h2": -0.5, "h3": -0.5, "a": -1.5, "li": -2.0, "div": -2.0, "span": -0.5}
OTHER_TAG = -2.0
#: Pages that the weights are learned from, at most about so many.
SAMPLE_PAGES = 5_000
#: What a labelled page holds.
LABELLED = r"(?i)<(?:article|main)[\s/>]"


def _attributes(source: str) -> dict[str, str]:
    """The attributes of a tag; of those that repeat a name the first counts."""
    found: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(source):
        if value[:1] in ("'", '"'):
            value = value[1:].removesuffix(value[0])
        found.setdefault(name.lower(), value)
    return found


def _is_junk(slug: str, words: frozenset = JUNK_WORDS) -> bool:
    """Whether a slug as a whole says so: it begins or ends with a listed word, and all its other
    parts are listed too or may stand beside one."""
    slug = slug.lower()
    if slug in words:
        return True
    parts = [x for x in re.split(r"[-_]+", slug) if x and not x.isdigit()]
    return bool(parts) and (parts[0] in words or parts[-1] in words) and all(
        x in JUNK_WORDS or x in BESIDE for x in parts)


def _marked(tag: str, source: str, inside: bool) -> bool:
    """Whether the attributes mark an element that is no article text. Inside of an article the id of
    a section or a heading is an anchor made of its title, and marks nothing; neither does anything
    but hiding on an inline element there. On a content element only the marks of comments count."""
    if not source.strip():
        return False
    own = _attributes(source)
    if "hidden" in own or own.get("aria-hidden", "").strip().lower() == "true" \
            or HIDDEN.search(own.get("style", "")):
        return True
    if inside and tag not in BLOCK_TAGS and tag not in CONTAINERS:
        return False
    anchor = inside and (tag == "section" or tag in HEADINGS
                         or "section" in own.get("class", "").lower().split())
    words = COMMENT_WORDS if tag in CONTENT_TAGS else JUNK_WORDS
    return any(_is_junk(CAMEL.sub("-", slug), words)
               for name in (("class", "role") if anchor else ("class", "id", "role"))
               for slug in own.get(name, "").split())


@dataclass
class Element:
    """An element that may hold the article, or be marked as none of it: its tokens, whether it is
    marked, and what stands open around it."""
    tag: str
    start: int
    marked: bool
    #: The nearest content element around it, and whether a mark is.
    around: "Element | None"
    below_mark: bool
    end: int = 0


class Page:
    """The tokens of a page, with what a browser ends of itself ended: texts and tags, and which of
    them are junk.

    Junk tags always are. A mark by class, id, role or hiding, or a form, is judged when the page has
    been read: not if it holds the page's main content element, nor if nearly all words (``MOST``)
    around it are its own.
    """

    def __init__(self, source: str):
        #: (tag, "" for text; text; whether it is junk; words)
        self.tokens: list[tuple[str, str, bool, int]] = []
        self._stack: list[tuple[str, Element | None, bool]] = []
        self._open: dict[str, list[int]] = {}
        self._content: list[Element] = []
        self._blocks: list[int] = []
        self._hard = self._marks = 0
        self._elements: list[Element] = []
        self._read(source)
        self._judge()
        #: Content elements: tag, first token, end.
        self.elements = [(e.tag, e.start, e.end) for e in self._elements if e.tag in CONTAINERS]

    def _depth(self, tags: tuple[str, ...] | frozenset) -> int:
        return max((at[-1] for t in tags if (at := self._open.get(t))), default=-1)

    def _end_down_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            tag, element, hard = self._stack.pop()
            self._open[tag].pop()
            if tag in BLOCK_TAGS:
                self._blocks.pop()
            self._hard -= hard
            if element:
                element.end = len(self.tokens)
                self._marks -= element.marked
                if tag in CONTENT_TAGS:
                    self._content.pop()

    def _end_implied(self, tags: tuple[str, ...], beyond: tuple[str, ...]) -> None:
        barrier = self._depth(beyond)
        while (at := self._depth(tags)) > barrier:
            self._end_down_to(at)

    def _end(self, tag: str) -> None:
        """An end tag closes the last of its like, but none outside of a table's cell, and one of an
        inline element none around a block."""
        at = self._depth((tag,))
        if at < 0 or tag in ("body", "html"):
            return
        if tag not in TABLE_TAGS and at < self._depth(CELLS):
            return
        inline = not (tag in BLOCK_TAGS or tag in TABLE_TAGS or tag in JUNK_TAGS)
        if inline and self._blocks and at < self._blocks[-1]:
            return
        self._end_down_to(at)

    def _start(self, tag: str, attributes: str) -> None:
        if "head" in self._open and self._open["head"] and tag not in IN_HEAD and tag != "head":
            self._end_down_to(self._open["head"][-1])
        if tag in BLOCK_TAGS and tag not in TABLE_TAGS:
            self._end_implied(*P_ENDS)
        if tag in ENDS:
            self._end_implied(*ENDS[tag])
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK_TAGS:
            return
        inside = bool(self._content)
        hard = tag in JUNK_TAGS and not (tag == "header" and inside)
        marked = not hard and tag not in ("html", "body") and (
            tag == "form" or _marked(tag, attributes, inside))
        element = None
        if tag in CONTAINERS or marked:
            element = Element(tag, len(self.tokens), marked,
                              self._content[-1] if inside else None, self._marks > 0)
            self._elements.append(element)
            self._marks += marked
            if tag in CONTENT_TAGS:
                self._content.append(element)
        self._hard += hard
        self._open.setdefault(tag, []).append(len(self._stack))
        if tag in BLOCK_TAGS:
            self._blocks.append(len(self._stack))
        self._stack.append((tag, element, hard))

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = TOKEN.search(source, at)
            begin = found.start() if found else size
            if begin > at:
                self._text(source[at:begin])
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.groups()
            if tag is None:
                continue
            tag = tag.lower()
            self.tokens.append((tag, "", self._hard > 0, 0))
            if closing:
                self._end(tag)
                continue
            self._start(tag, attributes)
            if tag in RAW_TAGS:
                end = RAW_END[tag].search(source, at)
                at = end.start() if end else size
        self._end_down_to(0)

    def _text(self, text: str) -> None:
        words = len(text.split())
        if words and self._stack and self._stack[-1][0] == "head":
            self._end_down_to(len(self._stack) - 1)
        self.tokens.append(("", text, self._hard > 0, words))

    def _count(self) -> None:
        self._before = list(accumulate((0 if junk else n for _, _, junk, n in self.tokens), initial=0))

    def _main(self) -> Element | None:
        """The content element with most words. One below a mark, or marked itself while no other
        is, must hold a good share of the page and more than twice what the others do."""
        every = [e for e in self._elements if e.tag in CONTENT_TAGS and self.words(e.start, e.end)]
        size = lambda e: self.words(e.start, e.end)
        free = max((e for e in every if not e.marked and not e.below_mark), key=size, default=None)
        held = [e for e in every if not e.marked and e.below_mark]
        if not held and len(every) == 1:
            held = [e for e in every if not e.below_mark]
        below = max(held, key=size, default=None)
        if below and size(below) >= LEAST_MAIN * self._before[-1] and (
                free is None or size(below) > 2 * size(free)):
            return below
        return free

    def _judge(self) -> None:
        self._count()
        marked = [e for e in self._elements if e.marked]
        if not marked:
            return
        main = self._main()
        change = [0] * (len(self.tokens) + 1)
        for e in marked:
            if main and e.start <= main.start and main.end <= e.end:
                continue
            if main is None or e.around:
                words = self.words(e.around.start, e.around.end) if e.around else self._before[-1]
                if self.words(e.start, e.end) >= MOST * words:
                    continue
            change[e.start] += 1
            change[e.end] -= 1
        self.tokens = [(tag, text, junk or deep > 0, n) for (tag, text, junk, n), deep
                       in zip(self.tokens, accumulate(change))]
        self._count()

    def words(self, start: int, end: int) -> int:
        return self._before[max(start, end)] - self._before[start]


def best_run(page: Page, weights: dict[str, float]) -> tuple[int, int]:
    """The run of tokens with the highest score, by one scan; empty if no word scores."""
    word = weights[""]
    total, start = 0.0, 0
    best, run = 0.0, (0, 0)
    for at, (tag, _, junk, count) in enumerate(page.tokens):
        if tag:
            total += weights.get(tag, OTHER_TAG)
        elif not junk:
            total += word * count
        if total <= 0:
            total, start = 0.0, at + 1
        elif total > best:
            best, run = total, (start, at + 1)
    return run


def fitted(page: Page, run: tuple[int, int]) -> tuple[int, int]:
    """The content element that shares most words with the run, if it and the run agree by half or
    more or it is marked as content; else the run."""
    own = page.words(*run)
    if not own:
        return run
    chosen, best = run, 0.5
    for tag, start, end in page.elements:
        shared = page.words(max(start, run[0]), min(end, run[1]))
        union = own + page.words(start, end) - shared
        share = shared / union if union else 0.0
        if tag in CONTENT_TAGS and shared:
            share += 1.0
        if share > best:
            chosen, best = (start, end), share
    return chosen


def blocks(page: Page, start: int, end: int) -> list[str]:
    made: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            made.append(text)

    for tag, text, junk, _ in page.tokens[start:end]:
        if tag:
            if tag in BLOCK_TAGS:
                close()
            elif tag in SPACE_TAGS:
                held.append(" ")
        elif not junk:
            held.append(html.unescape(text))
    close()
    return made


def main_text(source: str, weights: dict[str, float]) -> str:
    page = Page(source)
    return "\n\n".join(blocks(page, *fitted(page, best_run(page, weights))))


def learn_weights(pages: DataFrame, text: str = "html", id: str = "page_id",
                  sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from about ``sample`` labelled pages, taken by a hash of the id among all that are
    labelled: the log of how much more often a tag stands inside the article than outside, never above
    -0.05, and for words the like, never below 0.5."""
    labelled = pages.where(F.col(f"`{text}`").rlike(LABELLED))
    share = min(1.0, sample / max(labelled.count(), 1))
    taken = labelled.where(F.pmod(F.xxhash64(F.col(f"`{id}`")), F.lit(1 << 20)) < int(share * (1 << 20)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for source in batch.column(0):
                page = Page(source.as_py())
                deep = [0] * (len(page.tokens) + 1)
                for tag, start, end in page.elements:
                    if tag in CONTENT_TAGS:
                        deep[start] += 1
                        deep[end] -= 1
                if not any(deep):
                    continue
                for (tag, _, _, count), within in zip(page.tokens, accumulate(deep)):
                    (inside if within else outside)[tag] += 1 if tag else count
        tags = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict({
            "tag": pa.array(tags, pa.string()),
            "inside": pa.array([inside[t] for t in tags], pa.int64()),
            "outside": pa.array([outside[t] for t in tags], pa.int64())})

    counted = (taken.select(whole_text(text)).mapInArrow(
        tally, "tag string, inside bigint, outside bigint")
        .groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")))
    # No more rows than the sampled pages have kinds of tags.
    rows = counted.collect()
    words = next((r for r in rows if r["tag"] == ""), None)
    if words is None or not words["inside"]:
        return dict(DEFAULT)
    tags_in = sum(r["inside"] for r in rows if r["tag"]) + 1
    tags_out = sum(r["outside"] for r in rows if r["tag"]) + 1
    weights = {r["tag"]: min(-0.05, max(-8.0, log((r["inside"] + 0.5) / tags_in)
                                        - log((r["outside"] + 0.5) / tags_out)))
               for r in rows if r["tag"]}
    weights[""] = max(0.5, min(2.0, log((words["inside"] + 1) / (words["outside"] + 1))))
    return weights


def extract(pages: DataFrame, weights: dict[str, float], id: str = "page_id", url: str = "url",
            text: str = "html") -> DataFrame:
    """Per page its main text and how many characters it has."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), weights) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(
        F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
        whole_text(text).alias("html")).mapInArrow(
            read, "page_id bigint, url string, text string, n_chars bigint")


@query("op8_html_text")
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extract(pages, learn_weights(pages))
