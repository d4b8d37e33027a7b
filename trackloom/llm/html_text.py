"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of texts and of the tags between them. Words score by what the elements around them are called, the tags
between two texts by their kind and always below zero; both weights are log ratios counted on labelled pages. One linear scan
finds the contiguous region with the largest sum. Inside it, texts whose words score as boilerplate are left out.

Pages label themselves where they mark their article (<article> or <main>); extraction doesn't look at these marks. Names that
labelled pages show too seldom weigh what their usual meaning says (BOILER and BOILER_WORDS).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import map_rows

#: Bounds of the training sample: so many labelled pages, by a hash of their ids, and so many names of elements, the commonest.
SAMPLE_PAGES, SAMPLE_NAMES = 1000, 20_000
#: A name that labelled pages show around fewer words than this has no weight of its own.
LEAST_WORDS = 20
#: Words that score this or less are boilerplate. So far it may count against a region in a word, and in a text.
BOILER_SCORE, WORD_SHARE, TEXT_LOSS = -1.0, 0.05, -1.0

# Elements by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTENT = {"article", "main"}
BOILER = set("aside button dialog fieldset footer form header iframe label legend menu nav option select".split())
BOILER_WORDS = set(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer discussion footer form "
    "header login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements that any part of a page may use: what one site puts in them says little of the next.
PLAIN = set("a b body dd div dl dt em html i li ol p section small span strong table tbody td th tr u ul".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


def names_of(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role."""
    return tuple(w for m in _NAMED.finditer(attributes) for w in _PARTS.split((m[1] or m[2] or m[3] or "").lower()) if w)


@dataclass(eq=False, slots=True)
class Place:
    """An open element, linked to the one around it. `new` are the features that no element around it has. content and boiler say
    whether a page marks it as article or as something else; they are labels."""

    above: Place | None = None
    tag: str = ""
    names: tuple[str, ...] = ()
    new: tuple[str, ...] = ()
    boiler: bool = False
    content: bool = False
    cell: Place | None = None
    row: Place | None = None
    item: Place | None = None
    learnt: tuple[float, float] | None = None

    def features(self) -> Iterator[str]:
        place: Place | None = self
        while place is not None:
            yield from place.new
            place = place.above


@dataclass
class Run:
    """Text between two tags, with the elements around it, or a tag."""

    tag: str
    text: str
    place: Place
    block: int

    @property
    def boiler(self) -> bool:
        return self.place.boiler

    @property
    def content(self) -> bool:
        return self.place.content


def runs(page: str | None) -> Iterator[Run]:
    """A page's texts and tags in order. Scripts, styles, comments and a tag cut off by the page's end are no tokens.

    Every element is followed however deep it lies; counts and links keep the work linear.
    """
    page = page or ""
    top = Place()
    tags: Counter[str] = Counter()
    around: Counter[str] = Counter()
    block = at = 0

    def own(place: Place) -> set[str]:
        #: A header at the page's top is the site's; one further in is that of what it stands in.
        tag = "page>header" if place.tag == "header" and (place.above is None or place.above.tag in ("", "html", "body")) else place.tag
        return {tag, *(f".{w}" for w in place.names)}

    def pop() -> Place:
        nonlocal top
        gone, top = top, top.above
        tags[gone.tag] -= 1
        around.subtract(own(gone))
        return gone

    def pop_to(place: Place | None) -> None:
        while place is not None and pop() is not place:
            pass

    def push(tag: str, names: tuple[str, ...]) -> None:
        nonlocal top
        named = tag not in CONTENT and tag not in ("html", "body") and not BOILER_WORDS.isdisjoint(names)
        plain = tag in BOILER and not (tag == "header" and top.content)
        made = Place(top, tag, names, (), top.boiler or plain or named, top.content or tag in CONTENT)
        if tag != "table":
            made.cell, made.row, made.item = top.cell, top.row, top.item
        if tag in ("td", "th"):
            made.cell = made
        elif tag == "tr":
            made.row, made.cell = made, None
        elif tag == "dl":
            made.item = None
        elif tag in ("dt", "dd"):
            made.item = made
        features = own(made)
        made.new = tuple(f for f in features if not around[f])
        around.update(features)
        tags[tag] += 1
        top = made

    for m in _TAG.finditer(page):
        if m.start() > at:
            yield Run("", page[at : m.start()], top, block)
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag or not m[0].endswith(">"):
            continue
        closing, attributes = bool(m[2] or m[5]), m[4] or m[7] or ""
        block += tag in BLOCK
        yield Run(("/" if closing else "") + tag, "", top, block)
        if closing:
            if tags[tag]:
                while pop().tag != tag:
                    pass
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in BLOCK and tags["p"]:  # a paragraph ends where the next block starts
                while pop().tag != "p":
                    pass
            if tag == "li" and top.tag == "li":
                pop()
            elif tag in ("td", "th"):  # cells, rows and terms end where the next one of the same table or list starts
                pop_to(top.cell)
            elif tag in ("tr", "tbody", "thead", "tfoot"):
                pop_to(top.row or top.cell)
            elif tag in ("dt", "dd"):
                pop_to(top.item)
            push(tag, names_of(attributes))
    if at < len(page):
        yield Run("", page[at:], top, block)


@dataclass
class Weights:
    """Log ratios in and out of the labelled regions: of words by feature, of tags by kind."""

    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)

    def learnt(self, place: Place) -> tuple[float, float]:
        """Least and largest weight of the features around a place, kept there; (inf, -inf) where none has one."""
        todo, at = [], place
        while at is not None and at.learnt is None:
            todo.append(at)
            at = at.above
        low, high = (math.inf, -math.inf) if at is None else at.learnt
        for p in reversed(todo):
            own = [self.word[f] for f in p.new if f in self.word]
            low, high = min([low, *own]), max([high, *own])
            p.learnt = low, high
        return low, high

    def of_word(self, place: Place) -> float:
        low, high = self.learnt(place)
        return low if low <= BOILER_SCORE else max(high, 1.0)

    def of_tag(self, tag: str) -> float:
        return self.tag.get(tag, -0.25) if tag.lstrip("/") in BLOCK else -0.1


def counted(page: str | None) -> tuple[Counter[tuple[str, bool]], Counter[tuple[str, bool]]]:
    """(words by feature, tags by kind) inside and outside the article that a page marks; nothing of a page that marks none."""
    words, tags = Counter(), Counter()
    own = list(runs(page))
    if any(r.content for r in own):
        for r in own:
            inside = r.content and not r.boiler
            if r.tag:
                tags[r.tag, inside] += 1
            elif n := len(r.text.split()):
                words.update({(f, inside): n for f in r.place.features() if f not in CONTENT})
    return words, tags


def weighed(words: Counter[tuple[str, bool]], tags: Counter[tuple[str, bool]]) -> Weights:
    """Weights from counts over labelled pages, and usual meanings where there are too few."""
    ratio = lambda c, k: max(-3.0, min(3.0, math.log((c[k, True] + 1) / (c[k, False] + 1))))
    usual = {t: -3.0 for t in BOILER - {"header"}} | {f".{w}": -3.0 for w in BOILER_WORDS} | {"page>header": -3.0}
    seen = {f for f, _ in words if words[f, True] + words[f, False] >= LEAST_WORDS}
    return Weights(usual | {f: max(ratio(words, f), -0.5 if f in PLAIN else -3.0) for f in seen}, {t: max(min(-0.1, ratio(tags, t) - 1) / 4, -0.25 if t.lstrip("/") in PLAIN else -1.0) for t, _ in tags})


def train(pages: list[str]) -> Weights:
    """Weights from the pages that mark an article."""
    words, tags = Counter(), Counter()
    for page in pages:
        for total, own in zip((words, tags), counted(page), strict=True):
            total.update(own)
    return weighed(words, tags)


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous part with the largest positive sum, the first and shortest of equals; (0, 0) if there is none."""
    best, sum_, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if sum_ <= 0:
            sum_, start = 0.0, i
        sum_ += s
        if sum_ > best:
            best, found = sum_, (start, i + 1)
    return found


def extract(page: str | None, weights: Weights) -> str:
    """The main text: blocks in page order joined by a line feed, white space inside a block collapsed, references decoded."""
    own = list(runs(page))
    scores, words = [], [0.0] * len(own)
    between = 0.0  # the lowest score of the tags since the last text: a nest of tags is one boundary, however deep
    for k, r in enumerate(own):
        if r.tag:
            less = min(between, weights.of_tag(r.tag))
            scores.append(less - between)
            between = less
        elif n := len(r.text.split()):
            words[k] = w = weights.of_word(r.place)
            scores.append(max(TEXT_LOSS, WORD_SHARE * w * n) if w <= BOILER_SCORE else w * n)
            between = 0.0
        else:
            scores.append(0.0)
    lo, hi = best_region(scores)
    blocks: dict[int, list[str]] = {}
    for k in range(lo, hi):
        r = own[k]
        if r.tag == "br" or (not r.tag and not words[k]):
            blocks.setdefault(r.block, []).append(" ")
        elif not r.tag and words[k] > BOILER_SCORE:
            blocks.setdefault(r.block, []).append(r.text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, most: int = SAMPLE_PAGES) -> Weights:
    """Weights from a bounded sample of the pages that mark an article, alike whatever the table's size.

    The sample's pages are counted where they lie; the driver gets their element names' counts alone.
    """
    marked = pages.select("page_id", "html").filter(F.col("page_id").isNotNull() & F.col("html").rlike("(?i)<(article|main)\\b"))
    ids = marked.select("page_id").distinct().orderBy(F.xxhash64("page_id", F.lit(29)), "page_id").limit(most)
    sample = pages.select("page_id", "html").join(F.broadcast(ids), "page_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(kind, f, inside, n) for page in b.column(1).to_pylist() for kind, own in enumerate(counted(page)) for (f, inside), n in own.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.string(), pa.bool_(), pa.int64()))], names=["kind", "name", "inside", "n"])

    counts = map_rows(sample, run, "kind int, name string, inside boolean, n long", 128).groupBy("kind", "name", "inside").agg(F.sum("n").alias("n"))
    words, tags = Counter(), Counter()
    for kind, name, inside, n in counts.orderBy(F.desc("n"), "kind", "name", "inside").limit(SAMPLE_NAMES).collect():
        (tags if kind else words)[name, inside] = n
    return weighed(words, tags)


def extract_pages(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages(page_id, url, html, ...).

    Null or empty pages, and pages without content, have an empty text. Rows that repeat are extracted as often; a null page_id or url
    is passed on. Very long pages are read whole, however deep their elements nest. Of regions with equal sums the first and shortest
    is taken. Other columns are not read; an empty table gives an empty result.
    """
    weights = learn(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(p, weights) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_rows(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_chars long", 128)
