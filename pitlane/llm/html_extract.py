"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags negative;
one linear scan finds the contiguous run with the greatest sum, which is the
content region.  Weights are the log-odds of each tag (and of a word) inside against
outside the content of labelled pages; pages that mark their content with
one ``article`` or ``main`` element serve as labelled, a bounded sample of them.

Elements that are never content (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments), known by tag or by class, id and role, are
cut out before the scan.  A class counts when all its parts are words for such elements or for
places (``site-header``, ``cookie-notice``; neither ``related-work`` nor ``no-sidebar``), and a form or header that holds most of
the page's words stands around the page and stays.  Where a page marks its content, the scan runs inside
the marked element with tags at no cost, so that the article stays whole whatever it is built of; elsewhere
the learned weights decide.  The region's text is split into
blocks at block-level tags; references are decoded, white space inside a
block becomes one space, blocks are joined by one newline.

Defined cases: null and empty html give an empty text; unclosed elements end where
the page ends, but an unclosed boilerplate element, or one that holds the
marked content, is not cut out; without labelled pages the weights are 1 for a
word and -1 for a tag; after a tag whose quotes never close, tags of that page end at their
first ``>``; a page of any length takes time in proportion; repeated rows are extracted each; an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import ship

SAMPLE = 4096  # labelled pages the weights are learned from, about
LEAST, MOST = 0.05, 0.85  # bounds of a tag's penalty, the upper one of a word's weight: any word outweighs a tag that labelled articles do not use
UNSEEN = -0.2  # of a tag on no labelled page
WORD = "#word"

_RAW = frozenset("script style textarea title iframe select".split())
_DRAWN = "svg"  # may close itself, unlike the raw elements of HTML
_TAG = re.compile(r"<(/?)([a-z][\w:-]*)", re.I)
_ATTRIBUTE_END = re.compile(r"""[>"']""")
_CLOSES = {name: re.compile(rf"</{name}\s*>", re.I) for name in (*_RAW, _DRAWN)}
_NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math semantics mi mn mo mtext ms mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILER_TAGS = frozenset("nav header footer aside form button dialog menu head fieldset".split())
_BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies "
    "consent notice notices popup modal promo sponsor sponsored share sharing social related newsletter subscribe comment comments "
    "reply replies respond disqus footer header masthead topbar toolbar pagination pager login signup search complementary contentinfo".split()
)
#: Words that may stand beside those in a class without making it something else.
_PLACES = frozenset(
    "site main global top bottom left right inner outer primary secondary box bar area wrap wrapper container block widget slot unit list "
    "item items links buttons icons posts articles stories thread form message msg bg js".split()
)
#: Elements that hold text of their own: a class or id does not make them boilerplate inside marked content.
_CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figure figcaption table caption thead tbody tfoot tr td th li dt dd".split()) | _INLINE
#: Boilerplate that may also stand around a whole page.
_AROUND = frozenset("form fieldset header".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MARKS = frozenset(("article", "main"))
_OWN = frozenset(("html", "body", *_MARKS))


def _boilerplate_name(attributes: str) -> bool:
    """Does a class, id or role among the attributes name boilerplate?"""
    for n in _NAMING.finditer(attributes):
        for name in (n[1] or n[2] or n[3] or "").lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            if not _BOILER_NAMES.isdisjoint(words) and all(w in _BOILER_NAMES or w in _PLACES for w in words):
                return True
    return False


def pieces(page: str) -> list[tuple[str, str]]:
    """(kind, value) of a page in order: ``text`` with its string, ``open`` and ``close`` with a tag; raw elements and comments are left out.

    An opening tag named like boilerplate by its class, id or role has kind ``boiler``.  One
    pass: every search either goes on from what it found, or is not made again.
    """
    out, at, n = [], 0, len(page)
    last = page.rfind(">")  # behind it there is no tag
    quotes = True  # do quotes shield a ">"; not any more once they have not closed

    def tag_end(i: int) -> int:
        """Place of the ``>`` that ends the tag."""
        nonlocal quotes
        k = i
        while quotes:
            m = _ATTRIBUTE_END.search(page, k)
            if m and m[0] == ">":
                return m.start()
            k = page.find(m[0], m.end()) + 1 if m else 0
            if not k:
                quotes = False
        return page.find(">", i)

    while at < n:
        if at > last:
            comment = page.find("<!--", at)
            out.append(("text", page[at : n if comment < 0 else comment]))
            break
        begin = page.find("<", at)
        if begin != at:
            begin = n if begin < 0 else begin
            out.append(("text", page[at:begin]))
            at = begin
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, at)
        if not m:
            if page[at + 1] in "!?":
                at = page.find(">", at) + 1
            else:
                out.append(("text", "<"))
                at += 1
            continue
        name = m[2].lower()
        raw = not m[1] and name in _RAW
        end = page.find(">", at) if raw else tag_end(m.end())
        if raw or not m[1] and name == _DRAWN and page[end - 1] != "/":
            close = _CLOSES[name].search(page, end + 1)
            at = close.end() if close else n
            continue
        at = end + 1
        if m[1]:
            out.append(("close", name))
        elif name != _DRAWN:
            named = name not in _OWN and name not in _VOID and _boilerplate_name(page[m.end() : end])
            out.append(("boiler" if named else "open", name))
    return out


def _ends(parts: list[tuple[str, str]]) -> dict[int, int]:
    """Index of each opening tag -> index of its closing tag, where there is one (nearest first, same name)."""
    ends, waiting = {}, {}
    for i, (kind, name) in enumerate(parts):
        if kind == "close":
            if waiting.get(name):
                ends[waiting[name].pop()] = i
        elif kind != "text":
            waiting.setdefault(name, []).append(i)
    return ends


def _words(parts: list[tuple[str, str]]) -> list[int]:
    """Words before each part, and in all."""
    return [0, *accumulate(len(value.split()) if kind == "text" else 0 for kind, value in parts)]


def marked_content(parts: list[tuple[str, str]], ends: dict[int, int]) -> tuple[int, int] | None:
    """Range inside the element that marks the page's content, if there is one.

    The one article outside others, or of several the one with most of their words; else the ``main`` element with
    most words.  An article that never closes goes to the page's end.
    """
    words = _words(parts)
    found: dict[str, list[tuple[int, int]]] = {name: [] for name in _MARKS}
    for i, (kind, name) in enumerate(parts):
        if kind in ("open", "boiler") and name in _MARKS and (not found[name] or found[name][-1][1] <= i):
            found[name].append((i, ends.get(i, len(parts))))
    size = {r: words[r[1]] - words[r[0]] for name in _MARKS for r in found[name]}
    articles = sorted(found["article"], key=size.get)
    if articles and 2 * size[articles[-1]] > sum(map(size.get, articles)):
        return articles[-1]
    if found["main"]:
        return max(found["main"], key=size.get)
    return articles[-1] if articles else None


def _cut(parts: list[tuple[str, str]], goes) -> list[tuple[str, str]]:
    """``parts`` without the elements for whose opening tag's and closing tag's index ``goes`` is true; unclosed ones stay."""
    ends = _ends(parts)
    out: list[tuple[str, str]] = []
    i = 0
    while i < len(parts):
        end = ends.get(i)
        if end is not None and goes(i, end, out):
            i = end + 1
        else:
            out.append(parts[i])
            i += 1
    return out


def without_boilerplate(parts: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], bool]:
    """The marked content's parts, or the page's if none is marked, without boilerplate elements; and whether it is marked.

    An article's own header, headings, and a button in running text stay, as do a form and a header that hold
    most of the words that are left when all else is cut.
    """
    content = marked_content(parts, _ends(parts))
    if content:
        parts = parts[content[0] + 1 : content[1]]
    holds = [0, *accumulate(kind in ("open", "boiler") and name in _MARKS for kind, name in parts)]

    def named(i: int, end: int, out: list[tuple[str, str]]) -> bool:
        kind, name = parts[i]
        if kind == "open" and (name not in _BOILER_TAGS or name in _AROUND):
            return False
        if name == "button" and kind == "open" and out and out[-1][0] == "text" and out[-1][1].strip():
            return False
        return kind == "open" or (name not in _CONTENT if content else name not in _HEADINGS and holds[end] == holds[i + 1])

    parts = [("open" if kind == "boiler" else kind, name) for kind, name in _cut(parts, named)]
    words = _words(parts)

    def around(i: int, end: int, out: list[tuple[str, str]]) -> bool:
        name = parts[i][1]
        return parts[i][0] == "open" and name in _AROUND and not (content and name == "header") and 2 * (words[end] - words[i]) <= words[-1]

    return _cut(parts, around), content is not None


def region(parts: list[tuple[str, str]], weights: dict[str, float]) -> tuple[int, int]:
    """Half-open range of the greatest sum: the first to reach it, from as far left as it holds; empty if there is no word."""
    word, other = weights[WORD], weights.get("", -1.0)
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, value) in enumerate(parts):
        if kind == "text":
            total += word * len(value.split())
            if total > best:
                best, found = total, (start, i + 1)
        else:
            total += weights.get(value, other)
        if total < 0:
            total, start = 0.0, i + 1
    return found


def blocks(parts: list[tuple[str, str]]) -> str:
    """Text of the parts: blocks split at block-level tags, joined by newlines."""
    out, run = [], []
    for kind, value in [*parts, ("open", "p")]:
        if kind == "text":
            run.append(value)
        elif value == "br":
            run.append(" ")
        elif value not in _INLINE and value != "button":
            if text := " ".join(html.unescape("".join(run)).split()):
                out.append(text)
            run = []
    return "\n".join(out)


def extract(page: str | None, weights: dict[str, float]) -> str:
    parts, marked = without_boilerplate(pieces(page or ""))
    start, end = region(parts, {WORD: weights[WORD], "": 0.0} if marked else weights)
    return blocks(parts[start:end])


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words and tags inside and outside the marked content of labelled pages."""
    inside, outside = Counter(), Counter()
    for batch in batches:
        for page in batch["html"]:
            parts = pieces(page or "")
            ends = _ends(parts)
            marked = [(i, ends[i]) for i, (kind, name) in enumerate(parts) if kind in ("open", "boiler") and name in _MARKS and i in ends]
            if len(marked) != 1:
                continue
            a, b = marked[0]
            for i, (kind, value) in enumerate(parts):
                where = inside if a < i < b else outside
                if kind == "text":
                    where[WORD] += len(value.split())
                else:
                    where[value] += 1
    yield pd.DataFrame([(k, inside[k], outside[k]) for k in inside | outside], columns=["kind", "inside", "outside"])


def learn_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weight of a word (``WORD``), of each tag, and of an unseen tag (``""``)."""
    ship(pages.sparkSession)
    marked = pages.where(F.lower("html").rlike("<(article|main)[ >]"))
    rows = marked.count()
    if rows > sample:  # a bounded sample of the marked pages, by hash; pages without an id and url differ by their html
        marked = marked.where(F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 30)) < F.lit(sample / rows * (1 << 30)))
    counts = marked.select("html").mapInPandas(_tally, "kind string, inside long, outside long").groupBy("kind")
    # a row for each tag name used by the sampled pages
    counts = {r["kind"]: (r["inside"], r["outside"]) for r in counts.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()}
    if not counts:
        return {WORD: 1.0, "": -1.0}
    within, without = (sum(c[i] for c in counts.values()) + len(counts) for i in (0, 1))
    odds = {k: math.log((a + 1) / within) - math.log((b + 1) / without) for k, (a, b) in counts.items()}
    word = max(LEAST * 4, odds.get(WORD, 1.0))
    weights = {k: max(-MOST * word, min(-LEAST, v)) for k, v in odds.items() if k != WORD}
    return weights | {WORD: word, "": UNSEEN}


def _extract(weights: dict[str, float]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), weights) for h in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return task


def main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ship(pages.sparkSession)
    weights = weights or learn_weights(pages)
    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return given.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long")
