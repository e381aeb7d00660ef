"""Main-text extraction by the maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores the share of words in its kind of container
that are content on labelled pages; a tag costs the more, the rarer it is in content than
elsewhere. One linear scan finds the contiguous region with the largest sum. Of that region, the
blocks outside boilerplate containers are the text.

Labelled pages are those that mark their article (``article`` or ``main``); the weights are fitted
on at most ``SAMPLE`` of them, picked by a hash of the page id. Kinds of containers not seen there
go by their names and classes (fixed words below), but neither the body nor the elements that mark the
article, nor a container around these, is boilerplate by its classes.

Null and empty pages have an empty text, broken markup is read as far as it goes, very long pages
take one scan like others, repeated pages get the same text each, and an empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE = 2000  # labelled pages, at most, from which weights come

DEAREST = 2.0  # the most a tag may cost, so that an advert within an article does not end it

# Element names by what they do.
SILENT = ("script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "select", "button")
BOILERPLATE = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "head")
CONTENT = ("article", "main")
PLAIN = (*CONTENT, "body")  # whose marks do not say boilerplate
WRAPPERS = ("form",)  # boilerplate elements that hold the whole page on some sites
GROUPS = ("ul", "ol", "table", "figure")  # count as what they stand in unless their marks say otherwise
CONTAINERS = (*BOILERPLATE, *CONTENT, *GROUPS, "section", "div", "body")
BLOCKS = (
    *CONTAINERS, "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "td", "th", "blockquote", "pre", "dl", "dt", "dd",
    "hr", "br", "html", "title", "address", "fieldset", "figcaption", "caption", "details", "summary", "center", "tbody",
)
NAMES_OF_BOILERPLATE = (
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "form", "header", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "pagination", "pager", "popup", "promo", "promoted", "related", "replies", "reply", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "widget", "masthead", "alert", "reader",
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|(?P<open>\Z))"
    r"|<(?P<silent>" + "|".join(SILENT) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:(?<=/)>|>.*?(?:</(?P=silent)\s*>|(?P<open2>\Z)))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")
_LOOKS = re.compile(r"(?<![^\s])(?:has|with|no|without)[-_]\S*")  # marks of how a container looks
_CONTENT = re.compile(r"<(?:article|main)\b", re.I)


def kind_of(name: str, rest: str) -> tuple[str, bool]:
    """A container's kind (its name and marks) and whether these say boilerplate.

    Marks of ``body`` and of content elements, and marks like ``has-sidebar``, say how a page looks.
    """
    found = ["".join(m).lower() for m in _MARKED.findall(rest)] if rest else []
    marks = sorted({w for m in found for w in _PART.findall(m)})
    plain = [w for w in marks if w.isalpha()]  # names with digits tell single pages apart, not kinds
    silent = name in BOILERPLATE
    if not silent and name not in PLAIN and any(w in NAMES_OF_BOILERPLATE for w in marks):
        silent = any(w in NAMES_OF_BOILERPLATE for m in found for w in _PART.findall(_LOOKS.sub(" ", m)))
    return ".".join([name, *plain]), silent


class Frame(NamedTuple):
    """An open container, with what is around it."""

    name: str
    kind: str
    within: bool  # boilerplate
    content: bool  # in a content element
    fixed: bool  # boilerplate by an element that holds no page's content
    depth: int  # boilerplate containers around, none left out
    elements: tuple[int, ...]  # numbers of the innermost and the outermost open content element, or of the only one


def walk(page: str, held: frozenset[int] | None) -> Iterator[tuple[str, str, Frame]]:
    """("text", words, container) and ("tag", name, container) in page order.

    Content elements are numbered from 0. Those in ``held`` (None: all) hold the page's content, so
    containers around them are no boilerplate by their marks.
    """
    stack = [Frame("", "page", False, False, False, 0, ())]
    upto, count = 0, 0
    # Behind the last ">" no tag ends, so only a comment may begin; looking there for others would take
    # a scan to the end for each "<".
    last = page.rfind(">") + 1
    for m in _TOKEN.finditer(page, 0, last):
        if m.start() > upto:
            yield "text", entities.unescape(page[upto : m.start()]), stack[-1]
        upto = m.end() if m["open"] is None and m["open2"] is None else len(page)
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing, rest = m["close"] or m["close2"], m["rest"] or m["rest2"] or ""
        if name in CONTAINERS and not closing:
            kind, silent = kind_of(name, rest)
            top = stack[-1]
            if name in GROUPS and not silent:
                kind = top.kind
            within, elements = top.within or silent, top.elements
            if name in CONTENT:
                if held is None or count in held:
                    within = top.fixed
                elements = (count, *elements[-1:])
                count += 1
            fixed = top.fixed or name in BOILERPLATE and name not in WRAPPERS
            stack.append(Frame(name, kind, within, top.content or name in CONTENT, fixed, top.depth + silent, elements))
        yield "tag", name, stack[-1]
        if name in CONTAINERS and closing and any(s.name == name for s in stack):
            while stack[-1].name != name:
                stack.pop()
            stack.pop()
    if upto < len(page):
        comment = page.find("<!--", max(upto, last))
        yield "text", entities.unescape(page[upto : comment if comment >= 0 else len(page)]), stack[-1]


def holding(page: str) -> frozenset[int]:
    """Which of several content elements hold the page's content: those with fewest boilerplate containers around.

    The others are teasers or comments. One within another content element holds it if it stands
    alone at its depth and has more words than that has outside boilerplate.
    """
    depth: dict[tuple[int, ...], int] = {}
    words: Counter[int] = Counter()
    clear = 0
    for what, value, at in walk(page, frozenset()):
        if at.elements and not at.fixed:
            depth.setdefault(at.elements, at.depth)
            if what == "text":
                n = len(value.split())
                words.update({e: n for e in at.elements})
                clear += 0 if at.within else n
    outer = {e[0]: d for e, d in depth.items() if len(e) == 1}
    held = {e for e, d in outer.items() if d == min(outer.values())}
    inner = {e[0]: d for e, d in depth.items() if len(e) > 1 and e[-1] in held and d > outer[e[-1]]}
    least = [e for e, d in inner.items() if d == min(inner.values())]
    if len(least) == 1 and words[least[0]] > clear:
        held.add(least[0])
    return frozenset(held)


def tokens(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """("text", words, kind, boilerplate, inside content) and ("tag", name, kind, ...) in page order."""
    several = len(_CONTENT.findall(page)) > 1
    for what, value, at in walk(page, holding(page) if several else None):
        yield what, value, at.kind, at.within, at.content


class Weights:
    """Scores of words by kind of container and costs of tags by kind and name."""

    def __init__(self, counts: dict[tuple[str, str], tuple[int, int]]):
        """``counts``: (kind, tag name or "") -> times in content and elsewhere."""
        self.word = {k: (i + 0.1) / (i + o + 0.2) for (k, tag), (i, o) in counts.items() if not tag}
        words_in = sum(i for (_, tag), (i, _) in counts.items() if not tag) + 1
        words_out = sum(o for (_, tag), (_, o) in counts.items() if not tag) + 1
        self.tag = {
            (k, tag): 0.001 + min(DEAREST, math.log1p(((o + 0.01) / words_out) / ((i + 0.01) / words_in)))
            for (k, tag), (i, o) in counts.items() if tag
        }

    def of_word(self, kind: str, boilerplate: bool) -> float:
        unseen = 0.9 if kind.split(".")[0] in CONTENT else 0.6
        return 0.0 if boilerplate else self.word.get(kind, unseen)

    def of_tag(self, kind: str, name: str) -> float:
        return -self.tag.get((kind, name), 0.02)


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best region; ties go to the longest, and equal regions to the first."""
    if not page:
        return ""
    items: list[tuple[str, str, float]] = []  # text with its share of being content, or a block border
    best, best_start, best_end, start, running = 0.0, 0, 0, 0, 0.0
    for what, value, kind, boilerplate, _ in tokens(page):
        if what == "tag":
            score, share = weights.of_tag(kind, value), 0.0
            items.append(("border" if value in BLOCKS else "mark", "", 0.0))
        else:
            share = weights.of_word(kind, boilerplate)
            score = share * len(value.split())
            items.append(("text", value, share))
        if running <= 0:
            start, running = len(items) - 1, 0.0
        running += score
        if running >= best and score > 0:
            best, best_start, best_end = running, start, len(items)
    blocks, block = [], []
    for what, value, share in items[best_start:best_end]:
        if what == "border":
            blocks.append("".join(block))
            block = []
        elif what == "text" and share >= 0.5:
            block.append(value)
    blocks.append("".join(block))
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found: dict[tuple[str, str], list[int]] = {}
        for page in batch["html"]:
            for what, value, kind, boilerplate, content in tokens(page):
                n = len(value.split()) if what == "text" else 1
                if n:
                    found.setdefault((kind, "" if what == "text" else value), [0, 0])[0 if content and not boilerplate else 1] += n
        yield pd.DataFrame(
            [(k, t, i, o) for (k, t), (i, o) in found.items()], columns=["kind", "tag", "n_in", "n_out"]
        ).astype({"n_in": "int64", "n_out": "int64"})


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from at most ``sample`` labelled pages: their kinds and tags, counted on the executors."""
    labelled = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]")).select("page_id", "html")
    picked = (
        labelled.filter(F.col("page_id").isNotNull()).select(F.col("page_id").alias("picked"))
        .orderBy(F.xxhash64("picked"), "picked").limit(sample).distinct()
    )
    chosen = labelled.join(F.broadcast(picked), F.col("page_id") == F.col("picked"), "left_semi").select("html")
    counts = (
        chosen.mapInPandas(_counts, "kind string, tag string, n_in long, n_out long")
        .groupBy("kind", "tag").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
    )
    return Weights({(r["kind"], r["tag"]): (r["n_in"], r["n_out"]) for r in counts.collect()})


def extract_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(fit(pages, sample))

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, sent.value) for page in batch], dtype="object")

    return pages.select("page_id", "url", text("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
