"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative; the weights are log ratios of how often each
kind occurs inside and outside the content of labelled pages. One linear scan finds the contiguous region of the highest
total. Elements that never are content (menus, footers, adverts, forms, scripts, reader comments ...) add tag scores but
no words, and are left out of the text of the region.

Labelled pages are those whose own markup names their one content element (``<article>`` or ``<main>``). Weights are
fitted on a bounded sample of ``LABELLED`` of them; every page is then scanned whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import sample_of

LABELLED = 2_000
WORD_RANGE = (0.2, 2.0)
TAG_RANGE = (-4.0, -0.05)
INSIDE = -0.1  # least score of a tag inside a named content element

# Weights where no page is labelled.
DEFAULT_WEIGHTS = {"word": 1.0, "link word": 0.2, "other tag": -1.0}

# Element names of the markup language.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot"
    " th thead title tr ul".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())  # their inside holds no tags
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_CONTENT = set(
    "head nav footer aside form script style noscript template button select textarea iframe object svg canvas audio video"
    " dialog menu search noembed noframes xmp option datalist math applet".split()
)
NO_CONTENT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
# Words of class and id attributes.
NO_CONTENT_NAMES = set(
    "ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion promoted"
    " nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager footer header masthead topbar sidebar side aside"
    " rail widget widgets notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription"
    " signup login share sharing social comment comments commentlist disqus reply replies respond related recommended"
    " recommendations toolbar skip".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?")
_NAME_PARTS = re.compile(r"[^a-z0-9]+")


def _excluded(name: str, rest: str, inside: bool) -> bool:
    """Whether an element holds no content. ``inside``: it stands in the page's content element."""
    if name in NO_CONTENT or (name == "header" and not inside):
        return True
    if not rest or name in ("html", "body", "main", "article"):
        return False
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id"):
            for word in value.split():
                parts = _NAME_PARTS.split(word)
                if parts[0] in ("has", "with", "no"):  # says what else the page has
                    continue
                found = NO_CONTENT_NAMES.intersection(parts)
                if found and not (inside and found <= {"header"}):
                    return True
        if key == "role" and value in NO_CONTENT_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def tokens(page: str) -> Iterator[tuple[str, str, str, bool, bool]]:
    """(kind, name, text, dropped, inside): kind is text, open or close; dropped: in an element without content.

    inside: in an ``<article>`` or ``<main>``. Elements left open end with their parent; a stray end tag closes nothing.
    """
    stack: list[tuple[str, bool, bool]] = []  # name, dropped, inside
    at, n = 0, len(page)

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    while at < n:
        m = _TOKEN.search(page, at)
        cut = m.start() if m else n
        if cut > at:
            yield ("text", "", html.unescape(page[at:cut]), *state())
        if m is None:
            return
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                yield ("text", "", m[0][9:].removesuffix("]]>"), *state())
            continue
        dropped, inside = state()
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    yield ("close", name, "", stack[i][1], stack[i][2])
                    del stack[i:]
                    break
            continue
        rest = m["rest"] or m["rest2"] or ""
        if name in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == name:
            stack.pop()  # the next one ends it
        own = dropped or _excluded(name, rest, inside)
        within = inside or name in ("article", "main")
        yield ("open", name, "", own, within)
        if name in VOID or rest.endswith("/"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            inner = page[at : close.start() if close else n]
            if inner:
                yield ("text", "", inner if name in ("script", "style") else html.unescape(inner), own, within)
            yield ("close", name, "", own, within)
            at = close.end() if close else n
            continue
        stack.append((name, own, within))


def _tag(kind: str, name: str) -> str:
    return ("/" if kind == "close" else "") + name


def kind_counts(pages: Iterator[str]) -> tuple[Counter, Counter]:
    """How often each kind of token occurs inside and outside the content of labelled pages."""
    within, without = Counter(), Counter()
    known = BLOCKS | NO_CONTENT | VOID | set("a abbr b big cite code em font i kbd mark q s small span strong sub sup time u".split())
    for page in pages:
        links = 0
        for kind, name, text, dropped, inside in tokens(page):
            counts = within if inside and not dropped else without
            if kind == "text":
                counts["link word" if links else "word"] += len(text.split())
            else:
                counts[_tag(kind, name) if name in known else "other tag"] += 1
                if name == "a":
                    links = 1 if kind == "open" else 0
    return within, without


def weights_of(within: Counter, without: Counter) -> dict[str, float]:
    """Log ratios, words kept positive and tags negative."""
    a, b = sum(within.values()), sum(without.values())
    if not a or not b:
        return dict(DEFAULT_WEIGHTS)
    from math import log

    kinds = set(within) | set(without) | set(DEFAULT_WEIGHTS)
    out = {}
    for kind in kinds:
        ratio = log((within[kind] + 0.5) / (a + 0.5 * len(kinds))) - log((without[kind] + 0.5) / (b + 0.5 * len(kinds)))
        low, high = WORD_RANGE if kind.endswith("word") else TAG_RANGE
        out[kind] = min(high, max(low, ratio))
    return out


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Text of the best region: one line a block, white space inside a block as one space."""
    if not page:
        return ""
    blocks: list[list[str]] = [[]]  # words; text goes on in the last block
    other = weights.get("other tag", -1.0)
    plain, linked = weights.get("word", 1.0), weights.get("link word", 0.2)
    # Linear scan for the maximum-scoring region, on groups of words between tags.
    total, since = 0.0, None
    best, best_from, best_to = 0.0, None, None
    spans: list[tuple[int, str]] = []  # (block, text) of each piece of text
    block, links = 0, 0
    for kind, name, text, dropped, inside in tokens(page):
        if kind == "text":
            if dropped:
                continue
            n = len(text.split())
            spans.append((block, text))
            if not n:
                continue
            if total <= 0:
                total, since = 0.0, len(spans) - 1
            total += n * (linked if links else plain)
            if total > best:
                best, best_from, best_to = total, since, len(spans)
            continue
        score = weights.get(_tag(kind, name), other)
        if inside:  # what is set aside there interrupts nothing
            score = 0.0 if dropped else max(score, INSIDE)
        total += score
        if name == "a":
            links = 1 if kind == "open" else 0
        elif name == "br":
            spans.append((block, " "))
        if name in BLOCKS:
            block += 1
    if best_from is None:
        return ""
    lines: dict[int, list[str]] = {}
    for number, text in spans[best_from:best_to]:
        lines.setdefault(number, []).append(text)
    texts = (" ".join("".join(parts).split()) for parts in lines.values())
    return "\n".join(t for t in texts if t)


def fitted_weights(pages: DataFrame, labelled: int = LABELLED) -> dict[str, float]:
    """Weights from the labelled pages of at most ``labelled`` ids, those with the smallest hashes."""
    shown = F.regexp_replace(F.lower(F.col("html").cast("string")), r"(?s)<(script|style)\b.*?</\1\s*>|<!--.*?-->", "")
    articles = F.regexp_count(shown, F.lit(r"<article\b"))
    mains = F.regexp_count(shown, F.lit(r"<main\b"))
    good = pages.where((articles == 1) | ((articles == 0) & (mains == 1)))
    # Ids first, so that no task gathers pages; ``labelled`` numbers are broadcast.
    ids = sample_of(good.select("page_id").where("page_id is not null").distinct(), labelled, "page_id")
    sample = good.join(F.broadcast(ids), "page_id", "left_semi").select(F.col("html").cast("string").alias("html"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        within, without = kind_counts(p for batch in batches for p in batch["html"])
        kinds = sorted(set(within) | set(without))
        yield pd.DataFrame({"kind": kinds, "a": [within[k] for k in kinds], "b": [without[k] for k in kinds]}).astype({"kind": object})

    rows = sample.mapInPandas(count, "kind string, a long, b long").groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    return weights_of(Counter({r["kind"]: r["a"] for r in rows}), Counter({r["kind"]: r["b"] for r in rows}))


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row. Null or empty html, or a page without content: empty text, 0.

    Character references are decoded, raw white space inside a block becomes one space, blocks follow in page order. Null
    ids and urls stay null; repeated rows give repeated rows; other columns are ignored.
    """
    if weights is None:
        weights = fitted_weights(pages)

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in column], dtype=object)

    out = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text(F.col("html").cast("string")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
