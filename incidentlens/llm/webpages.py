"""Main text of web pages: maximum-scoring subsequence over words and tags.

A page becomes a row of tokens, words and tags. Words score by where they stand (the element
and class around them), tags by their name; the weights are log odds learned from labelled
pages, so words of articles score positive and tags negative. One linear scan finds the
contiguous region with the largest sum. Elements that are never article text (scripts, forms,
menus, side notes, adverts, comments and the like) are left out of it; nothing in them is a token,
so they neither end a region nor teach a weight.

Labelled pages are those that mark their own content with an ``article`` or ``main`` element;
the element itself gives the label and is no feature.

Defined results: a NULL or empty page, or one without words, has an empty text; unclosed tags
and quotes are read leniently; repeated rows are treated alike; an empty table gives an empty
result; input columns named like an output are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table, without

#: Weights are learned from at most this many labelled pages (smallest hash of the id first).
MAX_LABELLED = 2000
#: At most this many features (most frequent first) have a weight of their own.
MAX_FEATURES = 5000
OUTPUT = ("text", "n_chars")

# Element names and class words.
RAW = frozenset("script style noscript template textarea iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
NEVER = RAW | frozenset("head title nav header footer aside form button select option menu dialog svg canvas object audio "
                        "video map fieldset label".split())
NEVER_CLASS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie "
                        "cookies consent footer header menu modal nav navbar navigation newsletter notice notices pagination "
                        "popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget "
                        "masthead colophon disqus respond".split())
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CONTENT = frozenset(("article", "main"))
#: A class name that begins so speaks of the page around it (has-sidebar, no-ads), not of the element itself.
ABOUT = frozenset("has have no not with without is js show hide".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>
    |</?[a-zA-Z](?:"[^"]*"|'[^']*'|[^'">])*>|</?[a-zA-Z][^>]*>|[^<]+|<""", re.S | re.X)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>/=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CONTENT_START = re.compile(r"<(?:article|main)\b", re.I)


def _tokens(source: str):
    """(token, end) of a page, in one pass. Behind the last ``>`` no tag can end, so all there is text, up to an open comment."""
    last = source.rfind(">") + 1
    token, end = "", 0
    for m in _TOKEN.finditer(source, 0, last):
        token, end = m[0], m.end()
        yield token, end
    if (token.startswith("<!--") and not token.endswith("-->")) or (token.startswith("<![CDATA[") and not token.endswith("]]>")):
        return
    rest = source[last:]
    for mark in ("<!--", "<![CDATA["):
        rest = rest.partition(mark)[0]
    if rest:
        yield "<" if rest == "<" else " " + rest if rest[0] == "<" else rest, len(source)


def _marks(name: str, token: str) -> tuple[str | None, bool]:
    """What speaks against an element (a word of its class, id or role), and whether it is a class or id."""
    found = []
    for kind, a, b, c in _MARKS.findall(token):
        for whole in (a or b or c).lower().split():
            words = [w for w in _SPLIT.split(whole) if w]
            if kind.lower() == "role":
                found += [w for w in words if w in NEVER_ROLE or w in NEVER_CLASS]
            elif words and words[0] not in ABOUT and not (words[-1] == "header" and words[0] in ("entry", "article", "post")):
                found += [w for w in words if w in NEVER_CLASS]
    return (min(found), True) if found else (None, False)


class Page:
    """Tokens of a page outside the elements that are never text: ``features`` (name, number of words:
    0 for a tag) and, beside each, the block it belongs to (or -1) and whether it lies in the page's own content element."""

    def __init__(self, source: str):
        self.features: list[tuple[str, int]] = []
        self.block: list[int] = []
        self.inside: list[bool] = []
        self.parts: list[list[str]] = [[]]
        self.labelled = False
        # element, never text, name for features, and the number of dropped elements around it that its start set aside
        stack: list[tuple[str, bool, str, int]] = []
        open_: Counter = Counter()
        never = content = by_class = 0  # by_class: elements around that are dropped for a class only
        only = len(_CONTENT_START.findall(source)) == 1
        skip_to = 0

        def leave() -> str:
            nonlocal never, content, by_class
            gone, dropped, _, aside = stack.pop()
            open_[gone] -= 1
            never += aside - bool(dropped)
            by_class += aside - (dropped == 2)
            content -= gone in CONTENT
            return gone

        for token, token_end in _tokens(source):
            if token_end <= skip_to:
                continue
            if token[0] != "<" or token == "<":
                if never:
                    continue
                self.parts[-1].append(token)
                words = len(token.split())
                if words:
                    self._add("w:" + (stack[-1][2] if stack else ""), words, len(self.parts) - 1, content > 0)
                continue
            if token.startswith("<!--") or token[1] in "!?":
                continue
            name = _NAME.match(token)[1].lower()
            if token[1] == "/":
                if name not in INLINE:
                    self._break()
                if not never:
                    self._add("t:/" + name, 0, -1, content > 0)
                if open_[name]:
                    while leave() != name:
                        pass
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, token_end)
                skip_to = end.end() if end else len(source)
                continue
            if name == "br":
                if not never:
                    self.parts[-1].append(" ")
                    self._add("t:br", 0, -1, content > 0)
                continue
            if name not in INLINE:
                self._break()
            if name in CLOSES_P or name == "li":  # an open paragraph or item ends where the next begins
                while stack and (stack[-1][0] in INLINE or stack[-1][0] == ("li" if name == "li" else "p")):
                    if leave() in ("p", "li"):
                        break
            bad, _ = _marks(name, token)
            # 1: by name or hidden, 2: for a class; a header inside the article holds its headline
            hard = (name in NEVER and not (name == "header" and content)) or bool(_HIDDEN.search(token))
            drop = 1 if hard else 2 if bad and name not in CONTENT and name != "body" else 0
            shown = name + ("." + bad if bad else "")
            aside = 0
            if name in CONTENT:
                if only and not bad and never == by_class:  # a wrapper's class does not drop the page's one article
                    aside, never, by_class = by_class, 0, 0
                self.labelled = True
                content += 1
            elif not (never or drop):
                self._add("t:" + shown, 0, -1, content > 0)
            if name not in VOID and not token.endswith("/>"):
                inner = stack[-1][2] if stack and name in INLINE and not bad else shown
                stack.append((name, drop, inner, aside))
                open_[name] += 1
                never += bool(drop)
                by_class += drop == 2
            elif name in CONTENT:
                content -= 1
                never, by_class = never + aside, by_class + aside

    def _add(self, feature: str, words: int, block: int, inside: bool) -> None:
        self.features.append((feature, words))
        self.block.append(block)
        self.inside.append(inside)

    def _break(self) -> None:
        if self.parts[-1]:
            self.parts.append([])

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and last token of the best region: running sums, restarted when they fall below zero."""
        best, total, start, found = 0.0, 0.0, 0, (0, -1)
        other_word, other_tag = weights.get("w:", 1.0), weights.get("t:", -1.0)
        for k, (feature, words) in enumerate(self.features):
            total += weights.get(feature, other_word) * words if words else weights.get(feature, other_tag)
            if total <= 0:
                total, start = 0.0, k + 1
            elif total > best:
                best, found = total, (start, k)
        return found

    def text(self, weights: dict[str, float]) -> str:
        first, last = self.region(weights)
        kept = {b for b in self.block[first:last + 1] if b >= 0}
        lines = (" ".join(entities.unescape("".join(self.parts[b])).split()) for b in sorted(kept))
        return "\n".join(x for x in lines if x)


def main_text(source: str | None, weights: dict[str, float]) -> str:
    return Page(source).text(weights) if source else ""


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Log odds of each token feature (in against out of the marked content) over labelled pages."""
    labelled = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    ids = labelled.select("page_id", F.xxhash64("page_id").alias("h")).distinct().orderBy("h", "page_id").limit(MAX_LABELLED)
    sample = labelled.join(F.broadcast(ids.select("page_id")), "page_id", "left_semi").select("html")

    def count(batches):
        for batch in slices(batches):
            seen: dict[str, list[int]] = {}
            for source in batch.column(0).to_pylist():
                page = Page(source)
                if page.labelled:
                    for (feature, words), inside in zip(page.features, page.inside):
                        cell = seen.setdefault(feature, [0, 0])
                        cell[inside] += words or 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([c[1] for c in seen.values()], pa.int64()),
                 pa.array([c[0] for c in seen.values()], pa.int64())], names=["feature", "n_in", "n_out"])

    rows = (sample.mapInArrow(count, "feature string, n_in long, n_out long").groupBy("feature")
            .agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
            .orderBy((F.col("n_in") + F.col("n_out")).desc(), "feature").limit(MAX_FEATURES).collect())
    weights = {"w:": 1.0, "t:": -1.0}
    for r in rows:
        odds = math.log((r["n_in"] + 0.5) / (r["n_out"] + 0.5))
        if r["feature"].startswith("t:"):  # tags never speak for content
            odds = min(odds, -0.05)
        weights[r["feature"]] = max(-6.0, min(2.0, odds))
    return weights


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, html, ...) without the html, with ``text`` and ``n_chars``."""
    pages = without(pages, *OUTPUT)
    weights = learn_weights(pages)
    kept = [f for f in pages.schema.fields if f.name != "html"]
    schema = T.StructType([*kept, T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])
    places = [k for k, f in enumerate(pages.schema.fields) if f.name != "html"]
    at_html = [f.name for f in pages.schema.fields].index("html")

    def run(batches):
        for batch in slices(batches):
            texts = [main_text(s, weights) for s in batch.column(at_html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in places], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return pages.mapInArrow(run, schema)


def op2_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
