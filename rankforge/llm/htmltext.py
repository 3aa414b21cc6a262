"""Main text of web pages by a maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive and tags negative, by
weights learned from labelled pages (those that mark their article), and one linear scan finds
the contiguous run with the largest sum: the content region. Inside page furniture (menus, footers, adverts, forms, comments, ...) nothing scores, and
its words are left out of the region's text.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_text

#: Labelled pages the weights are fitted on, at most about.
LABELLED = 20_000
#: Features that fewer labelled pages have take the default weights.
MIN_PAGES = 3
LIMIT = 4.0
#: Default weights of a word and a tag, and the least cost of any tag.
WORD, TAG, LEAST = 1.0, -0.25, -0.05

_RAW = "script|style|noscript|template|textarea|iframe|svg|canvas|select|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
                     "ruby s samp small span strike strong sub sup time tt u var wbr object math mfrac mi mn mo mover mroot mrow ms "
                     "msqrt msub msubsup msup mtext munder semantics").split())
#: Elements that only shape text; they hold no context of their own unless an attribute says so.
_PLAIN = _INLINE | frozenset("p li dt dd tr td th tbody thead h1 h2 h3 h4 h5 h6 blockquote pre".split())
_FURNITURE = frozenset("head nav footer aside form button fieldset dialog menu noscript input option".split())
_ARTICLE = frozenset(["article", "main"])
_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promoted promotion sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login social share sharing related "
    "recommended recommendations comment comments commentlist disqus reply replies widget pagination pager search skip "
    "complementary contentinfo dialog hidden").split())


#: Elements that hold the page or the article whatever their names say, and names of wrappers.
_HOLDERS = frozenset("html body article main".split())
_WRAPPERS = frozenset(("article body container content entry hentry layout main page post posts single site story text "
                       "wrap wrapper").split())


def _suspect(name: str, tokens: list[str]) -> bool:
    """Whether an element's names are those of furniture."""
    return name not in _HOLDERS and any(t in _WORDS for t in tokens)


def _attributes(attrs: str) -> tuple[list[str], str, bool]:
    """(name tokens of class, id and role; itemprop; whether it is not shown)."""
    tokens, prop, hidden = [], "", False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role"):
            tokens += [t for t in re.split(r"[^a-z]+", value) if t]
        elif key == "itemprop":
            prop = value
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return tokens, prop, hidden


@dataclass(slots=True)
class Item:
    """A text or a tag: ``context`` is the text's innermost element, ``dead`` whether it is page
    furniture, ``inside`` whether an element marks it as the article."""

    tag: str | None
    text: str
    context: str
    dead: bool
    inside: bool
    #: Enclosing elements that are furniture by their names, unless they hold most of the words.
    suspects: tuple[int, ...] = ()


@dataclass(slots=True)
class _Open:
    name: str
    context: str
    dead: bool
    inside: bool
    suspects: tuple[int, ...] = ()


def read(page: str) -> list[Item]:
    """The words and tags of a page in order; scripts, styles and remarks are dropped. Unclosed
    elements end with the element around them, stray end tags are ignored. An element that its
    names call both a wrapper and furniture (``post with-comments``) is no furniture if it holds
    more than half of the page's words."""
    items: list[Item] = []
    wrappers: list[bool] = []
    stack = [_Open("", "", False, False)]
    at = 0

    def text(upto: int) -> None:
        if upto > at:
            top = stack[-1]
            items.append(Item(None, page[at:upto], top.context, top.dead, top.inside, top.suspects))

    for m in _TOKEN.finditer(page):
        text(m.start())
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        top = stack[-1]
        items.append(Item(name, "", top.context, top.dead, top.inside, top.suspects))
        if m["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
            continue
        if name in _VOID or m["attrs"].endswith("/"):
            continue
        tokens, prop, hidden = _attributes(m["attrs"]) if m["attrs"] else ([], "", False)
        if name in _PLAIN and not tokens and not hidden and not prop:
            continue
        if name == "body":
            stack = stack[:1]
        article = name in _ARTICLE or prop == "articlebody"
        top = stack[-1]
        # A header of the article belongs to it, any other is furniture; an article opens anew
        # what an unclosed element before it would swallow.
        dead = hidden or name in _FURNITURE or (name == "header" and not top.inside)
        suspect = not article and _suspect(name, tokens)
        if article and not dead:
            top = stack[0] if (top.dead or top.suspects) and not top.inside else top
        suspects = top.suspects
        if suspect:
            suspects = (*suspects, len(wrappers))
            wrappers.append(any(t in _WRAPPERS for t in tokens))
        stack.append(_Open(name, ".".join([name, *sorted(set(tokens))]), dead or top.dead, article or top.inside, suspects))
    text(len(page))
    if wrappers:
        words, total = [0] * len(wrappers), 0
        if any(wrappers):
            for x in items:
                if x.tag is None and not x.dead:
                    n = len(x.text.split())
                    total += n
                    for i in x.suspects:
                        words[i] += n
        for x in items:
            x.dead = x.dead or any(not (wrappers[i] and 2 * words[i] > total) for i in x.suspects)
    return items


@dataclass
class Weights:
    """Scores of a word by its context and of a tag by context and name. Tags and words within
    furniture score nothing: a run may pass over an advert at the cost of the tag that opens
    it. What no labelled page has gets the default, a tag within an article the least cost."""

    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)

    def of(self, item: Item) -> float:
        if item.dead:
            return 0.0
        if item.tag is not None:
            return self.tag.get(f"{item.context}>{item.tag}", LEAST if item.inside else TAG)
        return self.word.get(item.context, WORD) * len(item.text.split())


def region(scores: list[float]) -> tuple[int, int]:
    """The first of the contiguous runs with the largest sum, as (start, end); (0, 0) if no
    sum is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, span = total, (start, i + 1)
    return span


def _join(items: list[Item]) -> str:
    """All words of the items but those in furniture, by blocks."""
    blocks, words = [], []
    for x in items:
        if x.tag is None:
            if not x.dead:
                words.append(x.text)
        elif x.tag not in _INLINE:
            blocks.append("".join(words))
            words = []
        elif x.tag == "br":
            words.append(" ")
    blocks.append("".join(words))
    texts = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def extract(page: str, weights: Weights) -> str:
    """The main text of a page. A page on which the learned weights find nothing is scored by
    the default ones."""
    items = read(page)
    for w in (weights, Weights()):
        a, b = region([w.of(x) for x in items])
        found = _join(items[a:b])
        if found:
            return found
    return ""


# ------------------------------------------------------------------ Spark
def _log_odds(inside: int, outside: int, all_in: int, all_out: int) -> float:
    value = math.log((inside + 1) / (all_in + 2)) - math.log((outside + 1) / (all_out + 2))
    return max(-LIMIT, min(LIMIT, value))


def learn(pages: DataFrame, html_col: str = "html", labelled: int = LABELLED) -> Weights:
    """Weights from about ``labelled`` pages that mark their article, chosen by a hash of the
    page: the log odds of a word's context (a tag's context and name) inside and outside of the
    marked part, furniture aside."""
    rows = pages.select(F.col(html_col).cast("string").alias("html")).where(
        F.lower("html").rlike("<(article|main)\\b|articlebody"))
    n = rows.count()
    share = min(1.0, labelled / max(n, 1))
    some = rows.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) <= int(share * (1 << 30)))

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[tuple[str, str], list[int]] = {}
            for page in part.column("html").to_pylist():
                seen = set()
                for x in read(page):
                    if x.dead:
                        continue
                    size = 1 if x.tag is not None else len(x.text.split())
                    if not size:
                        continue
                    key = ("tag", f"{x.context}>{x.tag}") if x.tag is not None else ("word", x.context)
                    c = counts.setdefault(key, [0, 0, 0])
                    c[0 if x.inside else 1] += size
                    seen.add(key)
                for key in seen:
                    counts[key][2] += 1
            kinds, names = zip(*counts) if counts else ((), ())
            columns = [pa.array(list(kinds), pa.string()), pa.array(list(names), pa.string())]
            columns += [pa.array([c[i] for c in counts.values()], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays(columns, ["kind", "name", "inside", "outside", "pages"])
        return one

    found = (map_text(some, "html", make, "kind string, name string, inside long, outside long, pages long")
             .groupBy("kind", "name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"),
                                          F.sum("pages").alias("pages")))
    # Features of a bounded sample of pages.
    rows = found.where(F.col("pages") >= MIN_PAGES).collect()
    weights = Weights()
    for kind in ("word", "tag"):
        mine = [r for r in rows if r["kind"] == kind]
        total = [sum(r[c] for r in mine) for c in ("inside", "outside")]
        for r in mine:
            value = _log_odds(r["inside"], r["outside"], *total)
            if kind == "tag":
                weights.tag[r["name"]] = min(value, LEAST)
            else:
                weights.word[r["name"]] = value
    return weights


def main_text(pages: DataFrame, weights: Weights | None = None, *, html_col: str = "html",
              text_col: str = "text") -> DataFrame:
    """``pages`` without the html, with ``text`` (empty if a page has none) and ``n_chars``,
    its code points.

    A null or empty html has no text; tags may be unclosed or cut off; all rows and other
    columns are kept (a column named like an added one is replaced); repeated rows give
    repeated rows; an empty table gives none; pages are read whole. Without ``weights`` they
    are learned from ``pages``.
    """
    w = weights or learn(pages, html_col)
    rest = pages.drop(text_col, "n_chars") if html_col != text_col else pages.drop("n_chars")

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [extract(p, w) if p else "" for p in part.column(html_col).to_pylist()]
            names = [n for n in part.schema.names if n != html_col]
            return pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [*names, text_col, "n_chars"])
        return one

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields if f.name != html_col]
    return map_text(rest, html_col, make, ", ".join([*fields, f"`{text_col}` string", "n_chars long"]))
