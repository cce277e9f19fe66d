"""Main text of web pages by consensus of a host's pages.

Every page is parsed into blocks of text inside containers.  A container's
score is the share of the page's running text (link text counts against it)
that it holds, raised for article-like elements and slightly with depth.  Its
path of tags and generalised classes gets that score as a vote; the votes are
summed per host in Spark and the winning path is used to extract every page
of the host again.  A page that has no element on the winning path uses its
own best container.  A path is known by a hash chained from its parent's, and
of nested containers that hold the same text only the innermost and the
article-like ones vote, so deep nesting costs no more than its elements.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are left out, by element, role, or class name.  A
name counts if it is made of such words and of neutral ones alone
(``cookie-box``, not ``comments-open``), and an element left out by its name
alone is kept after all if hardly any text is found outside of such elements.

Defined results: a null or empty page has an empty text; a page without any
container is taken as a whole; a null url belongs to the empty host; ties
between paths go to the deeper, then to the smaller hash; repeated rows are pages each;
``br`` is white space; every table cell is a block; an empty
table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_side, stored

# Element and class names of HTML pages.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split())
CONTAINERS = frozenset("article body div main section td".split())
CLOSES_P = BLOCKS - {"body", "html", "option", "optgroup", "caption", "tbody", "tfoot", "thead", "tr"}
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav aside footer form head button select menu dialog object canvas audio video label fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
DROPPED_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu navbar nav navigation breadcrumb "
                          "breadcrumbs cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup share sharing social related "
                          "recommended comment comments disqus respond footer masthead pagination pager toolbar widget login search skip copyright".split())
#: Words that say nothing by themselves, in names of several words.
NEUTRAL_WORDS = frozenset("area articles bar block bottom box button buttons cell column container content count cta element entries entry feed field fixed form global group "
                          "header holder icon icons inner item items label law left link links list main mobile module more outer page panel policy post posts primary reader "
                          "readers reading region right row secondary section site slot space sticky stories text this thread title top unit user users view wrap wrapper zone".split())
GOOD_WORDS = frozenset("article articlebody content entry post story main body text".split())
#: An element that starts here closes an open one of its group.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+|\d+")

ARTICLE_BONUS, GOOD_BONUS, DEPTH_BONUS = 1.5, 1.25, 0.01
#: Containers below this share of a page's text cast no vote.
LEAST_SHARE = 0.2
#: Elements left out by name are kept if less than this share of the running text is outside of them.
LEAST_OUTSIDE = 0.02


def _bad_name(name: str) -> bool:
    """Whether a class or id names something to leave out: words for that, and neutral ones."""
    words = set(_WORDS.findall(name))
    return bool(words & DROPPED_WORDS) and all(w in DROPPED_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in words)


def _look(tag: str, attributes: str, inside_main: bool) -> tuple[bool, bool, str, float]:
    """``(left out, left out by name alone, step of the path, bonus)`` of an element."""
    dropped, named = tag in DROPPED or (tag == "header" and not inside_main), False
    bonus = ARTICLE_BONUS if tag in ("article", "main") else 1.0
    step = tag
    if attributes and not attributes.isspace():
        found = {}
        for name, *values in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), next((v for v in values if v), "").lower())
        names = [*found.get("class", "").split(), *found.get("id", "").split()]
        if tag not in ("body", "html", "main"):
            named = any(map(_bad_name, names))
        dropped |= found.get("role") in DROPPED_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
        if found.get("itemprop") == "articlebody":
            bonus = max(bonus, ARTICLE_BONUS)
        elif any(w in GOOD_WORDS for n in names for w in _WORDS.findall(n)):
            bonus = max(bonus, GOOD_BONUS)
        classes = sorted({re.sub(r"\d+", "#", c) for c in found.get("class", "").split()})
        step += "".join("." + c for c in classes)
    return dropped, named and not dropped, step, bonus


class Container(NamedTuple):
    """An element that holds blocks: its path's hash, how deep it lies, its parent's number, whether its name speaks against it."""

    path: str
    depth: int
    bonus: float
    parent: int
    named: bool


def parse(html: str):
    """``(containers, blocks)``: blocks as (container, text, link characters), without those that are left out."""
    containers, blocks = [Container("", 0, 1.0, -1, False)], []
    stack: list = []  # (tag, container before, dropped before, main before)
    opened: Counter = Counter()  # how often a tag is on the stack
    here, dropped, main, links = 0, False, False, 0
    piece: list = []
    linked = 0

    def flush():
        nonlocal linked
        if piece:
            text = " ".join(references.unescape("".join(piece)).split())
            if text:
                blocks.append((here, text, linked))
            piece.clear()
            linked = 0

    def close(depth: int):
        nonlocal here, dropped, main
        flush()
        _, here, dropped, main = stack[depth]
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at and not dropped:
            piece.append(html[at:stop])
            if links:
                linked += stop - at
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = over.end() if over else end
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br":
            piece.append(" ") if not dropped else None
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        block = tag in BLOCKS
        if not block and tag not in ("td", "th", "span") and tag not in DROPPED:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[depth][0] == tag:
                    if block:
                        close(depth)
                    else:
                        _, here, dropped, main = stack[depth]
                        opened.subtract(x[0] for x in stack[depth:])
                        del stack[depth:]
                    break
                if tag in ("span", "p") and stack[depth][0] in CONTAINERS:
                    break
            continue
        if tag in CLOSES_P and opened["p"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in CONTAINERS:
                    break
        if tag in SIBLINGS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in FENCES[tag]:
                    break
                if stack[depth][0] in SIBLINGS[tag]:
                    close(depth)
                    break
        if block:
            flush()
        out, named, step, bonus = _look(tag, m[3], main)
        stack.append((tag, here, dropped, main))
        opened[tag] += 1
        dropped = dropped or out
        if (tag in CONTAINERS or named) and not dropped:
            main = main or tag in ("article", "main")
            above = containers[here]
            path = hashlib.blake2b(f"{above.path}>{step}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
            containers.append(Container(path, above.depth + 1, bonus, here, named))
            here = len(containers) - 1
    flush()
    return containers, _without_named(containers, blocks)


def _without_named(containers: list[Container], blocks: list) -> list:
    """The blocks outside of containers whose name speaks against them; all, if these hold nearly everything."""
    if not any(c.named for c in containers):
        return blocks
    inside = [c.named for c in containers]
    for k in range(1, len(containers)):
        inside[k] = inside[k] or inside[containers[k].parent]
    running = [max(0, len(text) - 2 * linked) for _, text, linked in blocks]
    outside = sum(w for w, (c, _, _) in zip(running, blocks) if not inside[c])
    return blocks if outside < LEAST_OUTSIDE * sum(running) else [x for x in blocks if not inside[x[0]]]


def votes(html: str | None) -> list[tuple[str, int, float]]:
    """``(path, depth, score)`` of the page's containers, best first."""
    if not html:
        return []
    containers, blocks = parse(html)
    weight = [0] * len(containers)
    for c, text, linked in blocks:
        weight[c] += max(0, len(text) - 2 * linked)
    heir = [0] * len(containers)  # the most that one child holds
    for k in range(len(containers) - 1, 0, -1):  # parents come before their children
        above = containers[k].parent
        weight[above] += weight[k]
        heir[above] = max(heir[above], weight[k])
    if not weight[0]:
        return []
    score: dict = {}
    for c, w, most in zip(containers, weight, heir):
        if w >= LEAST_SHARE * weight[0] and (w > most or c.bonus > 1):
            key = c.path, c.depth
            score[key] = score.get(key, 0.0) + w / weight[0] * (c.bonus + DEPTH_BONUS * c.depth)
    return sorted(((p, d, s) for (p, d), s in score.items()), key=lambda x: (-x[2], -x[1], x[0]))


def extract(html: str | None, path: str | None) -> str:
    """The text of the elements on the path; of the page's own best container if there is none."""
    if not html:
        return ""
    containers, blocks = parse(html)
    inside = [c.path == path for c in containers]
    if not any(inside):
        own = votes(html)
        inside = [c.path == (own[0][0] if own else "") for c in containers]
    for k in range(1, len(containers)):
        inside[k] = inside[k] or inside[containers[k].parent]
    return "\n".join(text for c, text, _ in blocks if inside[c])


def extract_pages(pages: DataFrame, keep: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """``keep`` columns, ``text`` and the hash of the host's winning ``path``."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    names = [f"_k{i}" for i in range(len(keep))]
    src = pages.select(*[pages[c].alias(n) for c, n in zip(keep, names)], host.alias("_host"), F.col(html).cast("string").alias("_html"))

    def cast_votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(h, *v) for h, t in zip(b["_host"], b["_html"]) for v in votes(t)]
            yield pd.DataFrame(rows, columns=["_host", "path", "depth", "score"])

    cast = src.select("_host", "_html").mapInPandas(cast_votes, "_host string, path string, depth int, score double")
    sums = cast.groupBy("_host", "path", "depth").agg(F.sum(F.round("score", 6).cast("decimal(20,6)")).alias("score"))
    # one row per host: the best path by a plain aggregate, no group in one task
    best = sums.groupBy("_host").agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("depth")).alias("d"), "path")).alias("_best"))
    winners = stored(best.select("_host", F.col("_best.path").alias("path")), "host-paths")
    joined = src.join(small_side(winners), "_host", "left").drop("_host")
    types = dict(src.dtypes)

    def extract_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [extract(t, p) for t, p in zip(b["_html"], b["path"])]
            yield b.drop(columns="_html").assign(text=texts)

    out = joined.select(*names, "path", "_html").mapInPandas(extract_all, ", ".join(f"{n} {types[n]}" for n in names) + ", path string, text string")
    return out.withColumnsRenamed(dict(zip(names, keep)))


__all__ = ["parse", "votes", "extract", "extract_pages"]
