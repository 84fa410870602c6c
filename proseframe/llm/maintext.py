"""The main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proseframe.llm.batches import small_batches
from proseframe.llm.dom import BLOCK, HEADINGS, VOID, Page, attributes

# What is never the article, by element, role, and word of a class or id.
NOISE = frozenset(
    "script style noscript template head title nav footer aside form iframe object embed svg canvas button select textarea input datalist dialog menu search audio video map xmp noembed noframes".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies usercomments".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors promo promos promoted promotion banner"
    " menu menus submenu nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar sidebars rail masthead toolbar topbar skip"
    " cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations widget widgets copyright legal disclaimer search outbrain taboola".split()
)
EDGES = frozenset("header footer".split())
ARTICLES = frozenset("article main".split())
#: siblings of the chosen subtree that belong to it if they hold few links
PARTS = HEADINGS | frozenset("p ul ol li dl dt dd blockquote pre table figure".split())

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_noise(name: str, source: str, in_article: bool) -> int:
    """0: no; 1: unless it holds an article; 2: in any case."""
    if name in NOISE:
        return 1 if name == "form" else 2
    if name == "header":
        return 0 if in_article else 1
    if not source or name in ("html", "body"):
        return 0
    own = attributes(source)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(own.get("style", "")):
        return 2
    words = {w.lower() for key in ("class", "id", "itemtype", "itemprop") for w in _WORD.findall(own.get(key, ""))}
    if words & COMMENTS:
        return 2 if name in ARTICLES else 1
    if name in ARTICLES:
        return 0
    if own.get("role", "").lower() in ROLES or words & WORDS or (words & EDGES and not in_article):
        return 1
    return 0


def _kept(page: Page) -> list[bool]:
    """Which elements are outside of all noise."""
    names, parents, n = page.names, page.parents, len(page.names)
    inside, grade = [False] * n, [0] * n
    for i in range(1, n):
        inside[i] = inside[parents[i]] or names[parents[i]] in ARTICLES
        grade[i] = _is_noise(names[i], page.sources[i], inside[i])
    holds = [False] * n
    for i in range(n - 1, 0, -1):
        main = names[i] in ARTICLES or names[i] == "h1" and not inside[i]
        if grade[i] < 2 and (holds[i] or main and not grade[i]):
            # a page's header may hold a heading of its own; it is no article
            if names[i] != "header" or holds[i] and any(names[j] in ARTICLES for j in range(i + 1, n) if parents[j] == i):
                holds[parents[i]] = True
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[parents[i]] and (not grade[i] or grade[i] == 1 and holds[i] and names[i] != "header")
    return keep


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_ratio: float) -> float:
    """Characters per tag, less the more of them stand in links (Sun, Song and Liao, 2011)."""
    if not chars:
        return 0.0
    plain = max(chars - link_chars, 1)
    base = math.log(chars / plain * link_chars + page_ratio * chars + math.e)
    return max(0.0, chars / max(tags, 1) * math.log(chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1) + 1e-9) / math.log(base)) if base > 1 else chars / max(tags, 1)


def main_text(html: str | None) -> str:
    """The text of the page's article: blocks in page order, white space one space; "" if there is none."""
    if not html:
        return ""
    page = Page(html)
    names, parents, n = page.names, page.parents, len(page.names)
    keep = _kept(page)
    own = [0] * n
    for i, text in page.texts:
        if i >= 0 and keep[i]:
            own[i] += sum(map(len, text.split()))
    link = [False] * n
    for i in range(1, n):
        link[i] = link[parents[i]] or names[i] == "a"
    chars, tags, link_chars, link_tags = own[:], [0] * n, [own[i] if link[i] else 0 for i in range(n)], [0] * n
    for i in range(n - 1, 0, -1):
        if keep[i]:
            p = parents[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + (names[i] not in VOID)
            link_tags[p] += link_tags[i] + (names[i] == "a")
    body = next((i for i in range(n) if names[i] == "body"), 0)
    if not chars[body]:
        body = 0
    if not chars[body]:
        return ""
    ratio = link_chars[body] / chars[body]
    dense = [density(chars[i], tags[i], link_chars[i], link_tags[i], ratio) if keep[i] else 0.0 for i in range(n)]
    sums = [float(x) for x in own]  # a text of its own counts as a child of one tag
    for i in range(n - 1, 0, -1):
        if keep[i]:
            sums[parents[i]] += dense[i]
    best = list(range(n))  # of each subtree, the element with the greatest sum; ties: the first
    for i in range(n - 1, 0, -1):
        if keep[i] and sums[best[i]] >= sums[best[parents[i]]] and (best[parents[i]] != parents[i] or sums[best[i]] > sums[parents[i]]):
            best[parents[i]] = best[i]
    top = best[body]
    chosen = _chosen(page, keep, dense, best, body, top, chars, link_chars)
    pieces = [" " if i < 0 else text for i, text in page.texts if i < 0 or keep[i] and (chosen[i] or i == top)]
    return " ".join("".join(pieces).split())


def _chosen(page: Page, keep: list[bool], dense: list[float], best: list[int], body: int, top: int, chars: list[int], link_chars: list[int]) -> list[bool]:
    """Whether each element is in a chosen subtree."""
    names, parents, n = page.names, page.parents, len(page.names)
    path = [top]
    while path[-1] not in (body, 0):
        path.append(parents[path[-1]])
    threshold = min(dense[i] for i in path)
    chosen = [False] * n
    article = next((i for i in path if names[i] == "article"), None) or next((i for i in path if names[i] == "main"), None)
    if article:
        # the subtree is part of a marked article; pages of several articles keep the dense ones
        chosen[article] = True
        for i in range(1, n):
            chosen[i] |= names[i] == names[article] and keep[i] and dense[i] >= threshold
    else:
        # the body is never taken whole: if it is the main subtree, its texts and those parts of it that reach the threshold are
        for i in range(body + 1, n):
            if keep[i] and dense[i] >= threshold:
                chosen[best[i]] = True
        chosen[top] = top != body
        on_path = set(path) - ({body, 0} if top != body else set())
        for i in range(body + 1, n):
            few_links = 3 * link_chars[i] < chars[i] or names[i] == "h1"
            part = names[i] in PARTS or names[i] not in BLOCK and parents[i] == top
            if keep[i] and few_links and (part and parents[i] in on_path or names[i] == "h1" and parents[i] == body):
                chosen[i] = True
    for i in range(1, n):
        chosen[i] |= chosen[parents[i]]
    return chosen


def text_column(html: str | Column) -> Column:
    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(h) for h in pages], dtype=object)

    return extracted(html)


def with_main_text(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in a column ``name``.

    Elements that by name, role, class or id are menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles or reader comments are
    taken out. Of what remains each element gets its composite text density;
    the subtree with the greatest sum of its children's densities is the main
    one, and the least density on its path to the body is the threshold that
    other subtrees must reach. A subtree in an ``article`` (else ``main``)
    stands for the whole of it; else headings and paragraphs beside its path
    stay with it. The body itself is never taken whole.

    Character references are decoded, white space (also the no-break space)
    inside a block becomes one space, blocks are joined by one. Nothing else is
    dropped or cut: unclosed elements, comments and tags end as a browser would
    end them, except a tag without ">", which ends the page.

    Map only. A null or empty page, and one without text, gives ""; repeated
    rows stay as they stand; the other columns stay, one called ``name`` is
    replaced.
    """
    small_batches(pages.sparkSession)
    return pages.withColumn(name, text_column(html_col))
