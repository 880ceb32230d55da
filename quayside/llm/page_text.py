"""Main text of web pages.

Method. A page's markup gives blocks of three kinds: main (inside ``article`` or
``main``), frame (menus, headers, footers, asides, adverts, notices, forms,
reader comments and what stands beside the article) and open (the body's blocks
on a page that marks no article). The token streams of all blocks but the main
ones are taken together by host, and substrings of ``RUN`` tokens or more that
occur on two distinct pages of the host are found in the order of the host's
suffixes; what they cover is boilerplate, and of the open blocks the unique runs
stay.

Main blocks are never cut: pages of one host carry copies of whole articles, and
an advert may quote one, so removing what repeats would take articles away.

At scale. The suffix array of a host is data, not a task's array: a suffix is
keyed by its host and its first ``RUN`` tokens, so equal keys are the runs of
neighbours whose common prefix is long enough, and one aggregate (smallest and
largest page of a key, combined before the shuffle) tells which occur on two
pages. A host with a third of all pages is spread like any other. Only hashes
are shuffled; pages are read as often as it takes instead of being written.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.frames import in_slices
from quayside.llm.url_filter import host_and_path

RUN = 10
SLICE = 256
MAIN, FRAME, OPEN = "main", "frame", "open"

RAW = ("script", "style", "textarea", "title", "xmp")
# Left out with all they hold if they are closed; else their start tag alone is.
SKIPPED = frozenset("noscript template iframe svg object select button annotation "
                    "annotation-xml".split())
SINGLE = frozenset(("select", "button", "iframe", "noscript"))  # never within themselves
_RAW = "|".join(RAW)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + _RAW + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^>]*(?:>|\Z))",
    re.S | re.I)
WITHIN = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd "
                   "label mark q s samp small span strike strong sub sup time tt u var wbr "
                   "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo "
                   "mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
                   "msubsup msup mtext munder munderover".split()) | SKIPPED
SPACES = frozenset(("br", "td", "th"))
NESTED = frozenset("article main section div nav header footer aside form ul ol dl table figure head "
                   "body blockquote details fieldset dialog menu address center".split())
APART = frozenset(("nav", "footer", "aside", "form", "dialog", "menu", "head"))
APART_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form",
                         "alert", "dialog", "menu", "menubar"))
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr header menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo promoted related replies reply share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split())
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")
# Containers that an article ends if they were left open before it.
LEFT_OPEN = frozenset(("nav", "header", "form", "ul", "ol", "menu", "head"))


def _apart(name: str, rest: str, inside: bool) -> bool:
    """Whether an element and all it holds belong to the frame."""
    if name in APART or name == "header" and not inside:
        return True
    if "=" in rest and name not in ("body", "article", "main") or "comment" in rest:
        for what, a, b, c in _NAMED.findall(rest):
            value = (a or b or c).lower()
            if what.lower() == "role":
                if value in APART_ROLES:
                    return True
            elif not APART_WORDS.isdisjoint(_PARTS.split(value)):
                return True
    return False


def _skips(tokens: list[re.Match]) -> dict[int, int]:
    """Where each closed element of ``SKIPPED`` begins and ends. A self-closing tag
    opens none, and none reaches beyond the article or body that it is in."""
    open_: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for token in tokens:
        name = (token["name"] or "").lower()
        if name in SKIPPED:
            starts = open_.setdefault(name, [])
            if token["end"]:
                if starts:
                    out[starts.pop()] = token.end()
            elif not token["rest"].endswith("/>"):
                if name in SINGLE:
                    starts.clear()
                starts.append(token.start())
        elif token["end"] and name in ("article", "main", "body"):
            open_.clear()
    return out


def blocks(page: str | None) -> list[tuple[str, str]]:
    """``(kind, text)`` of a page's blocks, in order, none empty."""
    page = page or ""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, apart, article
    parts: list[str] = []
    apart = inside = 0
    seen = False

    def close():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((FRAME if apart else MAIN if inside else OPEN, text))

    at = 0
    tokens = list(TOKEN.finditer(page))
    skips = _skips(tokens)
    for token in tokens:
        if token.start() < at:
            continue
        if token.start() > at:
            parts.append(page[at:token.start()])
        at = skips.get(token.start(), token.end())
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if name in WITHIN:
            continue
        if name in SPACES:
            parts.append(" ")
            continue
        close()
        if name not in NESTED:
            continue
        if token["end"]:
            if any(x[0] == name for x in stack):
                while True:
                    was, a, b = stack.pop()
                    apart, inside = apart - a, inside - b
                    if was == name:
                        break
        elif not token["rest"].endswith("/>"):
            article = name in ("article", "main")
            if article:
                while stack and stack[-1][0] in LEFT_OPEN:
                    _, a, b = stack.pop()
                    apart, inside = apart - a, inside - b
            off = _apart(name, token["rest"], inside > 0)
            article = article and not off
            stack.append((name, off, article))
            apart, inside = apart + off, inside + article
            seen = seen or article and not apart
    if at < len(page):
        parts.append(page[at:])
    close()
    if seen:
        out = [(FRAME if kind == OPEN else kind, text) for kind, text in out]
    return out


def suffixes(host: str, found: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """``key, block, position`` of every suffix of ``RUN`` tokens or more in the
    blocks outside the main text; open blocks alone have a block number (frame:
    -1). A suffix doesn't cross blocks."""
    out = []
    for k, (kind, text) in enumerate(found):
        if kind != MAIN:
            words = text.split(" ")
            for p in range(len(words) - RUN + 1):
                key = xxhash.xxh3_64_intdigest(f"{host}\n{' '.join(words[p:p + RUN])}".encode(
                    "utf-8", "replace"))
                out.append((key - (1 << 63), k if kind == OPEN else -1, p))
    return out


def unique_runs(text: str, starts: list[int]) -> list[str]:
    """What repeated suffixes at ``starts`` leave of an open block."""
    words = text.split(" ")
    gone = bytearray(len(words))
    for p in starts:
        gone[p:p + RUN] = b"\1" * len(gone[p:p + RUN])
    out, run = [], []
    for word, g in zip(words, gone):
        if g and run:
            out.append(" ".join(run))
            run = []
        elif not g:
            run.append(word)
    return out + ([" ".join(run)] if run else [])


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    url = F.col(url_col).cast("string")
    host, _ = host_and_path(url)
    return pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"),
                        page.alias("html"), host.alias("host"),
                        F.xxhash64(F.col(id_col).cast("long"), url, page).alias("page"))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text``: the main text of every row of ``pages``.

    A null or empty page has an empty text, as has one without main text; a null
    url belongs to the empty host; null ids and urls stay null; repeated rows are
    returned as often as they occur and count as one page for what repeats; an
    empty table gives an empty table; other columns are ignored. Broken markup
    is read as far as it goes."""
    rows = _pages(pages, id_col, url_col, html_col)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in in_slices(SLICE)(batches):
            out = {(key, page) for page, host, text in zip(part["page"], part["host"], part["html"])
                   for key, _, _ in suffixes(host, blocks(text))}
            yield pd.DataFrame(sorted(out), columns=["key", "page"], dtype="int64")

    def open_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in in_slices(SLICE)(batches):
            out = [(key, page, block, p)
                   for page, host, text in zip(part["page"], part["host"], part["html"])
                   for key, block, p in suffixes(host, blocks(text)) if block >= 0]
            yield pd.DataFrame(out, columns=["key", "page", "block", "p"], dtype="int64")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in in_slices(SLICE)(batches):
            found = [[x for x in blocks(text) if x[0] != FRAME] for text in part["html"]]
            whole = [all(kind == MAIN for kind, _ in x) for x in found]
            yield pd.DataFrame({
                "page_id": part["page_id"], "url": part["url"],
                "text": ["\n".join(t for _, t in x) if w else None for x, w in zip(found, whole)],
                "html": [None if w else h for h, w in zip(part["html"], whole)],
                "page": part["page"].astype("Int64").mask(pd.Series(whole, part.index))})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in in_slices(SLICE)(batches):
            out = []
            for text, page, hits in zip(part["text"], part["html"], part["hits"]):
                if text is None:
                    starts: dict[int, list[int]] = {}
                    for hit in ([] if hits is None else hits):
                        starts.setdefault(hit["block"], []).append(hit["p"])
                    kept = []
                    for k, (kind, block) in enumerate(blocks(page)):
                        if kind == MAIN:
                            kept.append(block)
                        elif kind == OPEN:
                            kept += unique_runs(block, starts.get(k, []))
                    text = "\n".join(kept)
                out.append(text)
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": out})

    repeated = (rows.select("page", "host", "html").mapInPandas(keys, "key long, page long")
                .groupBy("key").agg(F.min("page").alias("a"), F.max("page").alias("b"))
                .where(F.col("a") != F.col("b")).select("key"))
    hits = (rows.select("page", "host", "html")
            .mapInPandas(open_keys, "key long, page long, block int, p int")
            .join(repeated, "key")
            .groupBy("page").agg(F.collect_set(F.struct("block", "p")).alias("hits")))
    found = rows.select("page_id", "url", "html", "page").mapInPandas(
        texts, "page_id long, url string, text string, html string, page long")
    # Pages whose text is settled have no key and are dealt out evenly.
    spread = F.coalesce("page", F.xxhash64("page_id", "text"))
    joined = (found.withColumn("_k", spread)
              .join(hits.select(F.col("page").alias("_k"), "hits"), "_k", "left")
              .select("page_id", "url", "text", "html",
                      F.when(F.col("page").isNotNull(), F.col("hits")).alias("hits")))
    return joined.mapInPandas(cut, "page_id long, url string, text string")
