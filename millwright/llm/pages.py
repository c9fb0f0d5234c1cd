"""Main text of web pages: templates deduced from token equivalence classes over the pages of a host.

A page is read once into tokens: its containers (by path) and its blocks of text (by path and words). A token's
occurrence vector, how often it stands on each page of the host, is carried as a sum of hashes, one per page, so
vectors are compared without being gathered. Tokens with equal vectors form a class. A class that holds a container
and enough different pages is part of the host's template; blocks of text in it are template text. What is left in
the slots outside menus, notices and other furniture is the page's main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.operators.sizing import fits
from millwright.session import materialize

MIN_PAGES = 8
BROADCAST_TOKENS = 100_000

#: Elements whose contents are no text, furniture by element, role and class or id, and block elements.
RAW = "script style template noscript textarea iframe svg math title select option object canvas video audio"
FURNITURE = "nav footer aside form head menu dialog button fieldset label datalist"
ROLES = "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form"
WORDS = (
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion comment comments "
    "commentlist disqus respond reply replies cookie cookies consent gdpr notice notices notification banner sidebar nav "
    "navbar navigation menu breadcrumb breadcrumbs footer share sharing social newsletter subscribe subscription signup "
    "login popup modal overlay related recommended recommendations widget toolbar pagination pager skip copyright alert "
    "masthead"
)
OUTER_WORDS = "header top bottom topbar"
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul"
)
CONTAINERS = (
    "html head body article main section div nav header footer aside form menu dialog fieldset ul ol dl table figure "
    "blockquote details button label datalist center"
)

_RAW, _FURNITURE, _ROLES = frozenset(RAW.split()), frozenset(FURNITURE.split()), frozenset(ROLES.split())
_WORDS, _OUTER = frozenset(WORDS.split()), frozenset(OUTER_WORDS.split())
_BLOCKS, _CONTAINERS = frozenset(BLOCKS.split()), frozenset(CONTAINERS.split())
_ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^"'>])*"""
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(RAW.split())})(?=[\s/>]){_ATTRIBUTES}>(?:.*?</\1\s*>|.*\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


#: How a container is furniture: not, by its role or names, by its element, or unseen.
_PLAIN, _NAMED, _ELEMENT, _UNSEEN = range(4)


def _furniture_names(names: str, inside: bool) -> bool:
    """Whether a class or id is a furniture word, or made of such words only: cookie-notice, but not related-work."""
    known = _WORDS if inside else _WORDS | _OUTER
    return any((parts := {x for x in _SPLIT.split(name) if x}) and parts <= known for name in names.split())


def _kind(tag: str, attributes: str, inside: bool) -> tuple[str, int]:
    """Name of a container in paths, and how it is furniture. ``inside``: it stands in an article or main part."""
    if tag in _FURNITURE or (tag == "header" and not inside):
        return tag, _UNSEEN if _HIDDEN.search(attributes) else _ELEMENT
    if not attributes or attributes.isspace():
        return tag, _PLAIN
    names, role = "", ""
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id"):
            names += " " + (a or b or c).lower()
        elif key == "role":
            role = (a or b or c).lower()
    name = f"{tag}.{'.'.join(names.split())}" if names else tag
    if tag in ("html", "body", "article", "main"):
        return name, _PLAIN
    if _HIDDEN.search(attributes):
        return name, _UNSEEN
    return name, _NAMED if role in _ROLES or _furniture_names(names, inside) else _PLAIN


def read_page(source: str) -> tuple[list[str], list[tuple[str, str, bool]]]:
    """Paths of all containers, and the blocks outside furniture: path, text, and whether in an article or main part.

    White space inside a block is one space; references are decoded. Elements left open or closed twice are borne.

    Furniture passes to what it holds, but not to a main part, nor to an article that the page has in no better place:
    an article in a container with furniture names counts if the page has text in no other article, one in an aside
    or the like if the page has no other article or main part with text.
    """
    paths, found_blocks, words = [], [], []
    # Open containers: tag, path, furniture (its own or inherited), inside an article or main part, inside an
    # article, and the furniture that the article stands in.
    stack = [("", "", _PLAIN, False, False, _PLAIN)]

    def flush() -> None:
        if words:
            if not stack[-1][2]:
                text = " ".join(html.unescape("".join(words)).split())
                if text:
                    found_blocks.append((stack[-1][1], text, *stack[-1][3:]))
            words.clear()

    at = 0
    for found in _TAG.finditer(source):
        if found.start() > at:
            words.append(source[at : found.start()])
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCKS or tag in _CONTAINERS:
            flush()
        elif tag == "br" or tag == "img":
            words.append(" ")
        if tag not in _CONTAINERS:
            continue
        if found[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if found[4].endswith("/"):
            continue
        if tag == "body":
            del stack[1:]
        _, path, bad, inside, in_article, within = stack[-1]
        name, furniture = _kind(tag, found[4], inside)
        path = f"{path}/{name}"
        paths.append(path)
        if bad != _UNSEEN and not in_article:
            if tag == "article":
                bad, within = _PLAIN, bad
            elif tag == "main":
                bad = _PLAIN
        stack.append((tag, path, max(bad, furniture), inside or tag in ("article", "main"), in_article or tag == "article", within))
    if at < len(source):
        words.append(source[at:])
    flush()
    clean = [b for b in found_blocks if b[4] == _PLAIN]
    counts = {_PLAIN: True, _NAMED: not any(b[3] for b in clean), _ELEMENT: not any(b[2] for b in clean)}
    return paths, [(path, text, inside) for path, text, inside, _, within in found_blocks if counts[within]]


def _token(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode()) - (1 << 63)


def page_tokens(source: str | None) -> list[dict]:
    """Every token of a page with its count, and whether it is a container."""
    paths, blocks = read_page(source or "")
    kinds = ((Counter(map(_token, paths)), True), (Counter(_token(path, text) for path, text, _ in blocks), False))
    return [{"token": t, "n": n, "container": c} for counts, c in kinds for t, n in counts.items()]


def page_blocks(source: str | None) -> list[dict]:
    """The blocks outside furniture in page order, each with its token."""
    return [{"token": _token(path, text), "text": text, "inside": inside} for path, text, inside in read_page(source or "")[1]]


def _read(make: Callable[[str | None], list[dict]], kind: str) -> Column:
    @F.pandas_udf(f"array<struct<{kind}>>")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([make(h) for h in batch], dtype=object)

    return read(F.col("html"))


def template_tokens(tokens: DataFrame) -> DataFrame:
    """(host, token): text tokens of valid classes. ``tokens``: host, page (hash of the page's contents), token, n, container.

    Pages with equal contents count once. A class is valid if it holds a container and at least MIN_PAGES pages.
    """
    vector = F.xxhash64("page", "n").cast("decimal(20,0)")
    each = tokens.distinct().groupBy("host", "token").agg(
        F.sum(vector).alias("vector"), F.count(F.lit(1)).alias("pages"), F.first("container").alias("container")
    )
    each = each.where(F.col("pages") >= MIN_PAGES)
    valid = each.where("container").select("host", "vector", "pages").distinct()
    return each.where("not container").join(valid, ["host", "vector", "pages"], "left_semi").select("host", "token")


def main_text(pages: DataFrame, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html; other columns are ignored).

    If a page has an article or main part, only its blocks count, else all blocks outside furniture. Template text of
    the host goes; blocks are joined by line breaks in page order. A null or empty page, or one without such a block,
    has an empty text. Repeated rows are all returned. A null url is a host of its own name; an empty table stays
    empty.

    Pages are read twice, for their tokens and for their blocks, so that no text is stored or shuffled on the way. The
    templates are broadcast if they have at most ``broadcast_tokens`` tokens in all, which is counted; beyond that each
    page gets only those of its own tokens that are in its host's template, so no template is ever gathered.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    named = pages.select("page_id", "url", host.alias("host"), F.xxhash64("html").alias("page"), "html")
    found = F.explode(_read(page_tokens, "token: long, n: int, container: boolean")).alias("t")
    tokens = materialize(named.select("host", "page", found).select("host", "page", "t.*"))
    template = materialize(template_tokens(tokens))
    if fits(template, broadcast_tokens):
        joined = named.join(F.broadcast(template.groupBy("host").agg(F.collect_set("token").alias("template"))), "host", "left")
    else:
        own = tokens.where("not container").join(template, ["host", "token"], "left_semi")
        joined = named.join(own.groupBy("host", "page").agg(F.collect_set("token").alias("template")), ["host", "page"], "left")
    known = F.coalesce("template", F.array().cast("array<long>"))
    some = F.exists("blocks", lambda b: b["inside"])
    kept = F.filter("blocks", lambda b: (b["inside"] | ~some) & ~F.array_contains(known, b["token"]))
    blocks = _read(page_blocks, "token: long, text: string, inside: boolean").alias("blocks")
    return joined.select("page_id", "url", "template", blocks).select("page_id", "url", F.concat_ws("\n", F.transform(kept, lambda b: b["text"])).alias("text"))
