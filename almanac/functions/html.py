"""Fragments of HTML: links, headings, blocks. Regular expressions where the rule is one; a parser where it needs a tree."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from almanac.functions import fixed
from almanac.functions import text as tx

# Patterns of links and of embedded JSON-LD.
_ANCHOR = r"""(?is)<a\b[^>]*\bhref=["']([^"'#][^"']*)["'][^>]*>(.*?)</a>"""
JSON_LD = r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""

MOST_BLOCKS, MOST_EVENTS, BLOCK_CHARS, ENOUGH = 60, 30, 1200, 3


def links(html: Column) -> Column:
    """Array of (href, inner), in document order."""
    hrefs = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))
    inner = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(2))
    return F.transform(F.arrays_zip(hrefs.alias("href"), inner.alias("inner")), lambda x: F.struct(x["href"].alias("href"), x["inner"].alias("inner")))


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))


def json_ld_blobs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(JSON_LD), F.lit(1))


def heading(html: Column) -> Column:
    """Text of the first h1, else h2, ... h5, strong, else of the first anchor; null if all are empty."""
    tags = ["h1", "h2", "h3", "h4", "h5", "strong", "a"]

    def text(t: str, low: Column) -> Column:
        # a plain search tells sooner than the pattern that a tag is absent
        found = F.when(F.contains(low, F.lit(f"<{t}")), F.regexp_extract(html, rf"(?is)<{t}\b[^>]*>(.*?)</{t}>", 1))
        return tx.let(found, lambda x: F.when(x != "", tx.let(tx.clean_html(x), lambda y: F.nullif(y, F.lit("")))))

    return tx.let(F.lower(html), lambda low: F.coalesce(*[text(t, low) for t in tags]))


# Articles, and opening tags with a telling class, each with the characters after it.
_ARTICLE = r"(?is)<article\b[^>]*>(.*?)</article>"
_NAMES = "|".join(map(re.escape, fixed.CONTAINER_CLASSES))
_AFTER = [rf"""(?is)<{tag}\b[^>]*class=["'][^"']*(?:{_NAMES})[^"']*["'][^>]*>(?=(.{{0,{BLOCK_CHARS}}}))""" for tag in ("li", "section", "div")]


def blocks(html: Column) -> Column:
    """Fragments that may be one event each.

    Three articles or more are taken as they are. Fewer are kept, and list
    items, then sections, then boxes with a telling class follow, each as the
    characters after its tag, until there are three blocks.
    """
    def more(found: Column, patterns: list[str]) -> Column:
        if not patterns:
            return found
        wider = tx.let(F.concat(found, F.regexp_extract_all(html, F.lit(patterns[0]), F.lit(1))), lambda x: more(x, patterns[1:]))
        return F.when(F.size(found) >= ENOUGH, found).otherwise(wider)

    articles = F.regexp_extract_all(html, F.lit(_ARTICLE), F.lit(1))
    found = tx.let(articles, lambda a: F.when(F.size(a) >= ENOUGH, a).otherwise(F.slice(more(a, _AFTER), 1, MOST_BLOCKS)))
    return F.coalesce(found, F.array().cast("array<string>"))


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Picker(HTMLParser):
    """Text of elements that a rule picks, in the order they open."""

    def __init__(self, picks) -> None:
        super().__init__(convert_charrefs=True)
        self.picks, self.open, self.out = picks, [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            return
        at = None
        if self.picks(tag, {k: v or "" for k, v in attrs}):
            at = len(self.out)
            self.out.append([])
        self.open.append((tag, at))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, at in self.open:
            if at is not None:
                self.out[at].append(data)


def _is_card(tag: str, attrs: dict) -> bool:
    names = attrs.get("class", "").lower().split()
    return tag == "article" or "event" in names or "events-item" in names or "event" in attrs.get("itemtype", "").lower()


def _is_block(tag: str, attrs: dict) -> bool:
    return tag in ("h1", "h2", "h3", "p", "li")


def _texts(html: str | None, picks) -> list[str]:
    p = _Picker(picks)
    p.feed(html or "")
    p.close()
    return [" ".join("".join(x).split()) for x in p.out]


@F.pandas_udf(ArrayType(StringType()))
def cards(html: pd.Series) -> pd.Series:
    """Texts of articles and of elements that are marked as events."""
    return pd.Series([_texts(h, _is_card) for h in html], dtype="object")


@F.pandas_udf(ArrayType(StringType()))
def text_blocks(html: pd.Series) -> pd.Series:
    """Texts of headings, paragraphs and list items."""
    return pd.Series([_texts(h, _is_block) for h in html], dtype="object")
