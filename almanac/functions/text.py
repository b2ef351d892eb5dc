"""String functions: normal forms, slugs, cleaning, truncation."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions import fixed

#: ASCII white space and NUL, which ``trim`` without an argument leaves.
BLANKS = " \t\n\r\f\x0b\x00"


def strip(c: Column) -> Column:
    """Without ASCII white space and NUL at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return strip(F.coalesce(c, F.lit(""))) == ""


def squeeze(c: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(c, r"\s+", " ")


def norm_key(c: Column) -> Column:
    """Lower case; all but letters, marks, digits and white space become spaces; squeezed and stripped."""
    return F.trim(squeeze(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{M}\p{Nd}\s]", " ")))


def norm_plain(c: Column) -> Column:
    """Lower case, squeezed, stripped; punctuation stays."""
    return squeeze(F.lower(strip(F.coalesce(c, F.lit("")))))


def _slug(c: Column, most: int, empty: str) -> Column:
    bare = F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(bare, 1, most), F.lit("")), F.lit(empty))


def slug(c: Column) -> Column:
    """ASCII slug of at most 80 characters; known accents lose their marks."""
    return _slug(F.translate(F.lower(F.coalesce(c, F.lit(""))), fixed.SLUG_FROM, fixed.SLUG_TO), 80, "x")


def slug_plain(c: Column) -> Column:
    """ASCII slug of at most 60 characters; accents become underscores."""
    return _slug(F.lower(F.coalesce(c, F.lit(""))), 60, "event")


def clean_html(c: Column) -> Column:
    """Text of an HTML fragment: no scripts, styles or tags; four entities decoded; squeezed."""
    for pattern, by in (
        (r"(?is)<script\b.*?</script>", " "),
        (r"(?is)<style\b.*?</style>", " "),
        (r"<[^>]+>", " "),
        (r"(?i)&nbsp;", " "),
        (r"(?i)&amp;", "&"),
        (r"(?i)&quot;", '"'),
        (r"(?i)&#39;|&apos;", "'"),
        (r"\s+", " "),
    ):
        c = F.regexp_replace(c, pattern, by)
    return F.trim(c)


def sentences(c: Column) -> Column:
    """Pieces that end in a full stop, exclamation or question mark before white space."""
    return F.filter(F.transform(F.split(c, r"(?<=[.!?])\s+"), strip), lambda x: x != "")


def cut(c: Column, most: int) -> Column:
    """The first characters."""
    return F.substring(c, 1, most)


def default(c: Column, other: Column) -> Column:
    """Stripped, or the other if that is empty."""
    return F.coalesce(F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit("")), other)


def scrub(binary: Column) -> Column:
    """Valid text of bytes; what is not UTF-8 becomes a space."""
    return F.translate(F.make_valid_utf8(binary.cast("string")), "�", " ")


def has_any(c: Column, tokens: list[str]) -> Column:
    """Whether the text holds one of the tokens, anywhere."""
    return functools.reduce(operator.or_, [F.contains(c, F.lit(t)) for t in tokens])


def once(c: Column, test: Callable[[Column], Column]) -> Column:
    """A test of a value that is made once, however often the test names it."""
    return F.exists(F.array(c), test)


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """A function of a value that is made once, however often the function names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def has_token(c: Column, tokens: list[str]) -> Column:
    """Whether the lower-cased text holds one of the tokens, anywhere."""
    return once(F.lower(c), lambda x: has_any(x, tokens))


def contains_similar(a: Column, b: Column, ratio: float = 0.6) -> Column:
    """The shorter is a non-empty part of the longer, and long enough."""
    swap = F.length(a) <= F.length(b)
    short, long = F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a)
    return (short != "") & F.contains(long, short) & (F.length(short) / F.length(long) >= ratio)


def escape_pipes(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def error_text(kind: Column, message: Column) -> Column:
    """``Kind: message``, with a word for a missing message."""
    return F.concat_ws(": ", kind, default(message, F.lit("no message")))


def with_suffix(base: Column, n: Column) -> Column:
    """The n-th spare name: ``_new``, ``_new2``, ..."""
    return F.concat(base, F.lit("_new"), F.when(n > 1, n.cast("string")).otherwise(""))
