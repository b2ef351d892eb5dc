"""URL functions; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanac.functions import text as tx


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def host(url: Column) -> Column:
    return F.lower(part(url, "HOST"))


def origin(url: Column) -> Column:
    """scheme://host, without port or path."""
    return F.concat(part(url, "PROTOCOL"), F.lit("://"), part(url, "HOST"))


def is_http(url: Column) -> Column:
    return F.coalesce(F.lower(part(url, "PROTOCOL")).isin("http", "https"), F.lit(False))


def identity(url: Column) -> Column:
    """Scheme and host in lower case and the path as it is; no port, query, fragment or last slashes.

    What has no scheme and host is lower-cased whole, less query and fragment.
    Nulls and blanks are null.
    """
    raw = tx.strip(url)
    # a port and user information belong to neither host nor path
    bare = F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]+)(?::\d*)?([^?#]*)", 0)
    pieces = [F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]+)(?::\d*)?([^?#]*)", k) for k in (1, 2, 3)]
    valid = (bare != "") & raw.rlike(r"^[\x21-\x7E]+$")
    known = F.concat(F.lower(pieces[0]), F.lit("://"), F.lower(pieces[1]), F.regexp_replace(pieces[2], "/+$", ""))
    other = F.regexp_replace(F.regexp_replace(F.lower(raw), r"[?#].*$", ""), "/+$", "")
    return F.when(tx.is_blank(url), F.lit(None)).when(valid, known).otherwise(other)


def trim_slash(url: Column) -> Column:
    """Stripped, without one last slash."""
    return F.regexp_replace(tx.strip(url), "/$", "")


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` steps; none leads above the root."""
    none = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(x == "..", up).when(x == ".", done).otherwise(F.concat(done, F.array(x)))

    def kept(steps: Column) -> Column:
        tail = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        return F.array_join(F.concat(F.aggregate(steps, none, step), tail), "/")

    dotted = F.contains(path, F.lit("/.")) | F.startswith(path, F.lit("."))
    return F.when(dotted, tx.let(F.split(path, "/"), kept)).otherwise(path)


def base_parts(base: Column) -> Column:
    """What references are resolved by: a URL itself, its scheme, place, path and query, and its folder."""
    names = ("scheme", "place", "path", "query")
    pieces = [F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?", k).alias(n) for k, n in enumerate(names, 1)]

    def whole(b: Column) -> Column:
        folder = tx.let(F.regexp_extract(b["path"], r"^(.*/)", 1), lambda x: F.when(x != "", x).when(b["place"] == "", "").otherwise("/"))
        return F.struct(base.alias("base"), *[b[n].alias(n) for n in names], folder.alias("folder"))

    return tx.let(F.struct(*pieces), whole)


def resolve_by(href: Column, b: Column) -> Column:
    """The absolute URL of a reference, by the parts of its base; null if either is null."""
    scheme, place = b["scheme"], b["place"]

    def of(h: Column, own: Column) -> Column:
        rest = F.when(own == h, "").otherwise(F.regexp_extract(h, r"^[^?#]*(.*)$", 1))
        return (
            F.when(h == "", b["base"])
            .when(F.contains(h, F.lit(":")) & h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(F.startswith(h, F.lit("//")), F.concat(scheme, h))
            .when(F.startswith(h, F.lit("#")), F.concat(scheme, place, b["path"], b["query"], rest))
            .when(own == "", F.concat(scheme, place, b["path"], rest))
            .otherwise(F.concat(scheme, place, tx.let(F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(b["folder"], own)), _without_dots), rest))
        )

    def bound(h: Column) -> Column:
        return tx.let(F.substring_index(F.substring_index(h, "?", 1), "#", 1), lambda own: of(h, own))

    return F.when(href.isNotNull() & b["base"].isNotNull(), tx.let(tx.strip(href), bound))


def resolve(href: Column | str, base: Column | str) -> Column:
    """The absolute URL of a reference; null if either is null."""
    href, base = (F.col(c) if isinstance(c, str) else c for c in (href, base))
    return tx.let(base_parts(base), lambda b: resolve_by(href, b))


def source_urls(homepage: Column, listings: Column) -> Column:
    """Identities of a source's URLs, homepage first, each once."""
    urls = F.concat(F.array(homepage), F.coalesce(listings, F.array().cast("array<string>")))
    return F.array_distinct(F.array_compact(F.transform(urls, identity)))
