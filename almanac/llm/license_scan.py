"""License scans by an exact set-similarity join, on built-in functions only.

Text blocks are windows of ``BLOCK_WORDS`` words over the whole text, half
overlapping, so any notice of up to half as many words lies in one, however its
lines are broken. A template is found in a block that holds ``THRESHOLD`` of its
distinct words. All template words are put in one global order by their counts
over the whole corpus, rarest first. Then

* prefix: a block with the threshold holds one of a template's first
  ``size - needed + 1`` words in that order;
* length: it holds ``needed`` words of the vocabulary at least;
* position: behind their first common word both sets must have enough left.

What passes is verified by the sets' intersection. Fixed phrases are found
besides, wherever their words stand consecutively.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text
(letters beyond A-Z do not change a word's bounds or an ASCII phrase). Null and
empty texts have no words. Each row is judged for itself, so repeated rows and
null ids are kept as they are; columns other than doc_id and text are ignored.

The driver gets one count for each of the templates' words, and the join's small
side is the table of their prefixes: both are bounded by the templates. The only
shuffles are of counts and of the short result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words of well-known license notices, and their labels.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "copyright all rights reserved"),
]

THRESHOLD = 0.8
BLOCK_WORDS = 40
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a lower-cased text with one space between them."""
    return F.trim(F.regexp_replace(text, _GAP, " "))


def _count(spaced: Column) -> Column:
    """Words of a string in which each one has a space before and behind it."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" ")))) / 2).cast("long")


def token_counts(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Places of each vocabulary word over all documents; (w) is the only column read."""
    each = words.select(F.explode(F.split("w", " ")).alias("t")).where(F.col("t").isin(vocabulary))
    return {r["t"]: r["n"] for r in each.groupBy("t").agg(F.count("*").alias("n")).collect()}


def needed(size: int, percent: int) -> int:
    """Least number of a template's words that a block must hold."""
    return -(-size * percent // 100)


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    percent = round(100 * threshold)
    own = docs.select("doc_id", words_of(F.lower(F.coalesce("text", F.lit("")))).alias("w"))

    sets = [sorted(set(text.split())) for _, text in templates]
    vocabulary = sorted({t for s in sets for t in s})
    counts = token_counts(own.select("w"), vocabulary)
    rank = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (counts.get(t, 0), t)))}
    ordered = [sorted(s, key=rank.get) for s in sets]
    prefixes = [(t, k, i) for k, s in enumerate(ordered) for i, t in enumerate(s[: len(s) - needed(len(s), percent) + 1])]

    # the phrases, where a document holds them at all
    spaced = F.concat(F.lit(" "), F.replace("w", F.lit(" "), F.lit("  ")), F.lit(" "))
    own = own.select("doc_id", "w", F.when(F.col("w") == "", "").otherwise(spaced).alias("q"))
    n_words = _count(F.col("q"))
    first, last, places, base = [], [], [], []
    for phrase, label in phrases.items():
        inner = " " + phrase.replace(" ", "  ") + " "
        has = F.contains("q", F.lit(inner))
        pieces = F.split("q", inner)
        size = len(phrase.split())
        places.append(F.when(has, F.size(pieces).cast("long") - 1).otherwise(F.lit(0).cast("long")))
        first.append(F.when(has, _count(F.element_at(pieces, 1))))
        last.append(F.when(has, n_words - size - _count(F.element_at(pieces, -1))))
        base.append(F.when(has, F.lit(label)))
    total = places[0]
    for p in places[1:]:
        total = total + p
    least = F.least(*first) if len(first) > 1 else first[0]
    most = F.greatest(*last) if len(last) > 1 else last[0]

    # blocks of documents that hold some prefix word at all
    hopeful = F.lit(False)
    for t in sorted({t for t, _, _ in prefixes}, key=rank.get):
        hopeful = hopeful | F.contains("q", F.lit(f" {t} "))
    known = F.array(*[F.lit(t) for t in sorted(vocabulary, key=rank.get)])
    half, fewest = BLOCK_WORDS // 2, min(needed(len(s), percent) for s in ordered)
    full_enough = lambda x: F.size(x) >= fewest

    def windows(words: Column) -> Column:
        """Of each window its vocabulary words."""
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - half - 1, F.lit(0)), F.lit(half))
        return F.transform(starts, lambda i: F.filter(F.slice(words, i + 1, BLOCK_WORDS), lambda x: x.isin(vocabulary)))

    # an array of one, so that the text is split once and not for each window; of a block
    # only vocabulary words matter: in their global order, as the first argument has it
    held = F.filter(F.flatten(F.transform(F.array(F.split("w", " ")), windows)), full_enough)
    blocks = F.array_distinct(F.filter(F.transform(held, lambda x: F.array_intersect(known, x)), full_enough))
    scanned = own.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        n_words.alias("n_words"),
        total.alias("n_base"),
        least.alias("first_word"),
        most.alias("last_word"),
        F.array_compact(F.array(*base)).alias("base"),
        F.when(hopeful, blocks).alias("blocks"),
    )

    # (block, word, place) joined with (word, template, place), then verified
    table = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k"), F.lit(i).alias("i")) for t, k, i in prefixes])
    small = docs.sparkSession.range(1).select(F.explode(table).alias("p")).select("p.t", "p.k", "p.i")
    full = F.array(*[F.array(*[F.lit(t) for t in s]) for s in ordered])
    label = F.array(*[F.lit(name) for name, _ in templates])
    need = F.array(*[F.lit(needed(len(s), percent)) for s in ordered])
    # outer steps keep the documents without a candidate, so that the text is read once
    held = [c for c in scanned.columns if c != "blocks"]
    posted = scanned.select(*held, F.explode_outer("blocks").alias("block")).select(*held, "block", F.posexplode_outer("block").alias("j", "t"))
    near = posted.join(F.broadcast(small), "t", "left")
    at = F.col("k") + 1
    size = F.size(F.element_at(full, at))
    may = (F.size("block") >= F.element_at(need, at)) & (1 + F.least(size - 1 - F.col("i"), F.size("block") - 1 - F.col("j")) >= F.element_at(need, at))
    both = F.when(may, F.size(F.array_intersect(F.col("block"), F.element_at(full, at))))
    near = near.select(*held, "k", F.when(both >= F.element_at(need, at), both / size).alias("share"))
    out = near.groupBy(*held).agg(F.collect_set(F.when(F.col("share").isNotNull(), F.element_at(label, at))).alias("more"), F.max("share").alias("share"))
    labels = F.array_sort(F.array_distinct(F.concat("base", "more")))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.concat_ws(",", F.array_sort(F.array_distinct("base"))).alias("base_labels"),
        F.concat_ws(",", labels).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op1(spark, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
