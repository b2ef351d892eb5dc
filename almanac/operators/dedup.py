"""Event deduplication as one aggregation per key.

The merge of rows in input order has a closed form: under an order of precedence
a group's scalars come from its first row, arrays are ordered distinct unions,
optional fields the first that is not blank, the description the longest. The
plan is one shuffle on the key, with a window for the precedence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.functions import rank
from almanac.functions import text as tx
from almanac.functions.grams import containment_keys
from almanac.operators.lineage import checkpoint

OPTIONAL = ["time_start", "time_end", "ticket_url", "price"]


def key_columns(df: DataFrame) -> DataFrame:
    """With the key: normal title, date, normal venue."""
    return df.withColumns({"title_norm": tx.norm_key(F.col("title")), "date_key": F.coalesce(F.col("date").cast("string"), F.lit("")), "venue_norm": tx.norm_key(F.col("venue_name"))})


KEY = ["title_norm", "date_key", "venue_norm"]


def ordered_union(name: str) -> Column:
    """Arrays of a group in order of precedence, each value once; a group of one keeps its own."""
    rows = F.array_sort(F.collect_list(F.struct("prec", F.coalesce(F.col(name), F.array().cast("array<string>")).alias("v"))))
    return F.when(F.count(F.lit(1)) > 1, F.array_distinct(F.array_compact(F.flatten(F.transform(rows, lambda r: r["v"]))))).otherwise(F.min_by(name, F.col("prec")))


def first_filled(name: str) -> Column:
    """First value that is not blank; else the first row's."""
    own = F.when(~tx.is_blank(F.col(name)), F.struct("prec", F.col(name).alias("v")))
    return F.coalesce(F.min(own)["v"], F.min_by(name, F.col("prec")))


def longest(name: str, stripped: bool = True) -> Column:
    """The longest text, the first of equals."""
    measured = tx.strip(F.coalesce(F.col(name), F.lit(""))) if stripped else F.coalesce(F.col(name), F.lit(""))
    best = F.min_by(name, F.struct(-F.length(measured), F.col("prec")))
    return F.when(F.max(F.length(measured)) > 0, best).otherwise(F.min_by(name, F.col("prec")))


def by_confidence(df: DataFrame, keys: list[str]) -> DataFrame:
    """prec: rows that beat all before them in confidence, latest first; then the others as they came."""
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    own = rank.event_confidence(F.col("confidence"))
    record = own > F.coalesce(F.max(own).over(before), F.lit(-1))
    return df.withColumn("prec", F.struct(F.when(record, 0).otherwise(1).alias("c"), F.when(record, -F.col("pos")).otherwise(F.col("pos")).alias("p")))


def by_position(df: DataFrame) -> DataFrame:
    return df.withColumn("prec", F.struct(F.lit(0).alias("c"), F.col("pos").alias("p")))


def dedup_merge(df: DataFrame) -> DataFrame:
    """Rows of one key become one; a row of higher confidence becomes the base."""
    df = by_confidence(key_columns(df), KEY)
    scalars = [F.min_by(c, F.col("prec")).alias(c) for c in ("id", "title", "date", "venue_name", "venue_city", "status")]
    top = F.max_by("confidence", F.struct(rank.event_confidence(F.col("confidence")), -F.col("prec.c"), -F.col("prec.p"))).alias("confidence")
    return df.groupBy(*KEY).agg(
        *scalars, top, ordered_union("categories").alias("categories"), ordered_union("source_urls").alias("source_urls"),
        *[first_filled(c).alias(c) for c in OPTIONAL], longest("description").alias("description"), F.min("pos").alias("pos"), F.count("*").alias("n_merged"),
    )


def dedup_first(df: DataFrame) -> DataFrame:
    """Rows of one key become one; the first stays the base, and optional fields are its own."""
    df = by_position(key_columns(df))
    scalars = [F.min_by(c, F.col("prec")).alias(c) for c in ("id", "title", "date", "venue_name", "venue_city", "status", *OPTIONAL)]
    top = F.max_by("confidence", F.struct(rank.event_confidence(F.col("confidence")), -F.col("pos"))).alias("confidence")
    note = F.when(F.count("*") > 1, F.coalesce(longest("description", stripped=False), F.lit(""))).otherwise(F.min_by("description", F.col("prec")))
    return df.groupBy(*KEY).agg(*scalars, top, ordered_union("categories").alias("categories"), ordered_union("source_urls").alias("source_urls"), note.alias("description"), F.min("pos").alias("pos"), F.count("*").alias("n_merged"))


def dedup_by_signature(df: DataFrame, group: str = "source_id") -> DataFrame:
    """Per source: the first row of each plain signature, with the URLs of all."""
    df = by_position(df.withColumns({"t": tx.norm_plain(F.col("title")), "v": tx.norm_plain(F.col("venue_name"))}))
    keep = [c for c in df.columns if c not in (group, "t", "v", "date", "prec", "source_urls", "pos")]
    return df.groupBy(group, "t", "date", "v").agg(*[F.min_by(c, F.col("prec")).alias(c) for c in keep], ordered_union("source_urls").alias("source_urls"), F.min("pos").alias("pos")).drop("t", "v")


def _named(df: DataFrame) -> DataFrame:
    """With ``h``, the name of a row's title, date and venue: no shuffle carries titles to see that they are equal."""
    named = key_columns(df.select("pos", "title", "date", "venue_name")).select("pos", *KEY)
    # neither titles nor venues hold a line feed; a name that cannot be null is not made for a test of that before a join
    h = F.unhex(F.left(F.sha2(F.concat_ws("\n", "title_norm", "venue_norm", "date_key"), 256), F.lit(32)))
    return named.withColumn("h", F.coalesce(h, F.lit(bytearray())))


def _title_rows(df: DataFrame, percent: int) -> DataFrame:
    """(pos, h, size, own, parts, marks, seen) of rows with a title: its name, its length, the keys of its grams within its date and venue."""
    keyed = _named(df).withColumns({"size": F.length("title_norm"), "k": containment_keys(percent)("title_norm")})
    within = F.struct(F.xxhash64("date_key", "venue_norm").alias("block"), "k")
    keyed = keyed.select("pos", "h", "size", within.alias("w"))
    own, parts = F.xxhash64("w.block", "w.k.own"), F.transform("w.k.parts", lambda x: F.xxhash64("w.block", x))
    return checkpoint(keyed.select("pos", "h", "size", own.alias("own"), parts.alias("parts"), "w.k.marks", "w.k.seen")).where("size > 0")


def _title_links(df: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """(short, long): names of different titles of one date and venue, the one in the other and long enough.

    A title is posted under its smallest grams, and looks for titles inside it
    under those that a part of ``percent`` of it can have as smallest: a few each. First only names
    meet there; titles that met another are read again, sent to the keys where they did, and compared there if their
    marks agree. A title goes once to a key, however many it meets.
    """
    titles = rows.groupBy("h").agg(F.min("pos").alias("rep"), *[F.first(c).alias(c) for c in ("size", "own", "parts", "marks", "seen")])
    # the grams that a side is tested by: those of a posted title must be among those of the other
    sides = titles.select("h", "rep", "size", F.inline(F.array_append(F.transform("parts", lambda x: F.struct(x.alias("key"), F.lit(False).alias("posted"), F.col("seen").alias("marks"))), F.struct(F.col("own").alias("key"), F.lit(True).alias("posted"), "marks"))))
    name = F.xxhash64("h")
    keys = sides.groupBy("key").agg(F.min(name).alias("lo"), F.max(name).alias("hi"), F.max("posted").alias("posted")).where("posted AND lo != hi").select("key")
    kept = checkpoint(sides.join(keys, "key", "left_semi"))
    # rows that share a pos are told apart by their names
    read = _named(df.join(kept.select(F.col("rep").alias("pos")).distinct(), "pos", "left_semi"))
    texts = checkpoint(read.join(kept.select("h").distinct(), "h", "left_semi").dropDuplicates(["h"]).select("h", *KEY))
    sent = kept.join(texts, "h").select("key", "posted", "h", "size", "marks", *KEY)
    short, long = (sent.where(F.col("posted") == p).select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("h", "size", "marks", *KEY)]) for p, s in ((True, "s"), (False, "l")))
    fits = (F.col("size_s") < F.col("size_l")) & (F.col("size_s") / F.col("size_l") >= percent / 100) & F.forall("marks_s", lambda x: F.array_contains("marks_l", x))
    same = (F.col("date_key_s") == F.col("date_key_l")) & (F.col("venue_norm_s") == F.col("venue_norm_l"))
    links = short.join(long, "key").where(fits & same & F.contains("title_norm_l", "title_norm_s"))
    return checkpoint(links.select(F.col("h_s").alias("short"), F.col("h_l").alias("long")).distinct())


def near_pairs(df: DataFrame, percent: int = 60) -> DataFrame:
    """Pairs (left, right) of ids of one date and venue whose titles contain each other nearly, equal ones among them."""
    rows = _title_rows(df, percent)
    links = _title_links(df, rows, percent)
    one, other = rows.select("h", F.col("pos").alias("a")), rows.select("h", F.col("pos").alias("b"))
    equal = one.join(other, "h").where("a < b").select("a", "b")
    held = links.join(one.withColumnRenamed("h", "short"), "short").join(other.withColumnRenamed("h", "long"), "long").where("a != b")
    return equal.union(held.select(F.least("a", "b"), F.greatest("a", "b"))).toDF("left", "right")


def flag_near_dups(df: DataFrame, titles: DataFrame | None = None, percent: int = 60) -> DataFrame:
    """Both rows of such a pair drop to low confidence; no pair of equal titles is built.

    ``titles`` are the rows that may be paired, where these are had for less than all of ``df``.
    """
    titles = df if titles is None else titles
    rows = _title_rows(titles, percent)
    links = _title_links(titles, rows, percent)
    # a row is one of a pair if its own title, or one linked to it, has a row of another pos
    ends = rows.groupBy("h").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    both = links.toDF("h", "to").union(links.select("long", "short"))
    near = both.join(ends.withColumnRenamed("h", "to"), "to").select("h", "lo", "hi").union(ends).groupBy("h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    flagged = rows.select("h", "pos").join(near, "h").where("lo != pos OR hi != pos").select("pos", F.lit(True).alias("near")).distinct()
    return df.join(flagged, "pos", "left").withColumn("confidence", F.when(F.col("near"), "low").otherwise(F.col("confidence"))).select(*df.columns)


def merge_log(df: DataFrame) -> DataFrame:
    """(kept_id, merged_from): of each row that was merged, its id under the id of the base at that time."""
    df = by_confidence(key_columns(df), KEY)
    upto = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    base = F.last(F.when(F.col("prec.c") == 0, F.col("id")), ignorenulls=True)
    # a switch logs the old base and the new row itself under the new id; the latter is dropped as equal
    rows = df.select("id", "prec", base.over(before).alias("was"), base.over(upto).alias("now")).where("was IS NOT NULL")
    merged = rows.select(F.col("now").alias("kept_id"), F.when(F.col("prec.c") == 0, F.col("was")).otherwise(F.col("id")).alias("m"))
    return merged.where("m != kept_id").groupBy("kept_id").agg(F.array_sort(F.collect_set("m")).alias("merged_from"))
