"""Upserts into long-lived catalogs: events by key, sources by URL."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from almanac.functions import dates as dt
from almanac.functions import rank, urls
from almanac.functions import text as tx
from almanac.operators import dedup
from almanac.operators.graph import components
from almanac.operators.lineage import checkpoint


def split_past(catalog: DataFrame, today) -> tuple[DataFrame, DataFrame]:
    """(active, past): a row is past if its date exists and lies before today."""
    day = dt.parse_or_null(F.col("date"))
    is_past = F.coalesce(day < F.lit(today).cast("date"), F.lit(False))
    return catalog.where(~is_past), catalog.where(is_past).withColumn("month", F.date_format(day, "yyyy-MM"))


def new_in_archive(past: DataFrame, archive: DataFrame) -> DataFrame:
    """Past rows whose key the archive of their month lacks; one a key."""
    own = dedup.key_columns(past)
    own = own.withColumn("rn", F.row_number().over(Window.partitionBy("month", *dedup.KEY).orderBy("pos"))).where("rn = 1").drop("rn")
    there = dedup.key_columns(archive).select("month", *dedup.KEY)
    return own.join(there, ["month", *dedup.KEY], "left_anti").drop(*dedup.KEY)


def upsert_events(active: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows merged into active ones of the same key, with flags added and changed.

    Of active rows that share a key only the last takes part; the others stay as
    they are. The first incoming row of a new key becomes its row.
    """
    own = dedup.key_columns(active).withColumns({"side": F.lit(0), "rn": F.row_number().over(Window.partitionBy(*dedup.KEY).orderBy(F.desc("pos")))})
    both = own.unionByName(dedup.key_columns(incoming).withColumns({"side": F.lit(1), "rn": F.lit(1)}))
    both = both.withColumn("prec", F.struct(F.col("side").alias("c"), F.col("pos").alias("p")))
    scalars = [F.min_by(c, F.col("prec")).alias(c) for c in ("id", "title", "date", "venue_name", "venue_city")]
    order = F.struct(rank.event_confidence(F.col("confidence")), -F.col("side"), -F.col("pos"))
    base = F.min_by(F.struct("confidence", "status", "source_urls", "categories", *dedup.OPTIONAL, "description"), F.col("prec"))
    merged = both.where("rn = 1").groupBy(*dedup.KEY).agg(
        *scalars,
        F.max_by("confidence", order).alias("confidence"),
        F.when(F.max(F.col("status") == "cancelled"), "cancelled").otherwise(F.min_by("status", F.col("prec"))).alias("status"),
        dedup.ordered_union("source_urls").alias("source_urls"),
        dedup.ordered_union("categories").alias("categories"),
        *[dedup.first_filled(c).alias(c) for c in dedup.OPTIONAL],
        dedup.longest("description").alias("description"),
        F.struct(F.min("side").alias("c"), F.min_by("pos", F.col("prec")).alias("p")).alias("at"),
        base.alias("base"),
        (F.min("side") == 1).alias("added"),
    )
    now = F.struct("confidence", "status", "source_urls", "categories", *dedup.OPTIONAL, "description")
    merged = merged.withColumn("changed", ~F.col("added") & ~now.eqNullSafe(F.col("base"))).drop("base", *dedup.KEY)
    rest = both.where("rn > 1").select(*[c for c in merged.columns if c not in ("at", "added", "changed")], F.struct(F.col("side").alias("c"), F.col("pos").alias("p")).alias("at"), F.lit(False).alias("added"), F.lit(False).alias("changed"))
    return merged.unionByName(rest)


def upsert_counters(result: DataFrame) -> DataFrame:
    """added, updated and unchanged rows."""
    added, changed = F.count_if("added"), F.count_if("changed")
    return result.agg(added.alias("added"), changed.alias("updated"), (F.count("*") - added - changed).alias("unchanged"))


def match_sources(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """(pos, match): for each incoming source the lowest known one at its first URL that is known."""
    index = known.select("pos", F.explode(urls.source_urls(F.col("homepage_url"), F.col("event_listing_urls"))).alias("url")).groupBy("url").agg(F.min("pos").alias("match"))
    own = incoming.select("pos", F.posexplode(urls.source_urls(F.col("homepage_url"), F.col("event_listing_urls"))).alias("at", "url"))
    return own.join(index, "url").groupBy("pos").agg(F.min_by("match", "at").alias("match"))


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Names of the fields that differ, sorted; nulls are equal."""
    marks = [F.when(~before[f].eqNullSafe(after[f]), f) for f in sorted(before)]
    return F.array_compact(F.array(*marks))


# Fields that a merge fills where they are empty.
_FILL = ["name", "source_type", "event_focus", "geo_coverage", "languages", "access_type", "crawl_frequency", "robots_txt_checked", "active"]
_UNITED = ("event_listing_urls", "genre_tags")
_RANK = {"low": 0, "medium": 1, "high": 2}
_BATCH = 4096


def _empty(v) -> bool:
    return v is None or (hasattr(v, "__len__") and len(v) == 0)


def _list(v) -> list:
    return [] if v is None else list(v)


class _Fold:
    """Sources linked by URLs, merged one after another; known ones (side 0) come first.

    An incoming source merges into the lowest-indexed holder of its first known
    URL, or starts a new row, which later ones may match. A row costs what it brings, however much its holder has.
    """

    def __init__(self) -> None:
        self.holders: dict[str, int] = {}
        self.out: list[dict] = []
        self.had: list[dict[str, dict]] = []

    def add(self, row: dict) -> None:
        norms = dict(zip([row["homepage_url"], *_list(row["event_listing_urls"])], row["norms"], strict=True))
        at = None if row["side"] == 0 else next((self.holders[u] for u in _list(row["urls"]) if u in self.holders), None)
        if at is None:
            at = len(self.out)
            self.out.append(row | {"changes": [], "is_new": bool(row["side"])})
            self.had.append({f: dict.fromkeys(x for x in _list(row[f]) if x is not None) for f in _UNITED})
            self._claim(at, norms.values())
            return
        own, had, changes, gained = self.out[at], self.had[at], [], []
        if _RANK.get(row["confidence"], -1) > _RANK.get(own["confidence"], -1):
            own["confidence"] = row["confidence"]
            changes.append("confidence")
        for f in _UNITED:
            more = [x for x in dict.fromkeys(_list(row[f])) if x is not None and x not in had[f]]
            if len(had[f]) + len(more) > len(_list(own[f])):
                if own[f] is None or len(own[f]) > len(had[f]):
                    own[f] = list(had[f])
                own[f].extend(more)
                had[f].update(dict.fromkeys(more))
                changes.append(f)
                gained += more if f == "event_listing_urls" else []
        if not str(own["homepage_url"] or "").strip() and str(row["homepage_url"] or "").strip():
            own["homepage_url"] = row["homepage_url"]
            changes.append("homepage_url")
            gained.append(row["homepage_url"])
        for f in _FILL:
            if f in row and row[f] is not None and _empty(own[f]):
                own[f] = row[f]
                changes.append(f)
        if changes:
            own["changes"].append(",".join(sorted(set(changes))))
        self._claim(at, (norms[u] for u in gained))

    def _claim(self, at: int, norms: Iterable[str | None]) -> None:
        for n in norms:
            if n is not None:
                self.holders.setdefault(n, at)


def _folded(schema: StructType):
    """A function of batches of rows sorted by component, side and pos: the rows of each component folded."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, fold, component = [], _Fold(), None
        for batch in batches:
            for row in batch.to_pylist():
                if row["component"] != component:
                    ready += fold.out
                    fold, component = _Fold(), row["component"]
                fold.add(row)
            if len(ready) >= _BATCH:
                yield pa.RecordBatch.from_pylist(ready, arrow)
                ready = []
        yield pa.RecordBatch.from_pylist(ready + fold.out, arrow)

    return run


def merge_sources(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """The known sources with the incoming ones merged in or added.

    Sources that share URLs, directly or through others, form a component; each
    is folded in input order, and ids of new rows get a suffix where taken. A source
    that shares none stays as it is.
    """
    both = known.withColumn("side", F.lit(0)).unionByName(incoming.withColumn("side", F.lit(1)))
    listings = F.coalesce("event_listing_urls", F.array().cast("array<string>"))
    both = both.withColumns({"urls": urls.source_urls(F.col("homepage_url"), F.col("event_listing_urls")), "norms": F.transform(F.concat(F.array("homepage_url"), listings), urls.identity), "node": F.concat_ws("/", "side", F.format_string("%012d", F.col("pos")))})
    edges = both.select("node", F.explode("urls").alias("url"))
    first = edges.groupBy("url").agg(F.min("node").alias("hub"))
    labels = components(edges.join(first, "url").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    rows = both.join(labels, "node", "left").withColumnRenamed("label", "component").drop("node")
    alone = rows.where("component IS NULL").withColumns({"changes": F.array().cast("array<string>"), "is_new": F.col("side") == 1})
    linked = rows.where("component IS NOT NULL").repartition("component").sortWithinPartitions("component", "side", "pos")
    schema = StructType([StructField(f.name, f.dataType) for f in alone.schema])
    folded = checkpoint(alone.unionByName(linked.mapInArrow(_folded(schema), schema)))
    return resolve_ids(folded).drop("component", "urls", "norms")


def resolve_ids(rows: DataFrame) -> DataFrame:
    """Ids of new rows that are taken get ``_new``, ``_new2``, ... in input order.

    A round gives each clashing row the next free suffix by its rank among rows
    of that id; rounds repeat only while a suffixed id clashes again.
    """
    rows = rows.withColumns({"wish": F.col("id"), "tries": F.lit(0)})
    while True:
        order = Window.partitionBy("id").orderBy("is_new", F.desc(F.col("tries") > 0), "pos")
        rows = rows.withColumn("rn", F.row_number().over(order))
        late = F.col("is_new") & (F.col("rn") > 1)
        if rows.where(late).isEmpty():
            return rows.drop("rn", "wish", "tries")
        tries = F.when(late, F.col("tries") + F.when(F.col("tries") == 0, F.col("rn") - 1).otherwise(1)).otherwise(F.col("tries"))
        rows = checkpoint(rows.withColumn("tries", tries).withColumn("id", F.when(F.col("tries") > 0, tx.with_suffix(F.col("wish"), F.col("tries"))).otherwise(F.col("id"))).drop("rn"))


def complete_fields(rows: DataFrame, required: dict[str, str]) -> DataFrame:
    """With every required column: missing lists are empty, other missing columns null."""
    for name, kind in required.items():
        if name not in rows.columns:
            value = F.array() if kind.startswith("array") and name in ("event_listing_urls", "languages") else F.lit(None)
            rows = rows.withColumn(name, value.cast(kind))
    return rows
