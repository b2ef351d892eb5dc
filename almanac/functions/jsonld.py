"""Events in JSON-LD. Trees of any depth need a walk, so blobs go to Python in Arrow batches."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

FIELDS = ArrayType(StructType([StructField(n, StringType()) for n in ("name", "start", "place", "url", "description")]))


def _text(v) -> str | None:
    if v is None or isinstance(v, str):
        return v
    return ("true" if v else "false") if isinstance(v, bool) else json.dumps(v) if isinstance(v, (dict, list)) else str(v)


def events_in(tree) -> list[dict]:
    """Objects of type ``event``, in order; under a graph only the graph is searched."""
    found, todo = [], [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, list):
            todo.extend(reversed(node))
        elif isinstance(node, dict):
            kind = node.get("@type")
            if any(str(k).lower() == "event" for k in (kind if isinstance(kind, list) else [kind])):
                found.append(node)
            todo.extend([node["@graph"]] if "@graph" in node else reversed(list(node.values())))
    return found


def _row(node: dict) -> dict:
    place = node.get("location")
    return {
        "name": _text(node.get("name")),
        "start": _text(node.get("startDate")),
        "place": _text(place.get("name")) if isinstance(place, dict) else "",
        "url": _text(node.get("url")),
        "description": _text(node.get("description")),
    }


@F.pandas_udf(FIELDS)
def events(blob: pd.Series) -> pd.Series:
    """Events of each blob; none if it is no JSON, or nested deeper than the parser goes."""
    out = []
    for b in blob:
        try:
            out.append([_row(n) for n in events_in(json.loads(b))] if b else [])
        except (ValueError, RecursionError):
            out.append([])
    return pd.Series(out, dtype="object")
