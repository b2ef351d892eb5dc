"""Columns that an operator adds, beside those that the documents have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def plus(schema: StructType, more: str) -> StructType:
    """The schema with more columns, given as ``name type, ...``."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def _aside(columns: list[str], those: Callable[[str], bool]) -> dict[str, str]:
    """New names, which no column has, for the columns to put aside."""
    own = "__own"
    while any(c.lower().startswith(own) for c in columns):
        own += "_"
    return {c: f"{own}{k}" for k, c in enumerate(columns) if those(c)}


def keeping(docs: DataFrame, taken: tuple[str, ...], f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``f`` of the documents, with the documents' columns and no others.

    Columns of the documents whose names ``f`` uses for its own are put aside
    under other names, and come back as they were; so do names with a dot, which
    Arrow functions cannot take.
    """
    aside = _aside(docs.columns, lambda c: c.lower() in taken or "." in c)
    out = f(docs.withColumnsRenamed(aside))
    return out.drop(*[c for c in taken if c not in aside.values()]).withColumnsRenamed({v: k for k, v in aside.items()}).select(*[f"`{c}`" for c in docs.columns])


def adding(docs: DataFrame, added: tuple[str, ...], f: Callable[[DataFrame], DataFrame], used: tuple[str, ...] = ()) -> DataFrame:
    """``f`` of the documents without columns of the ``added`` names.

    Names with a dot, and those that ``f`` has used for columns of its own, are put aside and come back.
    """
    docs = docs.drop(*added)
    aside = _aside(docs.columns, lambda c: "." in c or c.lower() in used)
    return f(docs.withColumnsRenamed(aside)).withColumnsRenamed({v: k for k, v in aside.items()})
