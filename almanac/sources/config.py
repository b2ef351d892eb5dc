"""Run settings and run ids."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

_RUN_ID = re.compile(r"\d{4}-\d{2}-\d{2}(?:_\d{6})?")


@dataclass(frozen=True)
class CrawlConfig:
    """Settings of a bounded crawl."""

    run_id: str
    run_date: str | None = None
    source_catalog: str = "data/sources.yaml"
    output_root: str = "data/runs"
    max_depth: int = 2
    max_pages: int = 80
    min_delay_ms: int = 800
    max_delay_ms: int = 2200
    timeout_s: int = 20
    max_sources: int | None = None
    source_ids: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.max_depth < 0 or self.max_pages < 1 or not 0 <= self.min_delay_ms <= self.max_delay_ms:
            raise ValueError("depth, pages or delays out of range")
        if self.max_sources is not None and self.max_sources < 1:
            raise ValueError("max_sources must be positive")


def check_run_id(run_id: str) -> str:
    """The id, if it is YYYY-MM-DD or YYYY-MM-DD_HHMMSS."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"invalid run id: {run_id!r}")
    return run_id


def labelled_run_id(label: str | None, now: datetime) -> str:
    """label_timestamp, or the timestamp alone."""
    stamp = now.strftime("%Y-%m-%d_%H%M%S")
    return f"{label}_{stamp}" if label else stamp


def parse_options(args: list[str], now: datetime) -> CrawlConfig:
    """Settings of a command line of ``--name=value`` options.

    The first of equal options counts; without a runId it is the time of day, without
    a runDate the day. Unknown options are errors, and so are numbers that are none.
    """
    names = {
        "runId": ("run_id", str), "runDate": ("run_date", str), "sourceCatalog": ("source_catalog", str), "outputRoot": ("output_root", str),
        "maxDepth": ("max_depth", int), "maxPagesPerSource": ("max_pages", int), "minDelayMs": ("min_delay_ms", int), "maxDelayMs": ("max_delay_ms", int),
        "requestTimeoutSeconds": ("timeout_s", int), "maxSources": ("max_sources", int),
        "sourceIds": ("source_ids", lambda v: tuple(x.strip() for x in v.split(",") if x.strip())),
    }
    given: dict = {"run_id": now.strftime("%Y-%m-%d_%H%M%S"), "run_date": now.strftime("%Y-%m-%d")}
    seen = set()
    for arg in args:
        name, equals, value = arg.removeprefix("--").partition("=")
        if not arg.startswith("--") or not equals or name not in names:
            raise ValueError(f"unknown option: {arg!r}")
        if name not in seen:
            seen.add(name)
            field, kind = names[name]
            given[field] = kind(value)
    return CrawlConfig(**given)
