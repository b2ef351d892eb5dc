"""HTTP fetches at the edge of the engine; queries read tables of pages instead."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

#: Names that requests go out under; a policy takes them in turn or at random.
AGENTS = tuple(f"Mozilla/5.0 ({system}) AlmanacBot/1.0" for system in ("X11; Linux x86_64", "Windows NT 10.0; Win64; x64", "Macintosh; Intel Mac OS X 14_0"))
_MOVED = (301, 302, 303, 307, 308)


@dataclass(frozen=True)
class Policy:
    """How often and how patiently a page is asked for.

    A delay is drawn evenly between its bounds before each request. Agents go
    round by the number of the request, or are drawn. After a redirect
    ``moved_attempts`` attempts are made at the new place; ``downgrade`` says
    whether one may lead from https to http, ``redirects`` how many are followed.
    """

    attempts: int = 1
    backoff_s: float = 0.0
    timeout_s: float = 12.0
    delay_s: tuple[float, float] = (0.0, 0.0)
    draw_agent: bool = False
    moved_attempts: int = 1
    redirects: int = 10_000
    downgrade: bool = True


#: The three extractors' policies.
POLICIES = {
    "v1": Policy(),
    "v15": Policy(attempts=3, backoff_s=0.2, timeout_s=15.0, moved_attempts=2),
    "v2": Policy(timeout_s=20.0, delay_s=(0.8, 2.2), draw_agent=True, redirects=5, downgrade=False),
}


class _Stay(urllib.request.HTTPRedirectHandler):
    """Redirects come back as answers."""

    def redirect_request(self, *args, **kwargs):
        return None


def delay(policy: Policy, draw: random.Random) -> float:
    """Seconds to wait before a request."""
    return draw.uniform(*policy.delay_s)


def agent(policy: Policy, number: int, draw: random.Random) -> str:
    """The name of the request of this number."""
    return draw.choice(AGENTS) if policy.draw_agent else AGENTS[number % len(AGENTS)]


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", "replace").replace("�", " ")


def fetch_one(url: str, policy: Policy, get: Callable | None = None, sleep: Callable = time.sleep, draw: random.Random | None = None, seed: int = 0) -> tuple[str | None, str, str]:
    """(body, status, final URL); status is ``bad_uri`` or ``error`` where there was no answer."""
    get, draw = get or urllib.request.build_opener(_Stay).open, draw or random.Random()
    moved, attempts, attempt = 0, policy.attempts, 0
    while True:
        if urlsplit(url).scheme.lower() not in ("http", "https"):
            return None, "error" if moved else "bad_uri", url
        if attempt >= attempts:
            return None, "error", url
        sleep(delay(policy, draw))
        headers = {"Accept": "text/html,application/xhtml+xml", "User-Agent": agent(policy, seed + attempt, draw)}
        try:
            try:
                answer = get(urllib.request.Request(url, headers=headers), timeout=policy.timeout_s)
            except urllib.error.HTTPError as e:
                answer = e
            with answer:
                code, to = int(answer.status), answer.headers.get("Location")
                body = _text(answer.read())
        except (OSError, ValueError):
            attempt += 1
            sleep(policy.backoff_s * attempt)
            continue
        to = urljoin(url, to) if to and code in _MOVED else None
        if to and moved < policy.redirects and (policy.downgrade or not (url.startswith("https:") and to.startswith("http:"))):
            url, moved, seed, attempts, attempt = to, moved + 1, seed + 1, policy.moved_attempts, 0
            continue
        return body, str(code), url


def fetch(urls: DataFrame, policy: Policy) -> DataFrame:
    """(url, body, status, final_url) of the column url; failures are rows, never errors."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            got = [(u, *fetch_one(u or "", policy)) for u in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.string()) for k in range(4)], names=["url", "body", "status", "final_url"])

    return urls.select("url").mapInArrow(run, "url string, body string, status string, final_url string")
