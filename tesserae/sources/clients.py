"""External services behind small interfaces, with deterministic stubs; retries and timeouts are the caller's parameters."""

from __future__ import annotations

import hashlib
import time
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as FutureTimeout
from collections.abc import Callable, Iterator
from typing import Protocol, TypeVar

import pandas as pd
from pyspark.sql import DataFrame


class ModelClient(Protocol):
    def complete(self, messages: list[dict[str, str]]) -> str | None: ...


class SearchClient(Protocol):
    def search(self, query: str, count: int) -> list[str]: ...


class PageClient(Protocol):
    def fetch(self, key: str) -> str | None: ...


T = TypeVar("T")
# Seconds that one call of each kind may take.
MODEL_SECONDS, SEARCH_SECONDS, FETCH_SECONDS = 100.0, 10.0, 15.0


class StubModel:
    """Answers with a digest of the last message, so runs are repeatable."""

    def complete(self, messages: list[dict[str, str]]) -> str | None:
        return "stub-" + hashlib.sha256(messages[-1]["content"].encode()).hexdigest()[:12]


class StubSearch:
    def search(self, query: str, count: int) -> list[str]:
        h = hashlib.sha256(query.encode()).hexdigest()
        return [f"https://stub.example/{h[:8]}/{i}" for i in range(count)]


class StubPages:
    def __init__(self, pages: dict[str, str] | None = None) -> None:
        self.pages = pages or {}

    def fetch(self, key: str) -> str | None:
        return self.pages.get(key)


def timed(call: Callable[[], T], seconds: float | None) -> T:
    """The result of a call, or TimeoutError after so many seconds; its thread is left to end by itself."""
    if seconds is None:
        return call()
    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(call).result(timeout=seconds)
    except FutureTimeout:
        raise TimeoutError(f"no result in {seconds} s") from None
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def with_retries(call: Callable[[], T | None], tries: int = 3, wait: float = 0.0, seconds: float | None = None) -> T | None:
    """The first result that isn't null; null after so many failures. The wait doubles with every failure; seconds is the
    time that one call has."""
    for i in range(tries):
        try:
            out = timed(call, seconds)
        except Exception:  # noqa: BLE001
            out = None
        if out is not None:
            return out
        if wait and i + 1 < tries:
            time.sleep(wait * 2**i)
    return None


class Pace:
    """At most so many calls a second from one task."""

    def __init__(self, per_second: float | None) -> None:
        self.gap, self.next = 1.0 / per_second if per_second else 0.0, 0.0

    def wait(self) -> None:
        now = time.monotonic()
        if self.next > now:
            time.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


def first_provider(clients: list[SearchClient], query: str, count: int = 10, seconds: float | None = SEARCH_SECONDS) -> list[str]:
    """Results of the first provider that has any in time."""
    for c in clients:
        try:
            got = timed(lambda c=c: c.search(query, count), seconds)
        except Exception:  # noqa: BLE001
            got = []
        if got:
            return got
    return []


def complete_all(df: DataFrame, key: str, prompt: str, make: Callable[[], ModelClient], tries: int = 3, seconds: float | None = MODEL_SECONDS, per_second: float | None = None, wait: float = 0.0) -> DataFrame:
    """(key, completion) of every prompt; a client is made once a task, and a prompt that fails comes out null. A call has
    so many seconds, a task makes at most so many calls a second, and waits double after failures."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, pace = make(), Pace(per_second)

        def said_to(p: str) -> str | None:
            pace.wait()
            return client.complete([{"role": "user", "content": p}])

        for b in batches:
            said = [with_retries(lambda p=p: said_to(p), tries, wait, seconds) if p is not None else None for p in b[prompt].tolist()]
            yield pd.DataFrame({key: b[key], "completion": pd.Series(said, dtype=object)})

    return df.select(key, prompt).mapInPandas(run, f"{key} {kind}, completion string")


def fetch_missing(keys: DataFrame, cache: DataFrame, key: str, make: Callable[[], PageClient], seconds: float | None = FETCH_SECONDS) -> DataFrame:
    """(key, text) of keys that the cache lacks, each fetched once; empty and late results aren't kept."""
    kind = dict(keys.dtypes)[key]
    new = keys.select(key).distinct().join(cache.select(key), key, "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for b in batches:
            got = [(k, with_retries(lambda k=k: client.fetch(k), 1, seconds=seconds)) for k in b[key].tolist()]
            yield pd.DataFrame([x for x in got if x[1]], columns=[key, "text"])

    return new.mapInPandas(run, f"{key} {kind}, text string")


class ListingClient(Protocol):
    def page(self, category: str, token: str | None) -> tuple[list[str], str | None]: ...


def category_titles(categories: DataFrame, make: Callable[[], ListingClient], prefix: str) -> DataFrame:
    """(category, pos, title): a category's members with the prefix, all pages, each once in order of appearance. A token
    that comes again is an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for b in batches:
            out = []
            for c in b["category"].tolist():
                token, seen, passed = None, {}, set()
                while True:
                    got, token = client.page(c, token)
                    if token in passed:
                        raise RuntimeError(f"{c}: page {token} comes again")
                    passed.add(token)
                    for t in got:
                        if t.startswith(prefix):
                            seen.setdefault(t, len(seen))
                    if token is None:
                        break
                out += [(c, i, t) for t, i in seen.items()]
            yield pd.DataFrame(out, columns=["category", "pos", "title"])

    return categories.select("category").distinct().mapInPandas(run, "category string, pos int, title string")


def search_missing(questions: DataFrame, cache: DataFrame, make: Callable[[], list[SearchClient]], count: int = 10) -> DataFrame:
    """(question, urls) of questions that the cache lacks, each searched once; empty results aren't kept."""
    new = questions.select("question").where("question is not null").distinct().join(cache.select("question"), "question", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        providers = make()
        for b in batches:
            got = [(q, first_provider(providers, q, count)) for q in b["question"].tolist()]
            yield pd.DataFrame([x for x in got if x[1]], columns=["question", "urls"])

    return new.mapInPandas(run, "question string, urls array<string>")
