"""Remote sources with injected transport: paged search, memoised lookups, downloads, retries."""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from taxaflow.functions import text

Fetch = Callable[[str], dict]
R = TypeVar("R")


def retried(call: Callable[[], R], tries: int = 5, wait: float = 1.0, exponential: bool = False, errors: tuple = (OSError,), sleep: Callable[[float], None] = time.sleep) -> R:
    """The call's result; after an error it waits, longer each time, and calls again, `tries` times in all."""
    for n in range(1, tries + 1):
        try:
            return call()
        except errors:
            if n == tries:
                raise
            sleep(wait * (2 ** (n - 1) if exponential else n))
    raise ValueError("tries must be positive")


class Slice(InputPartition):
    """A query that is paged through by one task; expected: its rows by the service's own count, if that was asked."""

    def __init__(self, query: str, search: str = "", expected: int | None = None):
        super().__init__(query)
        self.query, self.search, self.expected = query, search, expected


class PagedSearch(DataSource):
    """Rows of a paged search, a partition for each slice of the query.

    Options: slices (one query a line) and pages of size. A subclass gives columns and fetch(query, offset,
    limit), which returns {"results": [row dicts], "endOfRecords": bool}. Slices keep offsets small.
    """

    columns: Sequence[str] = ()

    @staticmethod
    def fetch(query: str, offset: int, limit: int) -> dict:
        raise NotImplementedError

    @classmethod
    def name(cls) -> str:
        return cls.__name__.lower()

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in self.columns)

    def reader(self, schema: object) -> DataSourceReader:
        return _PagedReader(self.options, list(self.columns), type(self).fetch)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str], fetch: Callable):
        self.queries = [q for q in options.get("slices", "").split("\n") if q]
        self.limit, self.columns, self.fetch = int(options.get("size", 300)), columns, fetch

    def partitions(self) -> list[InputPartition]:
        return [Slice(q) for q in self.queries]

    def read(self, partition: Slice) -> Iterator[tuple]:
        offset = 0
        while True:
            page = retried(lambda: self.fetch(partition.query, offset, self.limit))
            for row in page["results"]:
                yield tuple(None if row.get(c) is None else str(row[c]) for c in self.columns)
            offset += self.limit
            if page.get("endOfRecords", True) or not page["results"]:
                return


class FacetedSearch(PagedSearch):
    """Rows of searches that are too long to page through, cut into slices by the counts of their values.

    Options: searches (one query a line), dimensions (names that cut a query, by commas, in their order), deepest (most
    rows of a slice, 3000) and size. A subclass also gives facet(query, dimension), which returns the query's count and
    the count of each value of the dimension (of none, for an empty name).

    A query of more than deepest rows is cut by the first dimension, and each part that is still too long by the next. A
    part that no dimension is left for is paged through as it is. With the option report, the rows are the plan alone:
    (search, slice, expected), where a null slice counts rows without a value in a dimension, which slices do not reach.
    """

    @staticmethod
    def facet(query: str, dimension: str) -> tuple[int, dict[str, int]]:
        raise NotImplementedError

    def schema(self) -> str:
        return "search string, slice string, expected long" if self.options.get("report") else super().schema()

    def reader(self, schema: object) -> DataSourceReader:
        return _FacetedReader(self.options, list(self.columns), type(self).fetch, type(self).facet)


class _FacetedReader(_PagedReader):
    def __init__(self, options: dict, columns: list[str], fetch: Callable, facet: Callable):
        super().__init__(options, columns, fetch)
        self.facet, self.report = facet, bool(options.get("report"))
        self.searches = [q for q in options.get("searches", "").split("\n") if q]
        self.dimensions = [d for d in options.get("dimensions", "").split(",") if d]
        self.deepest = int(options.get("deepest", 3000))

    def _cut(self, search: str, query: str, dimensions: list[str], count: int | None = None) -> Iterator[Slice]:
        if count is not None and (count <= self.deepest or not dimensions):
            yield Slice(query, search, count)
            return
        dimension, *rest = dimensions or [""]
        total, values = retried(lambda: self.facet(query, dimension))
        if total <= self.deepest or not dimensions:
            yield Slice(query, search, total)
            return
        for value, n in sorted(values.items()):
            yield from self._cut(search, f"{query}&{dimension}={value}", rest, n)
        if self.report and (unreached := total - sum(values.values())) > 0:
            yield Slice("", search, unreached)

    def partitions(self) -> list[InputPartition]:
        every = [s for search in self.searches for s in self._cut(search, search, self.dimensions)]
        return [s for s in every if s.expected or not s.query]

    def read(self, partition: Slice) -> Iterator[tuple]:
        if self.report:
            yield partition.search, partition.query or None, partition.expected
        else:
            yield from super().read(partition)


def slices(years: Iterable[int], places: Iterable[str]) -> list[str]:
    """Queries that together cover a search, each small enough to page through."""
    held = list(places)
    return [f"year={y}&place={p}" for y in years for p in held]


def listed(call: Callable[[], dict], name: str = "results", errors: tuple = (OSError, KeyError, ValueError)) -> list[dict]:
    """The list of a service's answer, empty where it fails or has none: for descriptions that a table can do without."""
    try:
        return list(call()[name])
    except errors:
        return []


def memoised(spark: SparkSession, asked: DataFrame, key: str, answer: Callable[[str], str | None], cache: str, skip: tuple = ()) -> DataFrame:
    """(key, answer) of each distinct key. Keys that the Parquet cache has are not asked for again; new ones are added.

    An error of a kind in `skip` leaves its key out, of the cache too: a later run asks again.
    """
    from taxaflow.sources.files import _exists

    keys = asked.select(key).filter(f"{key} IS NOT NULL").distinct()
    fresh = keys.join(spark.read.parquet(cache), key, "left_anti") if _exists(spark, cache) else keys

    def rows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for k in frame[key]:
                try:
                    found.append((k, retried(lambda k=k: answer(k), tries=4, exponential=True)))
                except skip:
                    continue
            yield pd.DataFrame(found, columns=[key, "answer"])

    fresh.mapInPandas(rows, f"{key} string, answer string").write.mode("append").parquet(cache)
    # two runs at once can both have asked for a key: the cache then has it twice
    return spark.read.parquet(cache).join(keys, key, "left_semi").groupBy(key).agg(F.min("answer").alias("answer"))


def resolved_terms(spark: SparkSession, names: DataFrame, search: Callable[[str], Sequence[dict]], cache: str, name: str = "scientificName") -> DataFrame:
    """(name, query, curie, label, iri, exact): the term of an ontology for each distinct name.

    Asked is for the binomial of a name, without subspecies and open parts. search returns candidates ({"obo_id", "label",
    "iri"}); the first whose label is the query, whatever its case, is the term. Names without one keep nulls, and those
    whose search fails are absent, and asked for again by a later run.
    """

    def answer(query: str) -> str:
        hit = next((d for d in search(query) if str(d.get("label", "")).lower() == query.lower()), None)
        return json.dumps(hit or {})

    asked = names.filter(F.col(name).isNotNull() & (F.trim(name) != "")).select(name).distinct().withColumn("query", text.binomial(F.col(name)))
    found = memoised(spark, asked, "query", answer, cache, skip=(OSError, KeyError, ValueError))
    term = F.from_json("answer", "obo_id string, label string, iri string")
    known = found.select("query", term.alias("t")).select("query", F.col("t.obo_id").alias("curie"), "t.label", "t.iri")
    return asked.join(known, "query").select(name, "query", "curie", "label", "iri", (F.col("curie").isNotNull() & (F.col("query") == F.col(name))).alias("exact"))


def submitted(submit: Callable[[], str], status: Callable[[str], str], wait: float = 5.0, most: int = 1000, sleep: Callable[[float], None] = time.sleep) -> str:
    """Submit an asynchronous job and wait until it has succeeded; returns its id."""
    job = retried(submit)
    for _ in range(most):
        state = retried(lambda: status(job))
        if state == "SUCCEEDED":
            return job
        if state in ("FAILED", "KILLED", "CANCELLED"):
            raise RuntimeError(f"job {job}: {state}")
        sleep(wait)
    raise TimeoutError(job)


def download(df: DataFrame, folder: str, fetch: Callable[[str], bytes], threads: int = 6) -> DataFrame:
    """(image_id, local_path, status, bytes, sha256) of rows (image_id, url).

    folder must be one that all executors share, mounted as files. A file that is there is not fetched again; a
    new one is written beside its place and renamed, so a lost task leaves no half file.
    """

    def one(image_id: str, url: str) -> tuple:
        path = os.path.join(folder, image_id)
        try:
            status = "present"
            if not os.path.exists(path):
                content = retried(lambda: fetch(url), tries=4, exponential=True)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{path}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, path)
                status = "downloaded"
            with open(path, "rb") as f:
                content = f.read()
            return image_id, path, status, len(content), hashlib.sha256(content).hexdigest()
        except Exception as error:  # noqa: BLE001  a file's failure is its result
            return image_id, path, f"error:{type(error).__name__}", None, None

    def rows(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for frame in frames:
                found = list(pool.map(one, frame["image_id"], frame["url"]))
                yield pd.DataFrame(found, columns=["image_id", "local_path", "status", "bytes", "sha256"])

    return df.select("image_id", "url").mapInPandas(rows, "image_id string, local_path string, status string, bytes long, sha256 string")
