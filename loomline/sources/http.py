"""Payloads from an HTTP tree, as a Python data source that executors read in parallel."""

from __future__ import annotations

import io
import json
import os
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

TIMEOUT_SECONDS = 60
#: The variable that names the folder in which payloads are kept; without it, none are.
CACHE_ENV = "LOOMLINE_CACHE"


def is_url(root: str) -> bool:
    return root.startswith(("http://", "https://"))


def fetch(url: str) -> bytes | None:
    """The body of a GET, or None for any failure."""
    try:
        with urllib.request.urlopen(url, timeout=TIMEOUT_SECONDS) as response:  # noqa: S310
            return response.read() if response.status == 200 else None
    except (OSError, ValueError):
        return None


def fetch_cached(base: str, contest_id: str, cache: str | None, get: Callable[[str], bytes | None] = fetch) -> str | None:
    """A well-formed payload from the cache folder or from ``{base}/json/{id}.json``; malformed bodies are not kept."""
    kept = os.path.join(cache, f"{contest_id}.json") if cache else None
    if kept and os.path.exists(kept):
        with open(kept, encoding="utf-8") as f:
            return f.read()
    body = get(f"{base.rstrip('/')}/json/{contest_id}.json")
    try:
        text = None if body is None else body.decode("utf-8")
        json.loads(text or "")
    except ValueError:
        return None
    if kept:
        try:
            os.makedirs(cache, exist_ok=True)
            with open(kept, "w", encoding="utf-8") as f:
                f.write(text)
        except OSError:
            pass  # the cache only saves a later request
    return text


def read_index(spark: SparkSession, base: str, names: list[str], get: Callable[[str], bytes | None] = fetch) -> DataFrame | None:
    """The schedule index, a small parquet file, by the first name under which the base has it; None if it has none."""
    for name in names:
        if body := get(f"{base.rstrip('/')}/{name}"):
            rows = pq.read_table(io.BytesIO(body), columns=["contest_id", "season"])
            return spark.createDataFrame(rows)
    return None


class IdChunk(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class PayloadSource(DataSource):
    """``format("loomline_http")`` with options base, ids (comma-separated), cache and chunk: (contest_id, payload)."""

    @classmethod
    def name(cls) -> str:
        return "loomline_http"

    def schema(self) -> str:
        return "contest_id string, payload string"

    def reader(self, schema) -> DataSourceReader:
        return PayloadReader(self.options)


class PayloadReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        ids = [i for i in self.options.get("ids", "").split(",") if i]
        n = int(self.options.get("chunk", "64"))
        return [IdChunk(ids[a : a + n]) for a in range(0, len(ids), n)] or [IdChunk([])]

    def read(self, partition: IdChunk) -> Iterator[tuple]:
        for contest_id in partition.ids:
            yield contest_id, fetch_cached(self.options["base"], contest_id, self.options.get("cache"))


def read_payloads(spark: SparkSession, base: str, ids: list[str], cache: str | None = None, chunk: int = 64) -> DataFrame:
    """(contest_id, payload text) for each id; null where there is none."""
    spark.dataSource.register(PayloadSource)
    reader = spark.read.format("loomline_http").option("base", base).option("ids", ",".join(ids)).option("chunk", chunk)
    return (reader.option("cache", cache) if cache else reader).load()
