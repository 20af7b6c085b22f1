"""Remote indexes as Spark data sources, one partition per page of rows.

The transport is an object with `count(query)` and `page(query, offset, rows)`; tests give one
that holds rows in memory. `search` fails on an early empty page; `library` only notes it, since
an index may have lost rows between two requests.
"""

from __future__ import annotations

import base64
import json
import logging
import os
import pickle
from collections.abc import Iterator
from typing import Protocol
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SEARCH_ROWS, LIBRARY_ROWS, MOST = 2000, 100, 2000
RECORD = "bibcode string, links_data array<string>, doi array<string>, abstract string"
log = logging.getLogger(__name__)


class Transport(Protocol):
    def count(self, query: str) -> int: ...

    def page(self, query: str, offset: int, rows: int) -> list[dict]: ...


class MemoryTransport:
    """Rows in memory; `lost` of them are counted but never served."""

    def __init__(self, rows: list[dict], lost: int = 0):
        self.rows, self.lost = sorted(rows, key=lambda r: r["bibcode"]), lost

    def count(self, query: str) -> int:
        return len(self.rows) + self.lost

    def page(self, query: str, offset: int, rows: int) -> list[dict]:
        return self.rows[offset : offset + rows]


class _Page(InputPartition):
    def __init__(self, offset: int, rows: int):
        self.offset, self.rows = offset, rows


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = schema.names
        self.transport: Transport = pickle.loads(base64.b64decode(options["transport"]))
        self.query = options.get("query", "")
        self.strict = options.get("strict", "true") == "true"
        self.rows = int(options.get("rows", SEARCH_ROWS))
        self.limit = int(options["limit"]) if "limit" in options else None

    def partitions(self) -> list[InputPartition]:
        wanted = self.transport.count(self.query)
        if self.limit is not None:
            if wanted > self.limit:
                log.warning("%d of %d rows are read", self.limit, wanted)
            wanted = min(wanted, self.limit)
        # Spark reads a source without partitions as one that has none to tell apart
        return [_Page(at, min(self.rows, wanted - at)) for at in range(0, wanted, self.rows)] or [_Page(0, 0)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        at, left = partition.offset, partition.rows
        while left:
            found = self.transport.page(self.query, at, left)
            if not found:
                if self.strict:
                    raise ValueError(f"an empty page at row {at}")
                log.warning("the index has lost %d rows", left)
                return
            for r in found[:left]:
                yield tuple(r.get(n) for n in self.names)
            at, left = at + len(found), left - min(left, len(found))


class RemoteIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return "remote_index"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, self.options)


def _load(spark: SparkSession, transport: Transport, schema: str, **options) -> DataFrame:
    spark.dataSource.register(RemoteIndex)
    return spark.read.format("remote_index").schema(schema).options(transport=base64.b64encode(pickle.dumps(transport)).decode(), **options).load()


def search(spark: SparkSession, transport: Transport, query: str, limit: int = MOST, rows: int = SEARCH_ROWS) -> DataFrame:
    """Candidates; only the columns of RECORD are asked for.

    They are in the index's own order, ascending bibcode: sorting here would ask for every page
    twice, as Spark samples what it sorts.
    """
    from .jsonl import decode_links

    if limit <= 0:
        raise ValueError("limit must be positive")
    return decode_links(_load(spark, transport, RECORD, query=query, limit=limit, rows=rows))


def library(spark: SparkSession, transport: Transport, rows: int = LIBRARY_ROWS) -> DataFrame:
    return _load(spark, transport, "bibcode string", rows=rows, strict="false").distinct()


def auth_header(token: str | None) -> dict[str, str]:
    """The header of a request; a missing token is an error before any request."""
    if not token:
        raise ValueError("no access token is set")
    return {"Authorization": f"Bearer {token}"}


class HttpIndex:
    """A search index over HTTP that answers in JSON; a page asks for the columns of RECORD only.

    The access token is taken from an environment variable when the transport is made, so that a
    missing one is an error before any request, and so that tasks need no environment of their own.
    """

    def __init__(self, url: str, token_variable: str = "FOLIOFLOW_TOKEN", timeout: float = 60):
        self.url, self.timeout, self.headers = url, timeout, auth_header(os.environ.get(token_variable))

    def _answer(self, **params) -> dict:
        request = Request(f"{self.url}?{urlencode(params)}", headers=self.headers)
        with urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)

    def _search(self, query: str, offset: int, rows: int) -> dict:
        fields = ",".join(c.split()[0] for c in RECORD.split(", "))
        return self._answer(q=query, fl=fields, sort="bibcode asc", start=offset, rows=rows)["response"]

    def count(self, query: str) -> int:
        return self._search(query, 0, 0)["numFound"]

    def page(self, query: str, offset: int, rows: int) -> list[dict]:
        found = self._search(query, offset, rows)["docs"]
        # links that come as structs go the same way as those that come as JSON text
        return [r | {"links_data": [x if isinstance(x, str) else json.dumps(x) for x in r.get("links_data") or []]} for r in found]


class HttpLibrary(HttpIndex):
    """A curated list over HTTP: ids, and how many there should be."""

    def count(self, query: str) -> int:
        return self._answer(start=0, rows=1)["metadata"]["num_documents"]

    def page(self, query: str, offset: int, rows: int) -> list[dict]:
        return [{"bibcode": b} for b in self._answer(start=offset, rows=rows)["documents"]]
