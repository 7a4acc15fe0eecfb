"""Paged services and archives as Spark data sources, read in tasks: a partition a page, a partition a member.

    spark.dataSource.register(PagedService)
    spark.read.format("paged_service").schema("id long, name string").option("url", address).load()

A page that fails is asked for again with growing pauses inside the task that reads it, so that one busy answer costs one
task some seconds; what stays broken fails the task, which Spark tries anew.
"""

from __future__ import annotations

import io
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import types as T

#: Answers that are worth another try.
BUSY = (408, 425, 429, 500, 502, 503, 504)


class ServiceError(RuntimeError):
    """The service has answered with an error in place of data."""


def with_retries(call: Callable, tries: int, pause: float, sleep: Callable[[float], None] = time.sleep):
    """call(), again after 1, 2, 4 ... times the pause where it fails for a reason that may pass; the last failure is raised."""
    for k in range(tries):
        try:
            return call()
        except urllib.error.HTTPError as e:
            if e.code not in BUSY or k == tries - 1:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError, json.JSONDecodeError):
            if k == tries - 1:
                raise
        sleep(pause * 2**k)


def fetched(url: str, timeout: float, **parameters) -> dict:
    """The JSON answer to a request; an answer that holds an error is one."""
    query = urllib.parse.urlencode({k: v for k, v in parameters.items() if v is not None})
    with urllib.request.urlopen(f"{url}{'&' if '?' in url else '?'}{query}", timeout=timeout) as answer:
        payload = json.loads(answer.read().decode("utf-8-sig"))
    if isinstance(payload, dict) and "error" in payload:
        raise ServiceError(f"{url}: {json.dumps(payload['error'])[:200]}")
    return payload


@dataclass
class Page(InputPartition):
    offset: int
    size: int
    last: bool


class PagedService(DataSource):
    """Features of a service that gives them by offset and count. Options: url, where (1=1), page (1000), tries (5), pause in seconds (0.5), timeout (60).

    The service is asked for the number of features once; each page is a partition. The last one asks on until a page
    is not full, so features that came since are read, too. A page that gives fewer than it should raises an error.
    Columns are properties by name (null where a feature lacks one) and `geometry` as JSON text.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_service"

    def schema(self) -> str:
        raise ValueError("give the features' schema: spark.read.format('paged_service').schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedServiceReader(schema, dict(self.options))


class PagedServiceReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.fields, self.url, self.where = [(f.name, f.dataType) for f in schema.fields], options["url"], options.get("where", "1=1")
        self.page, self.tries = int(options.get("page", 1000)), int(options.get("tries", 5))
        self.pause, self.timeout = float(options.get("pause", 0.5)), float(options.get("timeout", 60))

    def _asked(self, **parameters) -> dict:
        return with_retries(lambda: fetched(self.url, self.timeout, where=self.where, **parameters), self.tries, self.pause)

    def partitions(self) -> list[Page]:
        count = int(self._asked(returnCountOnly="true", f="json")["count"])
        starts = range(0, max(count, 1), self.page)
        return [Page(i, min(self.page, count - i), i == starts[-1]) for i in starts]

    def read(self, partition: Page) -> Iterator[tuple]:
        offset, wanted = partition.offset, partition.size
        while True:
            features = self._asked(resultOffset=offset, resultRecordCount=self.page, outFields="*", f="geojson").get("features", [])
            if len(features) < wanted:
                raise ServiceError(f"{self.url}: {len(features)} of {wanted} features from {offset} on")
            for f in features:
                yield tuple(self._value(f, name, kind) for name, kind in self.fields)
            if not partition.last or len(features) < self.page:
                return
            offset, wanted = offset + len(features), 0

    @staticmethod
    def _value(feature: dict, name: str, kind: T.DataType):
        value = feature.get("geometry") if name == "geometry" else (feature.get("properties") or {}).get(name)
        if value is None:
            return None
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else json.dumps(value)
        return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else int(value) if isinstance(kind, T.IntegralType) else value


class RangeFile(io.RawIOBase):
    """A remote file that is read by ranges, so that a ZIP member costs its own bytes and those of the directory."""

    def __init__(self, url: str, tries: int, pause: float, timeout: float):
        self.url, self.tries, self.pause, self.timeout, self.at = url, tries, pause, timeout, 0
        self.size = with_retries(self._size, tries, pause)

    def _size(self) -> int:
        with urllib.request.urlopen(urllib.request.Request(self.url, method="HEAD"), timeout=self.timeout) as answer:
            return int(answer.headers["Content-Length"])

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence]
        return self.at

    def readinto(self, buffer) -> int:
        end = min(self.at + len(buffer), self.size)
        if end <= self.at:
            return 0

        def part() -> bytes:
            asked = urllib.request.Request(self.url, headers={"Range": f"bytes={self.at}-{end - 1}"})
            with urllib.request.urlopen(asked, timeout=self.timeout) as answer:
                data = answer.read()
                return data if answer.status == 206 else data[self.at : end]

        data = with_retries(part, self.tries, self.pause)
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


@dataclass
class Member(InputPartition):
    name: str


class ZippedLines(DataSource):
    """Lines of the members of a remote ZIP file whose name fits a pattern, a partition a member: (member, line, value). Options: url, pattern (.*), encoding (utf-8-sig), tries, pause, timeout."""

    @classmethod
    def name(cls) -> str:
        return "zipped_lines"

    def schema(self) -> str:
        return "member string, line long, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZippedLinesReader(dict(self.options))


class ZippedLinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.pattern, self.encoding = options["url"], options.get("pattern", ".*"), options.get("encoding", "utf-8-sig")
        self.limits = int(options.get("tries", 5)), float(options.get("pause", 0.5)), float(options.get("timeout", 60))

    def _archive(self) -> zipfile.ZipFile:
        return zipfile.ZipFile(io.BufferedReader(RangeFile(self.url, *self.limits), 1 << 20))

    def partitions(self) -> list[Member]:
        import re

        return [Member(n) for n in sorted(self._archive().namelist()) if re.search(self.pattern, n) and not n.endswith("/")]

    def read(self, partition: Member) -> Iterator[tuple]:
        with self._archive().open(partition.name) as f:
            for i, line in enumerate(io.TextIOWrapper(f, self.encoding, errors="replace", newline="")):
                yield partition.name, i, line.rstrip("\r\n")
