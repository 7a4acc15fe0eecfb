"""Table functions for SQL: members and lines of archives for each row of a table, runs of a value in each partition.

    register(spark)
    spark.sql("select path, member from zips, lateral zip_members(content)")
    spark.sql("select path, member, value from zip_table_lines(table(select path, content from zips), '.txt$')")
    spark.sql("select * from value_runs(table(select user_id, ts, kind from events) partition by user_id order by ts)")
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

#: Lines of an archive that are handed over at once.
LINES = 4096


class ZipMembers:
    """(member, size, error) for each member of an archive; one row with an error for bytes that are none; none for null."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        if content is None:
            return
        try:
            for m in zipfile.ZipFile(io.BytesIO(content)).infolist():
                yield m.filename, m.file_size, None
        except zipfile.BadZipFile as e:
            yield None, None, str(e)


class ZipLines:
    """(member, line, value) for the lines of the members whose names fit a pattern, read as streams."""

    def eval(self, content: bytes, pattern: str) -> Iterator[tuple]:
        if content is None:
            return
        z = zipfile.ZipFile(io.BytesIO(content))
        for name in sorted(z.namelist()):
            if re.search(pattern, name):
                with z.open(name) as f:
                    for i, line in enumerate(io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline="")):
                        yield name, i, line.rstrip("\r\n")


class ZipTableLines:
    """(path, member, line, value) for the lines of the members whose names fit a pattern, of all archives of a table of (path, content). Some thousand lines are held at once, where zip_lines, called for a row, holds those of all rows that Spark hands over together."""

    def eval(self, batch: pa.RecordBatch, pattern: pa.Array) -> Iterator[pa.Table]:
        wanted = pattern[0].as_py()
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            if not content.is_valid:
                continue
            z = zipfile.ZipFile(pa.BufferReader(content.as_buffer()))
            for name in sorted(z.namelist()):
                if re.search(wanted, name):
                    with z.open(name) as f:
                        lines = io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline="")
                        n = 0
                        while some := [line.rstrip("\r\n") for line in itertools.islice(lines, LINES)]:
                            yield pa.table({"path": pa.array([path.as_py()] * len(some), pa.string()), "member": pa.array([name] * len(some), pa.string()), "line": pa.array(range(n, n + len(some)), pa.int64()), "value": pa.array(some, pa.string())})
                            n += len(some)


class ValueRuns:
    """(key, start, value, n) for the runs of the third column in each partition of a table, in its order: key and start are the first two columns at a run's beginning, as text. A partition is streamed, however many rows it has."""

    def __init__(self):
        self.run: list | None = None

    def eval(self, row: Row) -> Iterator[tuple]:
        key, start, value = (None if v is None else str(v) for v in list(row)[:3])
        if self.run and self.run[2] == value:
            self.run[3] += 1
            return
        if self.run:
            yield tuple(self.run)
        self.run = [key, start, value, 1]

    def terminate(self) -> Iterator[tuple]:
        if self.run:
            yield tuple(self.run)


def register(spark: SparkSession) -> None:
    """Makes the functions known to the session's SQL."""
    spark.udtf.register("zip_members", F.udtf(ZipMembers, returnType="member string, size long, error string"))
    spark.udtf.register("zip_lines", F.udtf(ZipLines, returnType="member string, line long, value string"))
    spark.udtf.register("zip_table_lines", F.arrow_udtf(ZipTableLines, returnType="path string, member string, line long, value string"))
    spark.udtf.register("value_runs", F.udtf(ValueRuns, returnType="key string, start string, value string, n long"))
