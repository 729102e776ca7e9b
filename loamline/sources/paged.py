"""Paged answers as a data source: a batch reader, and a stream whose offset is the next page.

Answers lie in a folder as page-<n>.json (or any suffix); a page file holds one payload. A page past
the end is not there; a page that is there and empty is refused, so its offset is not committed.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

SCHEMA = "page long, payload string"
_NAME = re.compile(r"page-(\d+)\.\w+\Z")


def _pages(folder: str) -> dict[int, str]:
    return {int(m.group(1)): os.path.join(folder, n) for n in os.listdir(folder) if (m := _NAME.match(n))}


def _payload(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if not text.strip():
        raise ValueError(f"empty answer: {path}")
    return text


class PagedSource(DataSource):
    """Options: path (a folder that driver and executors share), start (first page, 1)."""

    @classmethod
    def name(cls) -> str:
        return "paged_answers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(self.options)


class _Page(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.start = options["path"], int(options.get("start", "1"))

    def partitions(self) -> list[InputPartition]:
        return [_Page((n, path)) for n, path in sorted(_pages(self.folder).items()) if n >= self.start]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        n, path = partition.value
        yield n, _payload(path)


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.start = options["path"], int(options.get("start", "1"))

    def initialOffset(self) -> dict:
        return {"page": self.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        pages, n, rows = _pages(self.folder), start["page"], []
        while n in pages:
            rows.append((n, _payload(pages[n])))
            n += 1
        return iter(rows), {"page": n}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        pages = _pages(self.folder)
        return iter([(n, _payload(pages[n])) for n in range(start["page"], end["page"])])
