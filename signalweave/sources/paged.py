"""A paged source as a Python data source: one input partition per range of pages, the period pushed into each request.

``fetch`` files stand in for a service: a folder of JSON pages named ``<key>-<period>-<page>.json`` with ``total`` and ``rows``.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition


class PageRange(InputPartition):
    def __init__(self, key: str, period: str, first: int, last: int):
        super().__init__((key, period, first, last))
        self.key, self.period, self.first, self.last = key, period, first, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str]):
        self.root = options["path"]
        self.keys = options["keys"].split(",")
        self.periods = [p for p in options.get("periods", "all").split(",") if p]
        self.size = int(options.get("pageSize", 1000))
        self.cap = int(options.get("cap", 20_000))
        self.per_task = int(options.get("pagesPerPartition", 10))
        self.fields = fields

    def _page(self, key: str, period: str, page: int) -> dict | None:
        name = os.path.join(self.root, f"{key}-{period}-{page}.json")
        if not os.path.exists(name):
            return None
        with open(name, encoding="utf-8") as f:
            return json.load(f)

    def partitions(self) -> list[PageRange]:
        out = []
        for key in self.keys:
            for period in self.periods:
                head = self._page(key, period, 1)
                there = (head or {}).get("total", 0)
                total = min(there, self.cap)
                if there > total:
                    out.append(PageRange(key, period, 0, 0))
                pages = -(-total // self.size)
                out += [PageRange(key, period, p, min(p + self.per_task, pages + 1)) for p in range(1, pages + 1, self.per_task)]
                if not pages:
                    out.append(PageRange(key, period, 1, 2))
        return out

    def read(self, part: PageRange) -> Iterator[tuple]:
        if not part.last:
            # The cap cuts this period: a row without values says so.
            yield (part.key, part.period, 0, "truncated", *[None] * len(self.fields))
        for p in range(part.first, part.last):
            page = self._page(part.key, part.period, p)
            if page is None:
                # A failed page is a row without values: it is not the same as no rows.
                yield (part.key, part.period, p, "error", *[None] * len(self.fields))
                continue
            for r in page["rows"]:
                yield (part.key, part.period, p, "ok", *[None if r.get(f) is None else str(r[f]) for f in self.fields])


class PushingReader(PagedReader):
    """Takes an equality on the period into the requests; other filters are left to Spark."""

    def pushFilters(self, filters) -> Iterator:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("period",):
                self.periods = [p for p in self.periods if p == f.value]
            else:
                yield f


class PagedSource(DataSource):
    """format("paged_api"): path, keys, fields, and periods, pageSize, cap, pagesPerPartition if wanted.

    With ``push`` set to true, filters on the period choose the requests; the session must allow it by
    spark.sql.python.filterPushdown.enabled.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return "source string, period string, page int, status string, " + ", ".join(f"{f} string" for f in self.options["fields"].split(","))

    def reader(self, schema) -> PagedReader:
        kind = PushingReader if self.options.get("push", "false") == "true" else PagedReader
        return kind(self.options, self.options["fields"].split(","))
