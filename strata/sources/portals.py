"""Portal connectors as Python data sources: paged catalog search and paged feature layers.

`base` is the portal's address, or a folder of canned pages (page-<start>.json), which is how tests run without a network.
Requests to one portal keep GAP seconds between them, so a portal is read in one task unless the option `tasks` allows more;
portals are read beside each other. A page that fails raises, so that a source is never read in part without notice.
"""

from __future__ import annotations

import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

AGENT = "strata/1.0 (research mirror)"
GAP, TIMEOUT = 0.5, 180
CATALOG_PAGE, LAYER_PAGE = 100, 2000


def _get(base: str, query: dict, start: int) -> dict:
    if os.path.isdir(base):
        path = os.path.join(base, f"page-{start}.json")
        return json.load(open(path, encoding="utf-8")) if os.path.exists(path) else {}
    time.sleep(GAP)
    request = urllib.request.Request(f"{base}?{urllib.parse.urlencode(query)}", headers={"User-Agent": AGENT})
    with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
        return json.load(answer)


class _Range(InputPartition):
    """Rows start to end of a source; end None: to the last."""

    def __init__(self, start: int, end: int | None) -> None:
        self.start, self.end = start, end


def _ranges(count: int | None, page: int, tasks: int) -> list[_Range]:
    """At most `tasks` ranges of whole pages; the last has no end, as the count may be too low by now."""
    pages = max(1, -(-(count or 0) // page)) if count is not None else 1
    step = -(-pages // max(1, tasks)) * page
    starts = list(range(0, pages * page, step))
    return [_Range(s, e) for s, e in zip(starts, [*starts[1:], None])]


class CatalogSource(DataSource):
    """spark.read.format("portal_catalog").option("base", ...).option("fq", ...): one row for each package, resources as an array."""

    @classmethod
    def name(cls) -> str:
        return "portal_catalog"

    def schema(self) -> str:
        return "title string, name string, license_title string, resources array<struct<id:string,name:string,format:string,url:string,last_modified:string,created:string,size:bigint>>"

    def reader(self, schema) -> CatalogReader:  # noqa: ANN001
        return CatalogReader(self.options)


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.base, self.fq, self.rows, self.tasks = options["base"], options.get("fq", ""), int(options.get("rows", CATALOG_PAGE)), int(options.get("tasks", 1))
        self.url = self.base if os.path.isdir(self.base) else self.base.rstrip("/") + "/api/3/action/package_search"

    def _page(self, start: int) -> dict:
        page = _get(self.url, {"fq": self.fq, "rows": self.rows, "start": start}, start)
        if page and not page.get("success"):
            raise RuntimeError(f"{self.url}: the portal reports a failure at {start}")
        return page.get("result", {"count": 0, "results": []})

    def partitions(self) -> list[_Range]:
        return _ranges(int(self._page(0).get("count", 0)) if self.tasks > 1 else None, self.rows, self.tasks)

    def read(self, partition: _Range) -> Iterator[tuple]:
        """The packages of a range; the next page starts after the rows received, as portals may give less than asked for."""
        at = partition.start
        while partition.end is None or at < partition.end:
            page = self._page(at)
            results = page.get("results") or []
            for p in results[: None if partition.end is None else partition.end - at]:
                resources = []
                for r in p.get("resources") or []:
                    size = r.get("size")
                    resources.append((r.get("id"), r.get("name"), r.get("format"), r.get("url"), r.get("last_modified"), r.get("created"), int(size) if str(size or "").isdigit() else None))
                yield p.get("title"), p.get("name"), p.get("license_title"), resources
            at += len(results)
            if not results or at >= int(page.get("count", 0)):
                return


class LayerSource(DataSource):
    """spark.read.format("feature_layer").option("base", url): (properties map, geometry JSON), one row for each feature.

    Pages follow each other until one is empty, or the server's count is reached: servers may give less than asked for.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_layer"

    def schema(self) -> str:
        return "properties map<string,string>, geometry string"

    def reader(self, schema) -> LayerReader:  # noqa: ANN001
        return LayerReader(self.options)


class LayerReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.base, self.page, self.tasks = options["base"], int(options.get("rows", LAYER_PAGE)), int(options.get("tasks", 1))
        self.url = self.base if os.path.isdir(self.base) else self.base.rstrip("/") + "/query"

    def _features(self, start: int) -> list[dict]:
        query = {"where": "1=1", "outFields": "*", "f": "geojson", "outSR": 4326, "resultOffset": start, "resultRecordCount": self.page}
        return _get(self.url, query, start).get("features") or []

    def count(self) -> int | None:
        """The server's number of features, None if it doesn't tell."""
        try:
            if os.path.isdir(self.url):
                return int(json.load(open(os.path.join(self.url, "count.json"), encoding="utf-8"))["count"])
            return int(_get(self.url, {"where": "1=1", "returnCountOnly": "true", "f": "json"}, 0)["count"])
        except (OSError, KeyError, ValueError):
            return None

    def partitions(self) -> list[_Range]:
        return _ranges(self.count() if self.tasks > 1 else None, self.page, self.tasks)

    def features(self, start: int = 0, end: int | None = None) -> Iterator[dict]:
        """The layer's features as the server gives them."""
        while end is None or start < end:
            page = self._features(start)
            if not page:
                return
            yield from page[: None if end is None else end - start]
            start += len(page)

    def read(self, partition: _Range) -> Iterator[tuple]:
        for f in self.features(partition.start, partition.end):
            yield {k: None if v is None else v if isinstance(v, str) else json.dumps(v) for k, v in (f.get("properties") or {}).items()}, json.dumps(f.get("geometry"))
