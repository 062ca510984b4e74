"""A Spark data source for paged listing APIs: a partition for each category, its pages read one after the other.

    spark.dataSource.register(PagedListing)
    spark.read.format("paged_listing").options(url="https://host/{category}?page={page}", categories="oils,tires").load()

The last page is the one without items, or without new ids, or number ``max_pages``. Requests that fail with 429 or 5xx are
repeated after 1, 2, 4, ... seconds. A ``file://`` URL reads saved pages, a missing file being the end.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RETRIES = 5


def fetch(url: str) -> dict | list | None:
    """A page's JSON, or None where there is none."""
    for attempt in range(RETRIES):
        try:
            with urllib.request.urlopen(url, timeout=30) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as error:
            if error.code == 404:
                return None
            if error.code != 429 and error.code < 500 or attempt == RETRIES - 1:
                raise
            time.sleep(2**attempt)
        except urllib.error.URLError as error:
            if isinstance(error.reason, FileNotFoundError):
                return None
            if attempt == RETRIES - 1:
                raise
            time.sleep(2**attempt)
    return None


class Category(InputPartition):
    def __init__(self, name: str):
        self.name = name


class PagedListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "category string, page int, position int, id string, item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.url = options["url"]
        self.categories = [c.strip() for c in options.get("categories", "").split(",") if c.strip()]
        self.items, self.key = options.get("items", "items"), options.get("key", "id")
        self.max_pages = int(options.get("max_pages", "1000"))

    def partitions(self) -> list[InputPartition]:
        return [Category(name) for name in self.categories]

    def read(self, partition: Category) -> Iterator[tuple]:
        seen: set[str] = set()
        for page in range(1, self.max_pages + 1):
            body = fetch(self.url.format(category=partition.name, page=page))
            items = body.get(self.items, []) if isinstance(body, dict) else body or []
            fresh = [(k, str(item[self.key]), item) for k, item in enumerate(items) if str(item.get(self.key)) not in seen]
            if not fresh:
                return
            for position, key, item in fresh:
                seen.add(key)
                yield partition.name, page, position, key, json.dumps(item, ensure_ascii=False)
