"""A paged API as a stream of pages that can be broken off and taken up: no page is asked for twice.

The plan of pages is made once and kept in the store folder.  An offset is a number of pages of the plan; a
batch is a stretch of it, dealt to tasks that share one budget of requests a second.  A page is put
in the store before its rows go on, so a batch that is tried again, or a query that is started again, reads what has come
and asks for the rest.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .notes import place
from .readers import PagedReader, client_of


class Store:
    """Small files by name, each written once."""

    def __init__(self, path: str):
        self.fs, self.root = place(path)

    def get(self, name: str):
        from pyarrow.fs import FileType

        if self.fs.get_file_info(f"{self.root}/{name}").type == FileType.NotFound:
            return None
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def put(self, name: str, value) -> None:
        import uuid

        self.fs.create_dir(self.root, recursive=True)
        held = f"{self.root}/.{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(held) as f:
            f.write(json.dumps(value).encode())
        self.fs.move(held, f"{self.root}/{name}")


class Pages(InputPartition):
    def __init__(self, pages: list, wait: float):
        self.pages, self.wait = pages, wait


class PagedStreamReader(DataSourceStreamReader):
    def __init__(self, client, options: dict):
        self.client, self.size = client, int(options.get("size", 200))
        self.rate, self.tasks, self.batch = float(options.get("rate", 10)), int(options.get("tasks", 4)), int(options.get("pages_per_batch", 100))
        self.path, self.most, self.alphabet = options["store"], int(options.get("most", 10_000)), options.get("alphabet", "0123456789")
        self.at, self.plan = 0, None

    def _plan(self) -> list:
        """[prefix, page number] of all pages, the same whenever the query is started."""
        if self.plan is None:
            store = Store(self.path)
            self.plan = store.get("plan")
            if self.plan is None:
                buckets = PagedReader(self.client, self.most, self.size, self.alphabet).buckets()
                self.plan = [[b.prefix, n] for b in buckets for n in range(-(-b.total // self.size))]
                store.put("plan", self.plan)
            self.at = store.get("progress") or 0
        return self.plan

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        total = len(self._plan())
        self.at = min(total, self.at + self.batch)
        return {"pages": self.at}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self._plan()
        self.at = max(self.at, end["pages"])
        pages = self._plan()[start["pages"] : end["pages"]]
        each = -(-len(pages) // self.tasks) if pages else 0
        dealt = [pages[i : i + each] for i in range(0, len(pages), each)] if each else []
        return [Pages(p, len(dealt) / self.rate) for p in dealt] or [Pages([], 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        store, api, asked = Store(self.path), None, 0.0
        for prefix, number in partition.pages:
            name = f"page-{prefix}-{number}"
            rows = store.get(name)
            if rows is None:
                time.sleep(max(0.0, asked + partition.wait - time.monotonic()))
                asked, api = time.monotonic(), api or self.client()
                rows = [list(r) for r in api.page(prefix, number, self.size)]
                store.put(name, rows)
            yield from map(tuple, rows)

    def commit(self, end: dict) -> None:
        Store(self.path).put("progress", end["pages"])


class PagedStream(DataSource):
    """format("paged_stream"): as PagedSource, and options store (a folder that all tasks share), rate, tasks and pages_per_batch."""

    clients: dict = {}

    @classmethod
    def name(cls) -> str:
        return "paged_stream"

    def schema(self) -> str:
        return self.options.get("schema", "id string, payload string")

    def streamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(client_of(self.clients, self.options), dict(self.options))
