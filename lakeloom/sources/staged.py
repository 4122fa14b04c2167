"""Staged pages as a Spark data source: what a fetcher left as JSON lines, one file a scope and dataset.

The seam between fetching and the engine: an adapter says which tasks there are and fetches one; stage() keeps what it
got, and spark.read.format("staged_pages") reads it back, many small files to a partition.
"""

from __future__ import annotations

import glob
import gzip
import json
import os
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of files that a partition takes, and those that a file counts as besides its own: 512 files at most.
PARTITION, OPENING = 4 << 20, 8 << 10
SCHEMA = "site_id string, dataset string, scope string, page int, status int, url string, body string, fetched_at timestamp"


class SiteAdapter(ABC):
    """How a site's pages are got. A task is a scope with its first page; fetch() gives its pages in order."""

    site_id: str

    @abstractmethod
    def tasks(self, dataset: str) -> Iterable[str]:
        """The scopes of a dataset."""

    @abstractmethod
    def fetch(self, dataset: str, scope: str) -> Iterator[Mapping]:
        """The pages of a scope: page, status, url, body, fetched_at (ISO text)."""

    def attachments(self, record: Mapping) -> Iterable[str]:
        """Addresses of files that belong to a record."""
        return ()


def stage(adapter: SiteAdapter, dataset: str, root: str, stop=None) -> int:
    """Fetches all scopes and keeps each as root/site/dataset/scope.jsonl.gz, whole or not at all; scopes that are there
    are left out. stop(pages so far) may end a scope after a page. Returns the number of pages."""
    n = 0
    for scope in adapter.tasks(dataset):
        path = os.path.join(root, adapter.site_id, dataset, f"{scope.replace('/', '_')}.jsonl.gz")
        if os.path.exists(path):
            continue
        os.makedirs(os.path.dirname(path), exist_ok=True)
        pages: list[dict] = []
        for page in adapter.fetch(dataset, scope):
            pages.append({"site_id": adapter.site_id, "dataset": dataset, "scope": scope, **page})
            if stop and stop(pages):
                break
        with gzip.open(f"{path}.part", "wt", encoding="utf-8") as out:
            out.writelines(json.dumps(p, ensure_ascii=False) + "\n" for p in pages)
        os.replace(f"{path}.part", path)
        n += len(pages)
    return n


class StagedFiles(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


def packed(sizes: Mapping[str, int], tasks: int) -> list[list[str]]:
    """All files in their order, as many to a part as PARTITION allows, fewer where that leaves some of `tasks` without
    work. A file stays whole, so one beyond PARTITION is a part of its own."""
    cost = {p: n + OPENING for p, n in sizes.items()}
    most = min(PARTITION, -(-sum(cost.values()) // max(1, tasks)))
    out, room = [], 0
    for path, n in cost.items():
        if not out or n > room:
            out.append([])
            room = most
        out[-1].append(path)
        room -= n
    return out


class StagedReader(DataSourceReader):
    def __init__(self, root: str, site: str, dataset: str, tasks: int):
        self.where, self.tasks = os.path.join(root, site, dataset, "*.jsonl.gz"), tasks

    def partitions(self) -> list[InputPartition]:
        return [StagedFiles(paths) for paths in packed({p: os.path.getsize(p) for p in sorted(glob.glob(self.where))}, self.tasks)]

    def read(self, partition: StagedFiles) -> Iterator[tuple]:
        from datetime import datetime

        for path in partition.paths:
            with gzip.open(path, "rt", encoding="utf-8") as lines:
                for text in lines:
                    p = json.loads(text)
                    when = p.get("fetched_at")
                    yield (p["site_id"], p["dataset"], p["scope"], p["page"], p.get("status", 200), p.get("url"), p.get("body"), datetime.fromisoformat(when) if when else None)


class StagedPages(DataSource):
    """Options: path (a folder that all executors see), site, dataset (both `*` unless given), tasks (how many should
    have work, 1 unless given)."""

    @classmethod
    def name(cls) -> str:
        return "staged_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return StagedReader(self.options["path"], self.options.get("site", "*"), self.options.get("dataset", "*"), int(self.options.get("tasks", 1)))


def read_staged(spark: SparkSession, root: str, site: str = "*", dataset: str = "*"):
    spark.dataSource.register(StagedPages)
    return spark.read.format("staged_pages").option("path", root).option("site", site).option("dataset", dataset).option("tasks", spark.sparkContext.defaultParallelism).load()
