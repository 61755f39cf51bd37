"""Landed pages as a Spark data source of their own: `spark.read` and `spark.readStream.format("landed_pages")`.

A template for sources that Spark has no reader for: what can be listed is dealt into partitions that executors read, and
a stream's position is an offset that Spark keeps in the query's checkpoint.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# Executors and Spark's planner get the classes themselves, so that this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SHAPE = "page bigint, file string, value string"
_ARROW = pa.schema([("page", pa.int64()), ("file", pa.string()), ("value", pa.string())])


@dataclass
class Pages(InputPartition):
    """(page, path) of the files one task reads."""

    files: list[tuple[int, str]]


def page_of(path: str) -> int | None:
    """The number in a folder `page=<n>`, else the last run of digits in the file's name; None for what is no page."""
    folder, name = path.rsplit("/", 2)[-2:] if path.count("/") > 1 else ("", path.rsplit("/", 1)[-1])
    if name.startswith(("_", ".")):
        return None
    found = re.fullmatch(r"page=(\d+)", folder) or re.search(r"(\d+)\D*$", name)
    return int(found[1]) if found else None


class _Folder:
    """What both readers share: the landed files, and how a task reads some of them."""

    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("landed_pages needs a path")
        self.path = options["path"]
        self.per_partition = int(options.get("pagesPerPartition", 64))
        self.first_page = int(options.get("firstPage", 0))

    def landed(self) -> list[tuple[int, str]]:
        """(page, path) of every landed file, in order."""
        where, root = fs.FileSystem.from_uri(self.path) if ":" in self.path else (fs.LocalFileSystem(), self.path)
        listed = where.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        pages = [(page_of(f.path), f.path) for f in listed if f.type == fs.FileType.File]
        return sorted((page, path) for page, path in pages if page is not None)

    def dealt(self, files: list[tuple[int, str]]) -> list[Pages]:
        return [Pages(files[k : k + self.per_partition]) for k in range(0, len(files), self.per_partition)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        where = fs.FileSystem.from_uri(self.path)[0] if ":" in self.path else fs.LocalFileSystem()
        for page, path in partition.files:
            with where.open_input_stream(path) as stream:
                text = stream.read().decode().strip()
            yield pa.record_batch([pa.array([page]), pa.array([path]), pa.array([text])], schema=_ARROW)


class PagesReader(_Folder, DataSourceReader):
    """Everything that has landed."""

    def partitions(self) -> list[Pages]:
        return self.dealt(self.landed()) or [Pages([])]


class PagesStreamReader(_Folder, DataSourceStreamReader):
    """Pages in the order of their numbers. The offset is the next number; a page that has not landed holds back those after it."""

    def initialOffset(self) -> dict:
        return {"next": self.first_page}

    def latestOffset(self) -> dict:
        following = None
        for page in sorted({page for page, _ in self.landed() if page >= self.first_page}):
            if following is not None and page != following:
                break
            following = page + 1
        return {"next": self.first_page if following is None else following}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        files = [(page, path) for page, path in self.landed() if start["next"] <= page < end["next"]]
        missing = set(range(start["next"], end["next"])) - {page for page, _ in files}
        if missing:
            raise ValueError(f"{self.path}: page {min(missing)} is gone or has not landed, but later ones have")
        return self.dealt(files)


class LandedPages(DataSource):
    """Files of one page each. Options: path, pagesPerPartition (64) and, for a stream, firstPage (0)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return _SHAPE

    def reader(self, schema) -> DataSourceReader:
        return PagesReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagesStreamReader(self.options)


def read_landed(spark: SparkSession, path: str, stream: bool = False, **options: object) -> DataFrame:
    """(page, file, value) of the landed pages, once or as a stream; `api_pages.scan_api_pages` opens them."""
    spark.dataSource.register(LandedPages)
    reader = spark.readStream if stream else spark.read
    return reader.format(LandedPages.name()).options(**options).load(path)
