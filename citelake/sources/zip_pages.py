"""Pages from a zip archive: `spark.read.format("zip_pages").load(path)` gives `(member, content)`, one row per member."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


@dataclass
class MemberRange(InputPartition):
    path: str
    first: int
    last: int


@contextmanager
def _archive(path: str) -> Iterator[zipfile.ZipFile]:
    """An archive on a local or any other file system by URI (`hdfs://`, `s3://`, ...); only the members asked for are read."""
    if "://" in path:
        from pyarrow.fs import FileSystem

        fs, inner = FileSystem.from_uri(path)
        with fs.open_input_file(inner) as file, zipfile.ZipFile(file) as archive:
            yield archive
    else:
        with zipfile.ZipFile(path.removeprefix("file:")) as archive:
            yield archive


class ZipPagesReader(DataSourceReader):
    def __init__(self, path: str, members_per_task: int):
        self.path, self.size = path, members_per_task

    def partitions(self) -> list[MemberRange]:
        with _archive(self.path) as archive:
            n = len(archive.infolist())
        return [MemberRange(self.path, i, min(n, i + self.size)) for i in range(0, n, self.size)] or [MemberRange(self.path, 0, 0)]

    def read(self, partition: MemberRange) -> Iterator[tuple[str, str]]:
        with _archive(partition.path) as archive:
            for info in archive.infolist()[partition.first : partition.last]:
                yield info.filename, archive.read(info).decode("utf-8")


class ZipPages(DataSource):
    """Options: `path` (on storage that all executors see), `membersPerTask` (default 8). Members keep archive order within a task."""

    @classmethod
    def name(cls) -> str:
        return "zip_pages"

    def schema(self) -> str:
        return "member string, content string"

    def reader(self, schema) -> ZipPagesReader:
        return ZipPagesReader(self.options["path"], int(self.options.get("memberspertask", self.options.get("membersPerTask", 8))))


def read_zip(spark: SparkSession, path: str, members_per_task: int = 8):
    spark.dataSource.register(ZipPages)
    return spark.read.format("zip_pages").option("membersPerTask", members_per_task).load(path)


def member_name(stem: str, page: int, offset: int) -> str:
    return f"{stem}-page-{page}-offset-{offset}.json"


# Compression methods by name.
COMPRESSION = {"deflate": zipfile.ZIP_DEFLATED, "bzip2": zipfile.ZIP_BZIP2, "lzma": zipfile.ZIP_LZMA}


def append_to_zip(pages, path: str, compression: str = "lzma") -> int:
    """Append pages `(member, content)` to an archive on the driver's file system, streaming them one at a time; returns how many.

    An archive has one directory at its end, so only one writer can append; parquet is the sink for many.
    """
    n = 0
    with zipfile.ZipFile(path, "a", COMPRESSION[compression]) as archive:
        for row in pages.select("member", "content").toLocalIterator():
            archive.writestr(row["member"], row["content"])
            n += 1
    return n
