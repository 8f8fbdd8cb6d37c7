"""WARC files (.warc, .warc.gz) as a Python data source: each file is streamed record by record, never held whole."""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, html string"
#: Bodies beyond are skipped while they are read.
MOST_BYTES = 64 << 20


def _lines(stream: io.BufferedIOBase) -> Iterator[bytes]:
    while (line := stream.readline(1 << 16)) and line.strip():
        yield line


def responses(stream: io.BufferedIOBase) -> Iterator[tuple[str, str]]:
    """(url, body) of the response records of a stream of WARC records, one record in memory at a time."""
    while line := stream.readline(1 << 16):
        if not line.startswith(b"WARC/1."):
            continue
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in _lines(stream))}
        size = int(fields.get(b"content-length") or 0)
        if fields.get(b"warc-type") != b"response" or size > MOST_BYTES:
            while size > 0 and (skipped := stream.read(min(size, 1 << 20))):
                size -= len(skipped)
            continue
        body = stream.read(size).partition(b"\r\n\r\n")[2]
        yield fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), body.decode("utf-8", "replace")


def opened(file) -> io.BufferedIOBase:
    """A binary file's records, decompressed member by member if it is compressed."""
    import gzip

    start = file.peek(2)[:2] if hasattr(file, "peek") else b""
    return io.BufferedReader(gzip.GzipFile(fileobj=file)) if start == b"\x1f\x8b" else file


class WarcReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self):
        """A partition for each file."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        found = system.get_file_info(fs.FileSelector(root, recursive=True)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        return [InputPartition(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and (".warc" in f.base_name)]

    def read(self, partition):
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()
        with system.open_input_stream(partition.value, compression=None) as raw:
            yield from responses(opened(io.BufferedReader(raw)))


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder)"""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"])


def records(spark: SparkSession, folder: str) -> DataFrame:
    """(url, html) of the response records of WARC files."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").load(folder)
