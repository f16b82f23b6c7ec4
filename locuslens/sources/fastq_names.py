"""The first read names of FASTQ files, as a data source that stops reading a file early.

One partition per file; a partition reads its file as a stream, plain or gzip, and ends after ``records``
names, so the work follows the number of files and not their size. Files are found below ``path`` by the file
systems that Arrow can open (local, HDFS, object stores).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from locuslens.sources.listing import open_path

SCHEMA = "file string, row bigint, name string, consumed bigint"
SUFFIXES = (".fastq", ".fq", ".fastq.gz", ".fq.gz", ".txt", ".txt.gz")


@dataclass
class OneFile(InputPartition):
    """A file of the source, as a path of its file system."""

    path: str


class NamesReader(DataSourceReader):
    def __init__(self, path: str, records: int, chunk: int) -> None:
        self.path, self.records, self.chunk = path, records, chunk

    def partitions(self) -> list[OneFile]:
        """One per file; an empty folder still needs one."""
        from pyarrow import fs

        system, path = open_path(self.path)
        info = system.get_file_info(path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        hidden = lambda p: any(part.startswith(("_", ".")) for part in p.removeprefix(path).split("/"))
        return [OneFile(f.path) for f in found if f.is_file and f.path.endswith(SUFFIXES) and not hidden(f.path)] or [OneFile("")]

    def read(self, partition: OneFile) -> Iterator[tuple[str, int, str, int]]:
        """``file, row, name`` and the bytes of the file that were read so far."""
        import pyarrow as pa

        if not partition.path:
            return
        system, _ = open_path(self.path)
        with system.open_input_file(partition.path) as raw:
            stream = pa.CompressedInputStream(raw, "gzip") if partition.path.endswith(".gz") else raw
            line, rest = 0, b""
            while block := stream.read(self.chunk):
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                for text in lines:
                    if line % 4 == 0:
                        yield partition.path, line // 4, text.rstrip(b"\r").decode("utf-8", "replace"), raw.tell()
                    line += 1
                    if line == 4 * self.records:
                        return
            if rest and line % 4 == 0:
                yield partition.path, line // 4, rest.rstrip(b"\r").decode("utf-8", "replace"), raw.tell()


class FastqNames(DataSource):
    """``format("fastq_names")``; options ``path``, ``records`` (1,000 a file) and ``chunk`` (bytes asked at once)."""

    @classmethod
    def name(cls) -> str:
        return "fastq_names"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> NamesReader:
        return NamesReader(self.options["path"], int(self.options.get("records", 1000)), int(self.options.get("chunk", 1 << 16)))


def read_fastq_names(spark: SparkSession, path: str, records: int = 1000) -> DataFrame:
    """The first ``records`` names of every file below ``path``: file, row, name, and the bytes read up to there."""
    spark.dataSource.register(FastqNames)
    return spark.read.format("fastq_names").option("records", records).load(path)
