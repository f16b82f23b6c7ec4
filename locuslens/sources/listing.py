"""Listing of the files below a folder, as a data source: empty files count, contents are not opened.

The file reader of Spark leaves empty files out. Here the folders directly below ``path`` are listed by tasks, dealt
over a bounded number of partitions, by the file systems that Arrow can open (local, HDFS, object stores). A folder is
listed whole, so files should lie in many; ``make_files`` spreads them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def open_path(path: str):
    """The file system of a path or URI, and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


#: Partitions of a listing, folders that made files are spread over, and files in a batch of a listing.
PARTITIONS, FOLDERS, BATCH = 256, 1024, 1 << 14


@dataclass
class Folders(InputPartition):
    """Folders to list with all below them, and one to list its own files of, if any."""

    paths: tuple[str, ...]
    own: str | None = None


class ListingReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Folders]:
        """The folder's own files, and the folders in it."""
        from pyarrow import fs

        system, path = open_path(self.path)
        inside = sorted(f.path for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.type == fs.FileType.Directory)
        return [Folders((), path), *(Folders(tuple(inside[i::PARTITIONS])) for i in range(min(PARTITIONS, len(inside))))]

    def read(self, partition: Folders) -> Iterator:
        """``path, length`` of each file, in batches."""
        import pyarrow as pa
        from pyarrow import fs

        system, _ = open_path(self.path)
        for folder, deep in [(partition.own, False)] * bool(partition.own) + [(x, True) for x in partition.paths]:
            found = system.get_file_info(fs.FileSelector(folder, recursive=deep, allow_not_found=True))
            for at in range(0, len(found), BATCH):
                files = [f for f in found[at : at + BATCH] if f.is_file]
                yield pa.RecordBatch.from_arrays([pa.array([f.path for f in files], pa.string()), pa.array([f.size for f in files], pa.int64())], names=["path", "length"])


class FileListing(DataSource):
    """``format("file_listing")`` with option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, length bigint"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of every file below ``path``."""
    spark.dataSource.register(FileListing)
    return spark.read.format("file_listing").load(path)


def make_files(names: DataFrame, root: str) -> int:
    """Make an empty file for each of ``names (name)``, distinct paths below ``root``, by tasks; gives their number.

    The first part of a name decides in which of ``FOLDERS`` folders below ``root`` it lies, so that no folder, and no task
    of a listing, holds them all.
    """
    import pyarrow as pa

    spread = F.pmod(F.crc32(F.substring_index("name", "/", 1)), F.lit(FOLDERS))

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, where), made = open_path(root), set()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder = f"{where}/{path.rpartition('/')[0]}"
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                system.open_output_stream(f"{where}/{path}").close()
            made = made if len(made) <= FOLDERS else set()
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    # a given number of tasks: names are short, and adaptive execution would make all files in one
    tasks = 4 * names.sparkSession.sparkContext.defaultParallelism
    own = names.distinct().select(F.concat(spread.cast("string"), F.lit("/"), "name").alias("name")).repartition(tasks, F.substring_index("name", "/", 1))
    return own.mapInArrow(touch, "n bigint").agg(F.sum("n").alias("n")).head().n or 0
