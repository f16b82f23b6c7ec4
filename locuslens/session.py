"""Session builder and table access shared by queries, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", app: str = "locuslens", **conf: str) -> SparkSession:
    """A UTC session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, deal: bool = True, waves: int = 1) -> DataFrame:
    """One of the given Parquet tables (a file or a folder of part files).

    With ``deal``, for plans with expensive rows, a table in fewer splits than cores is dealt over all cores; cheap
    ones read it as it is, without an exchange. With ``waves`` so is one in a few more splits than cores, of which the last few would
    keep most cores waiting.
    """
    compiled_methods(spark)
    short_batches(spark)
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    splits = rows.rdd.getNumPartitions() if deal else cores * waves
    return rows if splits >= cores * waves else rows.repartition(dealt_parts(splits, cores, waves))


def dealt_parts(splits: int, cores: int, waves: int) -> int:
    """One part a core for a small table, else some for each core."""
    return cores if splits <= cores else cores * waves


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark split generated code that the JVM would not compile.

    HotSpot interprets methods of over 8,000 bytes of code, at a tenth of the speed and less, and Spark's own limit is
    65,535: wide projections over texts (the reads, their classes) become one such method. Below this limit
    Spark splits each operator's expressions into small methods instead. A lower limit of the session stays.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > METHOD_BYTES:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)


METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def short_batches(spark: SparkSession) -> None:
    """Let Spark send texts to Python in batches of a few megabytes.

    By rows alone, 10,000 texts make one batch, which the JVM holds outside its heap (twice while it grows) and Python once
    more, in every task. A lower limit of the session stays.
    """
    if int(spark.conf.get(BATCH_LIMIT).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def in_memory_bytes(rows: DataFrame) -> int:
    """An upper estimate of the memory that ``rows`` take in a hash table, from a pass over them: fixed costs and text lengths."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in rows.schema.fields if f.dataType.simpleString() not in FIXED]
    width = 64 + 16 * len(rows.columns)
    return rows.agg(F.sum(sum(texts, F.lit(width).cast("bigint"))).alias("n")).head().n or 0


#: Types whose values have one size.
FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")

#: Folders written by ``cut`` and ``scratch_dir`` in this process, until ``remove_written``.
WRITTEN: list[str] = []
#: Names of tables that lie in such folders.
TABLES: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error, because
    executors would write to folders of their own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="locuslens-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def scratch_dir(spark: SparkSession, name: str = "files") -> str:
    """A new folder name below the shared folder."""
    WRITTEN.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return WRITTEN[-1]


def cut(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that no later step recomputes it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Delete what ``cut`` and ``scratch_dir`` wrote; results that still read it must be finished or written."""
    while TABLES:
        spark.sql(f"drop table if exists {TABLES.pop()}")
    while WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(WRITTEN.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
