"""All-or-nothing publishing of results per sample.

A set of results is written to a folder of its own and audited there: rows and a checksum observed while it was
written must equal those of the files. Only then a pointer file is exchanged, by one atomic rename, and readers
follow the pointer. A driver that dies at any earlier moment leaves readers with the old set whole. The pointer tells for
each sample the folder that holds it, so samples that a set lacks stay as they were.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "published.json"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _checksum(columns: list[str]) -> list[Column]:
    """Row count and an order-free sum of row hashes."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in sorted(columns))).cast("decimal(20,0)")).alias("sum")]


def read_pointer(spark: SparkSession, path: str) -> dict:
    """The published state: the folder of every sample, and the schema; empty before the first set."""
    where, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(where):
        return {}
    text = "\n".join(r.value for r in spark.read.text(f"{path}/{POINTER}").collect())  # one small file
    return json.loads(text)


def write_pointer(spark: SparkSession, path: str, state: dict) -> None:
    """Exchange the pointer by one rename that replaces the old one."""
    new, fs = _fs(spark, f"{path}/{POINTER}-{uuid.uuid4().hex}")
    old, _ = _fs(spark, f"{path}/{POINTER}")
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    replace = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    replace[0] = jvm.Options.Rename.OVERWRITE
    jvm.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(new), fs.makeQualified(old), replace)


def stage(results: DataFrame, path: str, sample: str) -> tuple[str, list[str]]:
    """Write a set to a new folder and audit it: the folder's name and its samples."""
    spark, name = results.sparkSession, f"set-{uuid.uuid4().hex}"
    seen = Observation(name)
    own = results.withColumn("_sample", F.col(sample).cast("string"))
    own.observe(seen, *_checksum(results.columns)).write.partitionBy("_sample").parquet(f"{path}/{name}")
    written = spark.read.schema(results.schema).parquet(f"{path}/{name}")
    found = written.agg(*_checksum(results.columns)).head().asDict()
    if found != seen.get:
        raise RuntimeError(f"the staged set {name} has {found}, but {seen.get} was written")
    samples = [r[0] for r in written.select(F.col(sample).cast("string")).distinct().collect()]  # one per folder
    return name, samples


def publish(results: DataFrame, path: str, sample: str = "sample") -> None:
    """Make ``results`` the published set of their samples; other samples stay."""
    spark = results.sparkSession
    name, samples = stage(results, path, sample)
    state = read_pointer(spark, path)
    folders = {**state.get("folders", {}), **{json.dumps(s): name for s in samples}}
    write_pointer(spark, path, {"folders": folders, "sample": sample, "schema": results.schema.jsonValue()})


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """All published rows, each sample from the folder that the pointer names."""
    from pyspark.sql.types import StructType

    state = read_pointer(spark, path)
    if not state:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema, found = StructType.fromJson(state["schema"]), None
    by_folder: dict[str, list] = {}
    for key, folder in state["folders"].items():
        by_folder.setdefault(folder, []).append(json.loads(key))
    for folder, samples in sorted(by_folder.items()):
        is_own = F.col("_sample").isin([s for s in samples if s is not None]) | (F.col("_sample").isNull() if None in samples else F.lit(False))
        rows = spark.read.schema(StructType([*schema.fields]).add("_sample", "string")).parquet(f"{path}/{folder}").where(is_own).drop("_sample")
        found = rows if found is None else found.unionByName(rows)
    return found if found is not None else spark.createDataFrame([], schema)


def remove_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders that the pointer no longer names; give their names."""
    kept = set(read_pointer(spark, path).get("folders", {}).values())
    where, fs = _fs(spark, path)
    gone = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith("set-") and s.getPath().getName() not in kept]
    for name in gone:
        fs.delete(_fs(spark, f"{path}/{name}")[0], True)
    return gone
