"""Helpers of the corpus operators: components, prefix scans, text rules."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuslens.session import cut

#: ASCII white space of the contracts, as a class body for Java and Python patterns.
SPACE = r"\x20\x09-\x0D"
WORD_PATTERN = f"[^{SPACE}]+"


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512, most_bytes: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``rows`` and about ``most_bytes`` (or one longer row), so that Python holds few long texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            waiting = [batch.slice(at, rows)]
            while waiting:
                part = waiting.pop()
                if part.num_rows > 1 and part.nbytes > most_bytes:
                    half = part.num_rows // 2
                    waiting += [part.slice(half), part.slice(0, half)]
                else:
                    yield part


def return_memory() -> None:
    """Give memory that this Python worker no longer uses back to the system: workers go on to the next operator's tasks, and what allocators keep would add up."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def salted(df: DataFrame, key: str, share: int = 1000, least: int = 1000) -> DataFrame:
    """``df`` (narrow rows) with ``_copy``: null, but for the rows of a key that holds more than ``least`` rows and more
    than one in ``share`` of all 0, 1, ... among the rows that are equal in every column.

    Whole rows and their numbers tell the rows of a frequent key apart, and as equal rows are interchangeable, the
    result is the same set of rows whatever the order and partitions of the input. Equal rows are numbered
    inside the task that wrote them, and counts place the tasks, so no task sees all of them. Fewer than ``share`` keys
    can be so frequent, so they are broadcast, whatever the input.
    """
    columns = df.columns
    rows = cut(df.select("*", F.monotonically_increasing_id().alias("_at")), "salted-rows")
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_c")).where(F.col("_c") > least)
    total = rows.agg(F.count("*").alias("_total"))  # one row
    hot = counts.join(F.broadcast(total), F.col("_c") * share > F.col("_total")).select("_key")
    is_hot = F.col(key).eqNullSafe(F.col("_key"))
    own = rows.join(F.broadcast(hot), is_hot, "left_semi").withColumns({"_part": F.shiftright("_at", 33), "_same": F.sha2(F.to_json(F.struct(*columns)), 256)})
    number = F.row_number().over(W.partitionBy("_same", "_part").orderBy("_at")) - 1
    sizes = own.groupBy("_same", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("_same").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = own.withColumn("_in", number).join(sizes.select("_same", "_part", before.alias("_before")), ["_same", "_part"])
    numbered = numbered.select(*columns, (F.col("_before") + F.col("_in")).cast("bigint").alias("_copy"))
    cold = rows.join(F.broadcast(hot), is_hot, "left_anti").select(*columns, F.lit(None).cast("bigint").alias("_copy"))
    return cold.unionByName(numbered)


def with_fields(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` followed by the fields of a DDL string."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda.

    The optimiser inlines a projected column into the lambdas above it, which would compute it once per
    array element; a lambda variable is bound to a finished value.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def connected(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """``(id, component)`` for the vertices of ``edges (a, b)``: the smallest id that each can reach.

    Labels travel along edges as partial minima and then jump to the label's own label, so the number
    of rounds follows the logarithm of the longest path. Each round is cut; a hot vertex only makes a
    join partition large, which adaptive execution splits. Empty edges give an empty result.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), f"{name}-labels")
    for _ in range(rounds):
        sent = both.join(labels.withColumnRenamed("id", "a"), "a").groupBy(F.col("b").alias("id")).agg(F.min("component").alias("m"))
        near = labels.join(sent, "id", "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("component"))
        hop = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        after = cut(near.join(hop, "component", "left").select("id", "old", F.least("component", F.coalesce("far", "component")).alias("component")), f"{name}-labels")
        labels = after.drop("old")
        if after.where(F.col("old") != F.col("component")).isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def joined_components(labels: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``labels`` of ``connected`` after further ``edges (a, b)``: only edges between different components are followed,
    between whole components, so a few late edges cost no walk along all earlier ones. Vertices that are new are added."""
    of = lambda side: labels.select(F.col("id").alias(side), F.col("component").alias(f"{side}_own"))
    between = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_own", "a").alias("a"), F.coalesce("b_own", "b").alias("b")).where("a != b")
    merged = connected(between.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    moved = labels.join(merged.select(F.col("id").alias("component"), F.col("component").alias("into")), "component", "left").select("id", F.coalesce("into", "component").alias("component"))
    return cut(moved.unionByName(merged.join(labels.select("id"), "id", "left_anti")), f"{name}-joined")


def prefix_scan(df: DataFrame, group: str, order: str, sums: tuple[str, ...] = (), maxima: tuple[str, ...] = (), width: int = 1024) -> DataFrame:
    """Exclusive prefix sums and maxima by ``order`` (0, 1, ...) inside ``group``, in two levels.

    Rows are combined in runs of ``width`` first, runs are scanned, and the run's own prefix is added,
    so one task sees at most the rows of a run or the runs of a group. Adds ``<column>_before`` (0 first).
    """
    run = df.withColumn("_run", F.floor(F.col(order) / width))
    inside = W.partitionBy(group, "_run").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    across = W.partitionBy(group).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    how = {c: F.sum for c in sums} | {c: F.max for c in maxima}
    zero = F.lit(0)
    runs = run.groupBy(group, "_run").agg(*(f(c).alias(c) for c, f in how.items()))
    runs = runs.select(group, "_run", *(F.coalesce(f(c).over(across), zero).alias(f"_{c}_run") for c, f in how.items()))
    rows = run.select("*", *(F.coalesce(f(c).over(inside), zero).alias(f"_{c}_in") for c, f in how.items()))
    both = [(F.col(f"_{c}_in") + F.col(f"_{c}_run") if c in sums else F.greatest(f"_{c}_in", f"_{c}_run")).alias(f"{c}_before") for c in how]
    return rows.join(runs, [group, "_run"]).select(*(F.col(c) for c in df.columns), *both)
