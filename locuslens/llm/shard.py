"""Uniform sharding with exact shard sizes through a hypergeometric communication matrix.

Documents fall into logical partitions by a hash of their key. How many rows each partition sends to each
shard is drawn at once from the exact law of a uniform shuffle, a multivariate hypergeometric matrix
whose margins are the partition sizes and the shard sizes (row counts at most one apart). Each partition
is permuted locally by a seeded hash, its first rows go to shard 0, the next to shard 1 and so on; after
the exchange every shard is permuted again, which gives the slots. Both permutations work on narrow rows
(key, size, checksum), and slots are numbered inside small hash ranges of a shard whose offsets come from
counts, so neither a large partition nor a large shard meets in one task.

Only the partition counts (at most ``partitions`` integers) reach the driver.

Defined results: null text counts as no bytes; repeated rows are placed separately, null keys too; fewer
rows than shards leave shards empty; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm.common import salted
from locuslens.session import cut


def hypergeometric(r: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One draw; beyond the library's 1e9 by Stadlober's ratio-of-uniforms rejection (1990)."""
    if good + bad < 10**9 or min(good, bad, n, good + bad - n) == 0:
        return int(good if n == good + bad else 0 if good == 0 or n == 0 else n if bad == 0 else r.hypergeometric(good, bad, n))
    few, many, m = min(good, bad), max(good, bad), min(n, good + bad - n)
    total, p = good + bad, min(good, bad) / (good + bad)
    centre = m * p + 0.5
    spread = math.sqrt((total - m) * n * p * (1 - p) / (total - 1) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    weigh = lambda z: math.lgamma(z + 1) + math.lgamma(few - z + 1) + math.lgamma(m - z + 1) + math.lgamma(many - m + z + 1)
    top, limit = weigh(math.floor((m + 1) * (few + 1) / (total + 2))), min(min(m, few) + 1, math.floor(centre + 16 * spread))
    while True:
        x, y = r.random(), r.random()
        w = centre + width * (y - 0.5) / max(x, 1e-300)
        if 0 <= w < limit and 2 * math.log(max(x, 1e-300)) <= top - weigh(z := math.floor(w)):
            break
    z = m - z if good > bad else z
    return good - z if m < n else z


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard, row by row from what the shards still lack."""
    r, total = np.random.default_rng(seed), sum(counts)
    lacking = [total // shards + (i < total % shards) for i in range(shards)]
    out = np.zeros((len(counts), shards), np.int64)
    for i, n in enumerate(counts):
        rest = sum(lacking)
        for s in range(shards):
            rest -= lacking[s]
            out[i, s] = got = hypergeometric(r, lacking[s], rest, n)
            lacking[s] -= got
            n -= got
    return out


def slots(df: DataFrame, group: str, order: list, width: int = 64) -> DataFrame:
    """``df`` with ``place``: 0, 1, ... inside ``group`` in the order of a hash ``_h`` and then ``order``.

    ``_h`` is cut into ``width`` ranges; counts of the ranges give offsets, windows number rows within one.
    """
    ranged = df.withColumn("_range", F.shiftrightunsigned("_h", 52) * width / 4096).withColumn("_range", F.col("_range").cast("int"))
    inside = F.row_number().over(W.partitionBy(group, "_range").orderBy("_h", *order)) - 1
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(group, "_range", before.alias("_before"))
    numbered = ranged.select("*", inside.alias("_in")).join(offsets, [group, "_range"])
    return numbered.withColumn("place", (F.col("_before") + F.col("_in")).cast("bigint")).drop("_range", "_in", "_before", "_h")


def shuffle_into_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40, partitions: int = 256, overhead: int = 16, seed: int = 29) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` per row of ``docs``; slots are gapless from 0 in every shard."""
    spark = docs.sparkSession
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(F.col(key), (F.octet_length(data) + overhead).cast("bigint").alias("size"), F.crc32(data).alias("text_crc32"))
    # rows of a key that very many share are told apart by what they hold, so that no partition or range holds them all
    salt = F.when(F.col("_copy").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64("size", "text_crc32", "_copy"))
    part = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("_salt"), F.lit(seed)), F.lit(partitions)).cast("int")
    rows = cut(salted(narrow, key).withColumn("_salt", salt).withColumn("part", part), "shard-rows")
    sizes = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}  # at most ``partitions`` rows
    counts = [sizes.get(i, 0) for i in range(partitions)]
    ends = communication_matrix(counts, shards, seed).cumsum(1)
    matrix = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(ends)], "part int, ends array<bigint>")
    ties = [F.col(key), "size", "text_crc32", "_salt"]
    once = slots(rows.withColumn("_h", F.xxhash64(F.col(key).cast("string"), "text_crc32", "_salt", F.lit(seed + 1))), "part", ties, 8)
    sent = once.join(F.broadcast(matrix), "part")  # ``partitions`` x ``shards`` integers, whatever the input
    sent = sent.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place")))).select(*ties, "shard")
    again = slots(sent.withColumn("_h", F.xxhash64(F.col(key).cast("string"), "text_crc32", "_salt", F.lit(seed + 2))), "shard", ties)
    return again.select(key, "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("place").alias("slot"))
