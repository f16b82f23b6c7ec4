"""The packed reference gives every base back, and lookups leave it where it is."""

import random

import pytest
from pyspark.sql import functions as F

from locuslens.operators import intervals
from locuslens.session import TABLES, remove_written
from locuslens.sources.reference_store import packed_tiles, store_reference, unpacked


@pytest.fixture(scope="module")
def genome(spark):
    r = random.Random(60)
    text = "".join(r.choices("ACGT", k=3 * intervals.TILE - 777))
    for _ in range(60):
        at, n = r.randrange(len(text) - 400), r.choice((1, 2, 17, 300))
        part = text[at : at + n]
        text = text[:at] + r.choice((part.lower(), "N" * n, "n" * n, "R", "NNRRYnnacgt")) + text[at:]
    text = text[: 3 * intervals.TILE - 5]
    chunks = [(c, i, text[i * 32 : i * 32 + 32]) for c in ("chr1", "chr2") for i in range(-(-len(text) // 32))]
    return text, intervals.reference_tiles(spark.createDataFrame(chunks, "chrom string, chunk long, bases string"))


def test_every_slice_comes_back(spark, genome):
    text, tiles = genome
    r = random.Random(61)
    asked = [(a := r.randrange(len(text)), r.choice((1, 2, 15, 16, 17, 150, 5000))) for _ in range(200)] + [(0, len(text)), (len(text) - 1, 1), (len(text) - 1, 2), (4095, 2)]
    rows = spark.createDataFrame([("chr1", a, a + n) for a, n in asked] + [("chr1", None, 4), ("chr3", 0, 4), (None, 0, 4), ("chr1", 5, 5), ("chr1", -3, 5)], "chrom string, a long, b long")
    stored = store_reference(tiles, buckets=5)
    found = intervals.fetch_sequence(rows, stored, "chrom", "a", "b", "s")
    got = {(x.chrom, x.a, x.b): x.s for x in found.collect()}
    assert all(got["chr1", a, a + n] == (text[a : a + n] if a + n <= len(text) else None) for a, n in asked)
    assert got["chr1", None, 4] is got["chr3", 0, 4] is got[None, 0, 4] is got["chr1", 5, 5] is got["chr1", -3, 5] is None
    same = {(x.chrom, x.a, x.b): x.s for x in intervals.fetch_sequence(rows, tiles, "chrom", "a", "b", "s").collect()}
    assert same == got


def test_tiles_take_two_bits_a_base(genome):
    _, tiles = genome
    packed = packed_tiles(tiles).select(F.octet_length("packed").alias("n"), "size", unpacked(F.lit(0), F.col("size")).alias("all"), "chrom", "tile")
    whole = packed.join(tiles, ["chrom", "tile"]).select("n", "size", (F.col("all") == F.col("bases").cast("string")).alias("same")).collect()
    assert all(r.same and r.n == 4 * -(-r["size"] // 16) for r in whole)


def test_lookups_do_not_shuffle_the_tiles(spark, genome):
    _, tiles = genome
    stored = store_reference(tiles, buckets=4)
    rows = spark.range(1000).select(F.concat(F.lit("chr"), F.col("id") % 2 + 1).alias("chrom"), F.col("id").alias("a"), (F.col("id") + 20).alias("b"))
    found = intervals.fetch_sequence(rows, stored, "chrom", "a", "b", "s")
    assert found.where("s is not null").count() == 1000
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = next(i for i, line in enumerate(plan) if "SelectedBucketsCount" in line or "Bucketed: true" in line or "reference_" in line)
    above, at = [], depth(plan[scan])
    for line in reversed(plan[:scan]):
        if depth(line) < at:
            above, at = [*above, line], depth(line)
        if "SortMergeJoin" in line and depth(line) == at:
            break
    assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)


def test_tables_are_dropped(spark, genome):
    store_reference(genome[1], buckets=2)
    name = TABLES[-1]
    assert spark.catalog.tableExists(name)
    remove_written(spark)
    assert not spark.catalog.tableExists(name)
