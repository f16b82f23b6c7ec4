"""Reads take reference bases in place where the reference is small, and plain records travel to their fragment."""

from pyspark.sql import functions as F

from locuslens.operators import classify, intervals

BASES = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(3 * 4096 + 700))


def tiles(spark):
    # the second tile lacks its end, the last one is short
    rows = [("c", 0, BASES[:4096]), ("c", 1, BASES[4096:7000]), ("c", 2, BASES[8192:12288]), ("c", 3, BASES[12288:])]
    return spark.createDataFrame(rows, "chrom string, tile bigint, bases string").withColumn("bases", F.col("bases").cast("binary"))


def test_in_place_slices_equal_moved_ones(spark):
    starts = [0, 1, 255, 256, 400, 511, 512, 4000, 4095, 4096, 6800, 6990, 7000, 8100, 8192, 12280, 12900, 12987, 13000, -5]
    slices = [(i, c, a, a + n) for i, (c, a, n) in enumerate((c, a, n) for c in ("c", "d") for a in starts for n in (0, 1, 100, 255, 256, -3))] + [(9999, "c", None, 5)]
    asked = spark.createDataFrame(slices, "i int, chrom string, a bigint, b bigint")
    index = intervals.sequence_index(tiles(spark))
    near = {r.i: r.x for r in intervals.look_up_sequence(asked, index, "chrom", "a", "b", "x").collect()}
    moved = {r.i: r.x for r in intervals.fetch_sequence(asked, tiles(spark), "chrom", "a", "b", "x").collect()}
    assert near == moved and sum(x is not None for x in near.values()) > 40


def test_long_slices_are_still_whole(spark):
    asked = spark.createDataFrame([(1, "c", 10, 200), (2, "c", 8200, 12900), (3, "c", 300, 900), (4, "c", None, None)], "i int, chrom string, a bigint, b bigint")
    found = classify.fetch_asked(asked, tiles(spark), "a is not null", "a", "b", "x", intervals.sequence_index(tiles(spark)))
    assert {r.i: r.x for r in found.collect()} == {1: BASES[10:200], 2: BASES[8200:12900], 3: BASES[300:900], 4: None}


def test_large_reference_has_no_index(spark):
    assert intervals.sequence_index(tiles(spark), 10_000) is None


def test_records_travel_once_and_plain(spark):
    kinds = "sample string, locus string, qname string, ordinal bigint, chrom string, pos bigint, chrom2 string, pos2 bigint, strands string, ref string, alt string, type string"
    rows = [("s", "l", "q", 2, "c", 5, None, None, "++", None, "A", "INDEL"), ("s", "l", "q", 3, "c", 6, None, None, "++", "T", "AA", "INDEL"), ("s", "l", "q", 1, "c", 9, "d", 7, "+-", "", "", "BND")]
    found = classify.collapse_fragments(spark.createDataFrame(rows, kinds))
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = next(i for i, line in enumerate(lines) if "hashpartitioning" in line)
    assert not any("min_by" in line for line in lines[moved:])
    assert [tuple(r) for r in found.collect()] == [("s", "l", "q", "c", 5, "d", 7, "++", "T", "A", "INDEL")]
