"""Distances to the nearest site where loci have grown together, clips found again, and slices that need no second pass."""

import random

from pyspark.sql import functions as F

from locuslens.operators import classify, intervals, loci
from locuslens.session import cut


def test_alleles_of_a_long_locus_meet_few_sites(spark):
    r = random.Random(71)
    places = {"a": sorted(r.sample(range(1000, 9000), 900)), "b": [50], "c": [10, 11, 5000, 5001, 90_000]}
    rows = spark.createDataFrame([(k, ";".join(map(str, v))) for k, v in places.items()], "locus string, positions string")
    near = loci.site_stretches(rows).agg(F.max(F.size("_near")).alias("n")).first().n
    assert near <= loci.STRETCH + 2 < len(places["a"])
    ends = [(k, r.choice([r.randint(-500, 12_000), r.randint(40_000, 120_000)]), "A" * r.choice([0, 1, 3, 200, 4000])) for k in places for _ in range(150)]
    ends += [("a", None, "A"), ("c", 4000, None), ("c", None, None)]
    alleles = spark.createDataFrame([(i, *x) for i, x in enumerate(ends)], "i int, locus string, pos bigint, ref string")

    def want(locus, pos, ref):
        return None if pos is None else min(abs(e - p) for p in places[locus] for e in ([pos] if ref is None else [pos, pos + len(ref) - 1]))

    expected = {i: want(*x) for i, x in enumerate(ends)}
    for few in (1000, 3):
        found = loci.with_distance(alleles, cut(rows, "loci"), few)
        assert found.columns == ["locus", "i", "pos", "ref", "distance"]
        assert {x.i: x.distance for x in found.collect()} == expected


def test_clips_are_found_again(spark):
    r = random.Random(72)
    bases = "".join(r.choices("AC", k=6000))
    tiles = spark.createDataFrame([("c", 0, bases[:4096]), ("c", 1, bases[4096:])], "chrom string, tile bigint, bases string").withColumn("bases", F.col("bases").cast("binary"))
    rows = []
    for i in range(300):
        pos, n, left = r.choice([0, 30, r.randint(100, 5500)]), r.randint(3, 120), r.random() < 0.5
        seq = r.choice([None, "", "".join(r.choices("AC", k=150)), bases[max(0, pos - 90) : pos + 60], "".join(r.choices("AC", k=30)) + bases[pos + 70 : pos + 90]])
        rows.append((i, "c", pos, pos + 30, seq, n if left else 0, 0 if left else n))
    pairs = spark.createDataFrame(rows, "i int, chrom string, pos bigint, `end` bigint, seq string, left_clip bigint, right_clip bigint")

    def want(i, chrom, pos, end, seq, left, right):
        a, b = (max(0, pos - 100), pos) if left > right else (end, end + 100)
        if max(left, right) < 5 or seq is None or a == b or b > len(bases):
            return None
        at = bases[a:b].rfind(seq[:left]) if left > right else bases[a:b].find(seq[-right:])
        return None if at < 0 else a + at

    expected = {x[0]: want(*x) for x in rows}
    for index in (None, intervals.sequence_index(tiles)):
        found = {x.i: x.hit for x in classify.reanchor_clips(pairs, tiles, 100, index=index).collect()}
        assert found == expected and sum(x is not None for x in found.values()) > 30


def test_records_are_read_once_without_longer_slices(spark):
    tiles = spark.createDataFrame([("c", 0, bytearray(b"ACGT" * 1024))], "chrom string, tile bigint, bases binary").repartition(64, "tile")
    index = intervals.sequence_index(tiles)
    asked = spark.createDataFrame([(1, "c", 10, 200, 190), (2, "c", None, None, None)], "i int, chrom string, a bigint, b bigint, n bigint")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = classify.fetch_asked(asked, tiles, "a is not null", "a", "b", "x", index, size="n")
    assert "Union" not in plan(found) and {r.i: r.x for r in found.collect()} == {1: ("ACGT" * 50)[10:200], 2: None}
    longer = asked.unionByName(spark.createDataFrame([(3, "c", 0, 900, 900)], asked.schema))
    both = classify.fetch_asked(cut(longer, "rows"), tiles, "a is not null", "a", "b", "x", index, size="n")
    assert {r.i: r.x for r in both.collect()} == {1: ("ACGT" * 50)[10:200], 2: None, 3: "ACGT" * 225}


def test_tiles_of_many_files_are_read_by_few_tasks(spark, monkeypatch):
    tiles = spark.createDataFrame([("c", i, bytearray(b"ACGT" * 1024)) for i in range(8)], "chrom string, tile bigint, bases binary").repartition(64, "tile")
    plans = []
    monkeypatch.setattr(intervals, "cut", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    intervals.sequence_index(tiles)
    assert f"Repartition {spark.sparkContext.defaultParallelism}, false" in plans[0]
