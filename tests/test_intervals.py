"""Joins of many rows with a list of intervals, held by every executor or shuffled."""

import random

import pytest

from locuslens.operators import intervals
from locuslens.session import in_memory_bytes


@pytest.fixture(scope="module")
def both(spark):
    r = random.Random(17)
    rows = [(i, f"chr{r.randint(1, 3)}", a := r.randint(0, 60_000), a + r.randint(0, 900)) for i in range(600)]
    rows += [(600, None, 5, 9), (601, "chr1", None, 9), (602, "chr9", 5, 9), (603, "chr1", 0, 70_000)]
    spans = [(f"s{i}", f"chr{r.randint(1, 3)}", a := r.randint(0, 60_000), a + r.choice((0, 1, 50, 5000, 20_000))) for i in range(80)]
    spans += [("s80", "chr1", 0, 70_000), ("s80", "chr1", 0, 70_000), ("s81", None, 0, 9)]
    left = spark.createDataFrame(rows, "row int, chrom string, start long, end long")
    right = spark.createDataFrame(spans, "name string, c string, a long, b long")
    want = sorted((i, n) for i, c, s, e in rows for n, d, a, b in spans if c is not None and s is not None and c == d and s < b and a < e)
    return left, right, want


ON = (("chrom", "start", "end"), ("c", "a", "b"))


@pytest.mark.parametrize("most", [intervals.INDEX_BYTES, 0])
def test_index_and_shuffle_give_every_pair_once(both, most):
    left, right, want = both
    met = intervals.indexed_join(left, right, *ON, most_bytes=most)
    assert sorted((r.row, r.name) for r in met.collect()) == want
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most > 0) and ("Exchange hashpartitioning" in plan) == (most == 0)


def test_overlap_join_gives_the_same(both):
    left, right, want = both
    assert sorted((r.row, r.name) for r in intervals.overlap_join(left, right, *ON).collect()) == want


def test_size_is_measured_not_guessed(spark):
    short, long_ = spark.createDataFrame([("x",)] * 50, "t string"), spark.createDataFrame([("x" * 10_000,)] * 50, "t string")
    assert in_memory_bytes(short) < 20_000 and in_memory_bytes(long_) > 500_000 and in_memory_bytes(short.limit(0)) == 0


def test_reads_are_not_moved_for_a_small_list(spark, tmp_path):
    """The registered query reads, joins and projects without any exchange of reads."""
    from locuslens.registry import QUERIES

    plan = QUERIES["reads_in_loci"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "RoundRobin" not in plan
