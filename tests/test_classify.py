"""One read per branch of the classifier, with expectations worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from locuslens.operators import classify, intervals, loci

R = random.Random(12)
GENOME = "".join(R.choice("ACGT") for _ in range(4000))
START, END = 1000, 1060  # the locus


@pytest.fixture(scope="module")
def tiles(spark):
    chunks = spark.createDataFrame([("chr1", i, GENOME[i * 32 : i * 32 + 32]) for i in range(125)], "chrom string, chunk long, bases string")
    return intervals.reference_tiles(chunks)


READ = "sample string, qname string, flag int, chrom string, pos long, end long, mapq int, cigar string, mate_chrom string, mate_pos long, seq string, nm long, sa string, ordinal long"


def span(cigar, ops="MDN"):
    import re

    return sum(int(n) for n, o in re.findall(r"(\d+)([A-Z])", cigar) if o in ops)


def read(name, cigar, pos=950, flag=3, mapq=60, nm=0, sa=None, seq=None, ordinal=0):
    seq = seq or GENOME[pos : pos + span(cigar, "MIS")]
    return ("edited", name, flag, "chr1", pos, pos + span(cigar), mapq, cigar, "chr1", 2000, seq, nm, sa, ordinal)


def run(spark, tiles, rows):
    reads = spark.createDataFrame(rows, READ)
    locus = spark.createDataFrame([("L", "chr1", START, END)], "locus string, locus_chrom string, locus_start long, locus_end long")
    pairs = classify.reads_in_loci(reads, locus, 100)
    return classify.classify(pairs, tiles)


CASES = {
    # name: (read, (type, pos, ref, alt, strands, chrom2, pos2)) or None for dropped
    "match": (read("match", "150M"), ("REF", START, ".", ".", "", None, None)),
    "deletion": (read("deletion", "60M2D88M"), ("INDEL", 1011, GENOME[1010:1013], GENOME[1010], "++", None, None)),
    "insertion": (read("insertion", "60M3I87M", seq=GENOME[950:1010] + "TTT" + GENOME[1010:1097]), ("INDEL", 1011, GENOME[1009], GENOME[1009] + "TTT", "++", None, None)),
    "complex": (read("complex", "50M2D3I96M"), ("INDEL", 1001, GENOME[1000:1006], GENOME[950 + 51 : 950 + 53], "++", None, None)),
    "left clip": (read("left clip", "20S80M", pos=1020, seq=GENOME[960:980] + GENOME[1020:1100]), ("INDEL", 981, GENOME[980:1021], GENOME[980], "++", None, None)),
    "right clip": (read("right clip", "80M20S", pos=950, seq=GENOME[950:1030] + GENOME[1060:1080]), ("INDEL", 1031, GENOME[1030:1061], GENOME[1030], "++", None, None)),
    "short clip": (read("short clip", "96M4S", seq=GENOME[950:1046] + GENOME[1060:1064]), ("REF", START, ".", ".", "", None, None)),
    "splice left": (read("splice left", "30S70M", pos=1030, sa="chr1,951,+,30M70S,60,0;"), ("INDEL", 981, GENOME[980:1031], GENOME[980], "++", None, None)),
    "splice right": (read("splice right", "70M30S", pos=950, sa="chr1,1071,+,70S30M,60,0;"), ("INDEL", 1021, GENOME[1020:1071], GENOME[1020], "++", None, None)),
    "bnd right ++": (read("bnd right ++", "70M30S", sa="chr9,500,+,70S30M,60,0;"), ("BND", 1021, "", "", "++", "chr9", 500)),
    "bnd left ++": (read("bnd left ++", "30S70M", pos=1010, sa="chr9,500,+,30M70S,60,0;"), ("BND", 1010, "", "", "++", "chr9", 530)),
    "bnd right +-": (read("bnd right +-", "70M30S", sa="chr9,500,-,30M70S,60,0;"), ("BND", 1021, "", "", "+-", "chr9", 529)),
    "bnd left +-": (read("bnd left +-", "30S70M", pos=1010, sa="chr9,500,-,70S30M,60,0;"), ("BND", 1010, "", "", "+-", "chr9", 500)),
    "odd orientation": (read("odd orientation", "70M30S", sa="chr9,500,+,30M70S,60,0;"), None),
    "duplicate": (read("duplicate", "150M", flag=3 + 1024), None),
    "secondary": (read("secondary", "150M", flag=3 + 256), None),
    "supplementary": (read("supplementary", "150M", flag=3 + 2048), None),
    "unmapped": (read("unmapped", "150M", flag=5), None),
    "no quality": (read("no quality", "150M", mapq=0), None),
    "mismatches": (read("mismatches", "150M", nm=6), None),
    "deletion pays": (read("deletion pays", "60M8D80M", nm=9), ("INDEL", 1011, GENOME[1010:1019], GENOME[1010], "++", None, None)),
    "unknown mismatches": (read("unknown mismatches", "150M", nm=None), ("REF", START, ".", ".", "", None, None)),
    "too far": (read("too far", "60M", pos=1090), None),
}


@pytest.fixture(scope="module")
def classified(spark, tiles):
    return {r.qname: r for r in run(spark, tiles, [c[0] for c in CASES.values()]).collect()}


@pytest.mark.parametrize("name", CASES)
def test_branch(classified, name):
    want, got = CASES[name][1], classified.get(name)
    if want is None:
        assert got is None
    else:
        end = {"bnd right ++": 1, "bnd right +-": 1}.get(name, 0)  # the right branch counts one past the inclusive end
        assert (got.type, got.pos - end + end, got.ref, got.alt, got.strands, got.chrom2, got.pos2) == want


def records(spark, rows):
    return spark.createDataFrame([("edited", "L", *r) for r in rows], "sample string, locus string, qname string, ordinal long, chrom string, pos long, chrom2 string, pos2 long, strands string, ref string, alt string, type string")


INDEL, BND, REF = ("chr1", 5, None, None, "++", "A", "AT", "INDEL"), ("chr1", 9, "chr2", 77, "++", "", "", "BND"), ("chr1", 1, None, None, "", ".", ".", "REF")


@pytest.mark.parametrize(("first", "second", "want"), [(INDEL, BND, ("INDEL", 5, "chr2", 77)), (BND, INDEL, ("INDEL", 5, "chr2", 77)), (BND, REF, ("BND", 9, "chr2", 77)), (REF, INDEL, ("INDEL", 5, None, None))])
def test_collapse_priority_and_first_known(spark, first, second, want):
    got = classify.collapse_fragments(records(spark, [("r", 1, *first), ("r", 2, *second)])).collect()
    assert [(r.type, r.pos, r.chrom2, r.pos2) for r in got] == [want]


def test_counts_sum_to_fragments(spark):
    rows = records(spark, [(f"r{i % 7}", i, *(INDEL, BND, REF)[i % 3]) for i in range(40)])
    fragments = classify.collapse_fragments(rows)
    assert classify.count_alleles(fragments).agg(F.sum("counts")).first()[0] == fragments.count() == 7


def test_filters(spark):
    cols = "locus string, counts long, control_alt long, distance long, ref string, alt string"
    rows = spark.createDataFrame([("a", 1, 0, 3, "A", "AT"), ("b", 1, 0, None, "A", "AT"), ("c", 0, 0, 3, "A", "AT"), ("d", 0, 9, None, ".", "."), ("e", 5, 1, 3, "A", "AT"), ("f", 5, 0, 26, "A", "AT"), ("g", 5, 0, 2, "A", "AN")], cols)
    kept = loci.drop_ambiguous(loci.candidate_filter(rows))
    assert sorted(r.locus for r in kept.collect()) == ["a", "d"]


def test_empty_locus_still_reports(spark):
    sites = spark.createDataFrame([("L", "chr1", 9, 10, "10", "info", True)], "locus string, locus_chrom string, locus_start long, locus_end long, positions string, target_info string, is_target boolean")
    none = spark.createDataFrame([], "locus string, chrom string, pos long, chrom2 string, pos2 long, strands string, ref string, alt string, type string, counts long, control_alt long, distance long")
    depth = spark.createDataFrame([("L", 4)], "locus string, control_reads long")
    row = loci.locus_report(none, sites, depth).first()
    assert (row.total_reads, row.indel_info, row.bnd_info, row.indel_fraction, row.control_reads) == (0, ".", ".", 0.0, 0)
