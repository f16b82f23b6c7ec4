"""The report and its queries score alleles in the control."""

import random

import pytest

from locuslens import adapters
from locuslens.operators import intervals
from locuslens.plans import locus_queries


@pytest.fixture
def small(spark, monkeypatch):
    """Three deletions of 3, 4 and 5 bases in one locus, one of them far from the site; control reads carry those of 3 and 5 bases."""
    r = random.Random(8)
    genome = "".join(r.choice("ACGT") for _ in range(960))
    tiles = intervals.reference_tiles(spark.createDataFrame([("chr1", i, genome[i * 32 : i * 32 + 32]) for i in range(30)], "chrom string, chunk long, bases string"))
    cut = lambda at, n: (at + 1, genome[at : at + n + 1], genome[at])
    rows = [("edited", "L", "chr1", *cut(300, 3), "INDEL", 4), ("edited", "L", "chr1", *cut(310, 4), "INDEL", 1), ("edited", "L", "chr1", *cut(370, 5), "INDEL", 1), ("edited", "L", "chr1", 290, ".", ".", "REF", 7)]
    alleles = spark.createDataFrame(rows, "sample string, locus string, chrom string, pos long, ref string, alt string, type string, counts long").selectExpr("sample", "locus", "chrom", "pos", "string(null) as chrom2", "bigint(null) as pos2", "if(type = 'INDEL', '++', '') as strands", "ref", "alt", "type", "counts")
    site = spark.createDataFrame([("L", "chr1", 290, 380, "305", "info", True)], "locus string, locus_chrom string, locus_start long, locus_end long, positions string, target_info string, is_target boolean")
    reads = [(f"c{at}", 3, "chr1", at - 50, at + n + 51, 60, f"51M{n}D50M", genome[at - 50 : at + 1] + genome[at + n + 1 : at + n + 51], i, "control") for i, (at, n) in enumerate([(300, 3), (370, 5)])]
    reads = spark.createDataFrame(reads, "qname string, flag int, chrom string, pos long, end long, mapq int, cigar string, seq string, ordinal long, sample string")
    monkeypatch.setattr(locus_queries, "allele_rows", lambda *_: alleles)
    monkeypatch.setattr(locus_queries, "locus_rows", lambda *_: site)
    monkeypatch.setattr(locus_queries, "view", lambda *_: reads)
    monkeypatch.setattr(adapters, "reference", lambda *_: tiles)
    return spark


def test_alleles_of_the_control_leave_the_report(small):
    row = locus_queries.locus_report(small, "").first()
    assert (row.total_reads, row.indel_reads, row.indel_count, row.control_reads) == (8, 1, 1, 2)
    assert row.indel_info.startswith("chr1:311:") and row.indel_info.endswith(":1:0:6")


def test_candidates_are_not_in_the_control(small):
    assert [r.type for r in locus_queries.candidate_filter(small, "").collect()] == ["REF"]


def test_support_of_every_indel_allele(small):
    assert {r.pos: r.control_alt for r in locus_queries.control_support(small, "").collect()} == {301: 1, 311: 0, 371: 1}


def test_support_counts_by_brute_force(spark):
    """Every allele against every control read of its locus, one pair at a time."""
    from locuslens.operators import control

    r = random.Random(15)
    genome = "".join(r.choice("ACGT") for _ in range(1600))
    tiles = intervals.reference_tiles(spark.createDataFrame([("chr1", i, genome[i * 32 : i * 32 + 32]) for i in range(50)], "chrom string, chunk long, bases string"))
    events = []  # locus, 0-based first base, deleted bases, inserted bases
    for locus, lo in (("A", 400), ("B", 1000)):
        for _ in range(8):
            n = r.randint(1, 6)
            events.append((locus, r.randint(lo, lo + 60), n if r.random() < 0.6 else 0, "" if r.random() < 0.5 else "".join(r.choice("ACGT") for _ in range(n))))
    alleles, reads = [], []
    for locus, at, gone, new in events:
        alleles.append((locus, "chr1", at + 1, genome[at : at + gone + 1], genome[at] + new, "INDEL", at))
        for _ in range(r.randint(0, 3)):
            a, b = at - r.randint(30, 60), at + 1 + gone + r.randint(30, 60)
            cigar = f"{at + 1 - a}M" + (f"{len(new)}I" if new else "") + (f"{gone}D" if gone else "") + f"{b - at - 1 - gone}M"
            cigar = cigar if gone or new else f"{b - a}M"
            reads += [(f"q{len(reads)}", 3, "chr1", a, b, 60, cigar, genome[a : at + 1] + new + genome[at + 1 + gone : b], len(reads))] * r.randint(1, 2)
    for _ in range(12):  # reads of neither kind, clipped or not
        a = r.choice((370, 980)) + r.randint(0, 60)
        reads.append((f"q{len(reads)}", 3, "chr1", a, a + 70, 60, r.choice(("10S70M", "70M10S", "30M2D40M", "70M")), "".join(r.choice("ACGT") for _ in range(80)), len(reads)))
    sites = [("A", "chr1", 400, 460), ("B", "chr1", 1000, 1060)]
    columns = "locus string, chrom string, pos long, ref string, alt string, type string, tag long"
    found = control.control_support(spark.createDataFrame(alleles, columns), spark.createDataFrame(reads, "qname string, flag int, chrom string, pos long, end long, mapq int, cigar string, seq string, ordinal long"), spark.createDataFrame(sites, "locus string, locus_chrom string, locus_start long, locus_end long"), tiles, ["locus", "pos", "ref", "alt", "tag"])
    want = {}
    for locus, _, pos, ref, alt, _, tag in alleles:
        _, _, lo, hi = next(s for s in sites if s[0] == locus)
        at, grown, count = pos - 1, len(alt) - len(ref), 0
        ref_hap = genome[at - 150 : at + len(ref) + 150]
        alt_hap = ref_hap[:150] + alt + ref_hap[-150:]
        for _, _, _, a, b, _, cigar, seq, _ in reads:
            plain = "S" not in cigar
            if not (a < hi and b > lo - 100) or cigar == f"{len(seq)}M" or (plain and (grown < 0 and "D" not in cigar or grown > 0 and "I" not in cigar)):
                continue
            (score,), (deleted,), (inserted,) = control.align([seq], [ref_hap])
            to_alt = control.align([seq], [alt_hap])[0][0]
            count += bool(grown and to_alt > 0 and to_alt - 5 > score and (deleted == -grown if grown < 0 else inserted == grown))
        want[(locus, pos, ref, alt, tag)] = count
    assert {tuple(x)[:5]: x.control_alt for x in found.collect()} == want
    assert sum(want.values()) > 10


def test_the_scored_report_as_a_file(small):
    """Written sorted and read back, it is the report that the control's alleles have left."""
    from locuslens.plans import file_queries

    report, text = locus_queries.locus_report(small, "").collect(), file_queries.scored_report_tsv(small, "").collect()
    assert text == report and len(text) == 1 and text[0].indel_info.startswith("chr1:311:")


def test_support_tells_alleles_apart_by_all_columns(small):
    found = locus_queries.control_support(small, "")
    assert {"chrom", "chrom2", "pos2", "strands"} <= set(found.columns) and found.count() == 3
