"""Intervals, the control aligner, junctions, signal modes and text formats on small inputs."""

import math
import random
import statistics

import numpy as np
import pytest

from locuslens.functions import dna
from locuslens.operators import cnv, control, hotspots, intervals, junctions
from locuslens.sources import text_formats


@pytest.fixture(scope="module")
def boxes(spark):
    r = random.Random(6)
    rows = [(i, f"c{r.randint(1, 2)}", a, a + r.randint(1, 400)) for i, a in ((i, r.randint(0, 30_000)) for i in range(150))]
    return rows, spark.createDataFrame(rows, "id long, chrom string, start long, end long")


@pytest.mark.parametrize("width", [64, 1 << 20])
def test_overlap_join_is_the_range_join(boxes, width):
    rows, df = boxes
    other = df.toDF("id2", "chrom2", "start2", "end2")
    got = intervals.overlap_join(df, other, ("chrom", "start", "end"), ("chrom2", "start2", "end2"), width)
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and a[2] < b[3] and b[2] < a[3])
    assert sorted((r.id, r.id2) for r in got.collect()) == want


@pytest.mark.parametrize("width", [500, 1 << 20])
@pytest.mark.parametrize("slack", [0, 50])
def test_cluster_and_merge(boxes, width, slack):
    rows, df = boxes
    got = {r.id: (r.chrom, r.cluster) for r in intervals.cluster(df, slack=slack, width=width).collect()}
    want = {}
    for chrom in ("c1", "c2"):
        number, reach = 0, None
        for i, _, a, b in sorted((x for x in rows if x[1] == chrom), key=lambda x: (x[2], x[3])):
            number += reach is None or a > reach + slack
            reach = b if reach is None or a > reach + slack else max(reach, b)
            want[i] = (chrom, number)
    assert got == want
    merged = sorted((r.chrom, r.start, r.end) for r in intervals.merge(df, slack=slack).collect())
    assert all(x[0] != y[0] or y[1] > x[2] + slack for x, y in zip(merged, merged[1:], strict=False))


def test_tiles(spark):
    df = spark.createDataFrame([(1,), (500_000,), (500_001,), (3_000_000,)], "e long")
    assert [r[0] for r in df.select(intervals.tile(df.e, 500_000)).collect()] == [0, 0, 500_000, 2_500_000]


def local_score(q, t):
    low = -(10**9)
    h = np.zeros((len(q) + 1, len(t) + 1))
    e, f = np.full_like(h, low), np.full_like(h, low)
    for i in range(1, len(q) + 1):
        for j in range(1, len(t) + 1):
            e[i, j] = max(h[i, j - 1] + control.OPEN, e[i, j - 1] + control.EXTEND)
            f[i, j] = max(h[i - 1, j] + control.OPEN, f[i - 1, j] + control.EXTEND)
            h[i, j] = max(0, h[i - 1, j - 1] + (control.MATCH if q[i - 1] == t[j - 1] else control.MISMATCH), e[i, j], f[i, j])
    return h.max()


def test_aligner_scores():
    r = random.Random(7)
    base = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    pairs = [(base(r.randint(1, 25)), base(r.randint(1, 30))) for _ in range(60)]
    scores, _, _ = control.align([a for a, _ in pairs], [b for _, b in pairs])
    assert scores.tolist() == [local_score(a, b) for a, b in pairs]
    assert control.best_scores([a for a, _ in pairs], [b for _, b in pairs]).tolist() == scores.tolist()
    alike = [(b[: r.randint(20, 90)] + b[r.randint(60, 100) :], b) for b in (base(200) for _ in range(40))]
    assert control.best_scores(*zip(*alike, strict=True)).tolist() == control.align(*zip(*alike, strict=True))[0].tolist()
    t = base(80)
    score, deleted, inserted = control.align([t[:40] + t[43:], t[:40] + "AC" + t[40:]], [t, t])
    assert deleted[0] == 3 and inserted[0] == 0 and deleted[1] == 0 and inserted[1] == 2 and score[0] == 5 * 77 - 12


def test_traced_alignment_equals_carried_totals():
    r = random.Random(11)
    base = lambda n, letters="ACGT": "".join(r.choice(letters) for _ in range(n))
    pairs = []
    for letters in ("ACGT", "AC", "A"):  # repeats make many equal paths
        for _ in range(120):
            t = base(r.randint(1, 90), letters)
            a, b = sorted((r.randint(0, len(t)), r.randint(0, len(t))))
            pairs.append((r.choice([t[:a] + t[b:], t[:a] + base(r.randint(1, 12), letters) + t[a:], base(r.randint(1, 60), letters)]) or "A", t))
    queries, targets = map(list, zip(*pairs, strict=True))
    for got, want in zip(control.traced(queries, targets), control.align(queries, targets), strict=True):
        assert got.tolist() == want.tolist()
    halves = control.CELLS
    try:
        control.CELLS = 40_000  # in halves, and a long pair alone by the carried totals
        for got, want in zip(control.traced([*queries, base(300)], [*targets, base(300)]), control.align([*queries, base(300)], [*targets, base(300)]), strict=True):
            assert got.tolist()[:-1] == want.tolist()[:-1]
    finally:
        control.CELLS = halves
    assert [len(c) for c in control.traced([], [])] == [0, 0, 0]


def test_control_support_needs_the_same_gap(spark):
    r = random.Random(8)
    genome = "".join(r.choice("ACGT") for _ in range(640))
    tiles = intervals.reference_tiles(spark.createDataFrame([("chr1", i, genome[i * 32 : i * 32 + 32]) for i in range(20)], "chrom string, chunk long, bases string"))
    alleles = spark.createDataFrame([("L", "chr1", 301, genome[300:304], genome[300], "INDEL"), ("L", "chr1", 301, genome[300:302], genome[300], "INDEL")], "locus string, chrom string, pos long, ref string, alt string, type string")
    site = spark.createDataFrame([("L", "chr1", 290, 320)], "locus string, locus_chrom string, locus_start long, locus_end long")
    seq = genome[250:301] + genome[304:354]
    reads = spark.createDataFrame([("q1", 3, "chr1", 250, 354, 60, "51M3D50M", seq, 1), ("q2", 3, "chr1", 250, 350, 60, "100M", genome[250:350], 2)], "qname string, flag int, chrom string, pos long, end long, mapq int, cigar string, seq string, ordinal long")
    got = control.control_support(alleles, reads, site, tiles, ["locus", "pos", "ref", "alt"]).collect()
    assert {r.ref: r.control_alt for r in got} == {genome[300:304]: 1, genome[300:302]: 0}


def test_reverse_complement(spark):
    df = spark.createDataFrame([("ACGTNRYkmbv",)], "s string")
    assert df.select(dna.reverse_complement(df.s)).first()[0] == "bvkmRYNACGT"


def test_junctions(spark):
    cols = "qname string, ordinal long, flag int, chrom string, pos long, mapq int, cigar string, mate_chrom string, mate_pos long, seq string, mate_seq string, sa string"
    rows = [
        ("d1", 1, 1, "tg", 10, 60, "100M", "chr1", 500, "AC", "GT", None), ("d2", 2, 1 + 32, "tg", 10, 60, "100M", "chr1", 500, "AC", "GT", None),
        ("s1", 3, 3, "tg", 10, 60, "30S70M", "tg", 500, "AC", "GT", "chr2,100,+,30M70S,60,0;"), ("s2", 4, 3 + 16, "tg", 10, 60, "70M30S", "tg", 500, "AC", "GT", "chr2,100,-,70S30M,60,0;"),
        ("shared", 5, 3, "tg", 10, 60, "30S70M", "tg", 500, "AC", "GT", "chr2,100,+,20S80M,60,0;"), ("excluded", 6, 1, "tg", 3130, 60, "100M", "chr1", 500, "AC", "GT", None),
    ]
    reads = junctions.usable(spark.createDataFrame(rows, cols))
    pr = {r.qname: (r.Chromosome, r.Start, r.End, r.Strand) for r in junctions.discordant(reads).collect()}
    assert pr == {"d1": ("chr1", 650, 651, "+"), "d2": ("chr1", 499, 500, "-")}
    sr = {r.qname: (r.Chromosome, r.Start, r.End, r.Strand, r.Info) for r in junctions.split(junctions.clipped(reads)).collect()}
    assert sr == {"s1": ("chr2", 129, 130, "+", "ID=s1;Type=PR;Read1Seq=AC;Read2Seq=."), "s2": ("chr2", 99, 100, "-", "ID=s2;Type=PR;Read1Seq=AC;Read2Seq=.")}


def test_modes(spark):
    r = random.Random(9)
    rows = [("few", 10, 0.1 + 0.8 * (i % 2)) for i in range(20)] + [("flat", 10, 0.5)] * 30 + [("two", 10, r.gauss(0.25, 0.02) if i % 2 else r.gauss(0.75, 0.02)) for i in range(200)]
    vaf = spark.createDataFrame([(c, e, s, i) for i, (c, e, s) in enumerate(rows)], "chrom string, end long, score double, ordinal long")
    got = {r.chrom: [float(x) for x in r.modes.split(",")] for r in cnv.modes(cnv.densities(vaf)).collect()}
    assert set(got) == {"two"} and len(got["two"]) == 2
    assert abs(got["two"][0] - 0.25) < 0.03 and abs(got["two"][1] - 0.75) < 0.03


def plain_density(scores: list[float], grid: int = 1000) -> list[float]:
    """The kernel sum of every score at every grid point, in the order given."""
    h = statistics.stdev(scores) * len(scores) ** -0.2
    return [math.fsum(math.exp(-0.5 * ((g / (grid - 1) - x) / h) ** 2) for x in scores) for g in range(grid)]


def test_density_equals_plain_kernel_sum(spark):
    r = random.Random(10)
    cases = {
        "two": [r.gauss(0.3, 0.05) if i % 2 else r.gauss(0.8, 0.03) for i in range(400)],
        "ties": [round(r.random(), 1) for _ in range(300)], "few": [r.random() for _ in range(21)],
        "outside": [r.uniform(-3, 4) for _ in range(60)], "far": [0.5] * 25 + [1e6, -1e6],
        "narrow": [500 / 999 + 1e-7 * (i % 2) for i in range(40)], "apart": [0.1 + 1e-4 * r.random() for _ in range(60)] + [0.9],
    }
    rows = [(c, 10, s, i) for c, scores in cases.items() for i, s in enumerate(scores)]
    vaf = spark.createDataFrame(rows + [("two", 10, None, 400)], "chrom string, end long, score double, ordinal long")
    density = cnv.densities(vaf.where("score is not null"))
    got = {(x.chrom, x.g): x.density for x in density.collect()}
    modes = {(x.chrom, x.g) for x in cnv.raw_modes(density).collect()}
    for c, scores in cases.items():
        plain = plain_density(scores)
        rounding = 1e-15 * len(scores) * (1 + 1 / (statistics.stdev(scores) * len(scores) ** -0.2))  # of the coordinates over h, in either sum
        assert max(abs(got.get((c, g), 0.0) - d) for g, d in enumerate(plain)) < rounding, c
        flat = [round(d, 9) for d in plain]
        assert {g for k, g in modes if k == c} == {g for g in range(1, 999) if flat[g - 1] < flat[g] > flat[g + 1]}, c
    assert ("narrow", 500) in modes and ("narrow", 499) not in got
    terms = cnv.kernel_cells(spark.range(50_000).selectExpr("'c' as chrom", "10L as end", "(id * 7919 % 50000) / 50000.0D as score", "id as ordinal"))
    assert terms.count() < 70  # cells by the bandwidth, not by the number of scores
    assert cnv.modes(cnv.densities(vaf.where("false"))).count() == 0


def test_text_formats(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("id\tuid\na\t1\n")
    assert text_formats.read_manifest(spark, str(tmp_path / "m.tsv")).first().asDict() == {"id": "a", "uid": "1"}
    (tmp_path / "s.csv").write_text("Source,DNA Sequence,PAM,Chromosome,Strand Direction,Start,Bulge Type,Mismatch,Bulge Size,On_target\nx,AC,TGG,chr1,+,7,X,2,0,1\n")
    site = text_formats.read_sites(spark, str(tmp_path / "s.csv")).first()
    assert (site.dna, site.strand, site.start, site.on_target) == ("AC", "+", 7, True)
    (tmp_path / "b.bed").write_text("chr1\t5\t9\tG\n")
    assert text_formats.read_bed(spark, str(tmp_path / "b.bed")).first() == ("chr1", 5, 9)
    (tmp_path / "v.bg").write_text("track\nchr1 5 6 0.25\nchr1 5 6\n")
    assert [tuple(r) for r in text_formats.read_bedgraph(spark, str(tmp_path / "v.bg")).collect()] == [("chr1", 5, 6, 0.25)]
    (tmp_path / "c.tsv").write_text("#x\n#y\ncontig\tstart\tstop\tname\tn\tpairs\nchr1\t0\t5\tw\t1.5\t3\n")
    assert [r.coverage for r in text_formats.read_coverage(spark, str(tmp_path / "c.tsv")).collect()] == [1.5]
    (tmp_path / "r.fa").write_text(">chr1 note\nACGT\nAC\n>chr2\nGG\n")
    assert sorted((r.chrom, r.chunk, r.bases) for r in text_formats.read_fasta(spark, str(tmp_path / "r.fa"), 4).collect()) == [("chr1", 0, "ACGT"), ("chr1", 1, "AC"), ("chr2", 0, "GG")]
    (tmp_path / "q.fq").write_text("@n1\nAC\n+\nII\n@n2\nGT\n+\nJJ\n")
    assert sorted((r.row, r.name, r.seq, r.quality) for r in text_formats.read_fastq(spark, str(tmp_path / "q.fq")).collect()) == [(0, "@n1", "AC", "II"), (1, "@n2", "GT", "JJ")]
    (tmp_path / "a.sam").write_text("@HD\nq\t3\tchr1\t11\t60\t5S10M2D3M\t=\t50\t0\tACGT\tIIII\tNM:i:2\tSA:Z:chr2,5,+,3M,60,0;\n")
    row = text_formats.read_sam(spark, str(tmp_path / "a.sam"), "edited").first()
    assert (row.pos, row.end, row.mate_chrom, row.mate_pos, row.nm, row.sa) == (10, 25, "chr1", 49, 2, "chr2,5,+,3M,60,0;")


def test_position_list_text(spark, tmp_path):
    chunks = spark.createDataFrame([("chr1", 0, "ACGT" * 8)], "chrom string, chunk long, bases string")
    found = hotspots.positions(spark.createDataFrame([("chr1", 2, 4), ("chr1", 3, 6)], "chrom string, start long, end long"), intervals.reference_tiles(chunks))
    assert sorted((r.pos, r.base) for r in found.collect()) == [(2, "C"), (3, "G"), (4, "T"), (5, "A"), (6, "C")]
    text_formats.write_lines(hotspots.vcf_lines(found), str(tmp_path / "out"), ["rank", "chrom", "pos"])
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines)[-1] == "chr1\t6\t.\tC\tN\t.\t.\t." and len(lines) == 7
