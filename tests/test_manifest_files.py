"""Manifests, annotation, read quality, and files that span several splits."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locuslens.operators import annotate, intervals, manifest, qc
from locuslens.session import cut, remove_written
from locuslens.sources import text_formats

SHEET = "ordinal long, id string, uid string, sample_type string, lane string, flowcell string, sample_id string, i7index string, i5index string, dragen_path string, read1 string, read2 string, cram string, bam string"


@pytest.fixture(scope="module")
def sheet(spark):
    rows = [
        (1, "a", "u1", "tumor", "1", "F", None, "AC", "GT", None, "/d/a_R1_.fastq.gz", "/d/a_R2_.fastq.gz", None, None),
        (2, "b", "u1", "normal", "2", "F", None, "AC", None, None, "/d/b_R1_.fq.gz", "/d/b_R2_.fastq.gz", None, None),
        (3, "c d", "u2", None, "1", "F", None, "AC", "GT", "/r/c", None, "/d/c.txt", None, None),
        (4, "e", "u2", "tumor", "1", "F", None, None, None, None, None, None, "/d/e.cram", None),
    ]
    return spark.createDataFrame(rows, SHEET)


def test_findings_fail_the_job(spark, sheet):
    listing = spark.createDataFrame([("/d/a_R1_.fastq.gz",), ("/d/b_R1_.fq.gz",), ("/r/c",)], "path string")
    found = {r.ordinal: r.errors for r in manifest.findings(sheet, listing).collect()}
    assert found == {2: "pair suffix", 3: "id,read1 missing,read2 name,sample_type", 4: "missing file"}
    with pytest.raises(ValueError, match="3 manifest rows are not valid: row 2"):
        manifest.require_valid(sheet, listing)
    good = sheet.where("ordinal = 1")
    assert manifest.require_valid(good, listing).count() == 1
    assert manifest.findings(sheet.limit(0), listing).count() == 0


def test_case_lists_and_pairs(sheet):
    lists = {r.uid: r.fastq_list for r in manifest.case_lists(sheet).collect()}
    assert lists == {"u1": "a,1,a_R1_.fastq.gz,a_R2_.fastq.gz;b,2,b_R1_.fq.gz,b_R2_.fastq.gz"}
    assert [(r.uid, r.tumor, r.normal, r.kind) for r in manifest.case_pairs(sheet).collect()] == [("u1", "a", "b", "reads")]
    groups = {r.RGSM: (r.RGID, r.RGLB) for r in manifest.fastq_lists(sheet).collect()}
    assert groups == {"a": ("F.AC.GT.1", "a.AC.GT"), "b": ("F.AC.2", "b.AC")}


def test_facility_sheets_agree(spark):
    both = spark.createDataFrame([(1, "u-s-x", "AC-GT", "F", "1", "/d/s_R1_1.fastq.gz", "/d/s_R2_1.fastq.gz")], "ordinal long, library string, index string, flowcell string, lane string, read1 string, read2 string")
    whole = manifest.facility_pairs(both).first()
    rows = both.select("ordinal", "library", "index", "flowcell", "lane", F.explode(F.array("read1", "read2")).alias("fastq"))
    halves = manifest.facility_reshape(rows).collect()
    assert (whole.uid, whole.id, whole.assay, whole.i7index, whole.i5index) == ("u", "s", "x", "AC", "GT")
    assert {r.read1 or r.read2 for r in halves} == {whole.read1, whole.read2}


def test_provenance_text(spark):
    rows = spark.createDataFrame([("A:B:M", "t", "2"), ("A:M", "t", "1"), ("A:L", "s", "1")], "process string, tool string, version string")
    lines = [r.value for r in manifest.provenance_lines(rows).orderBy("module", "rank", "tool").collect()]
    assert lines == ["L:", "    s: 1", "M:", "    t: 1,2"]


def test_annotation_picks_the_narrowest(spark):
    rows = spark.createDataFrame([(1, "chr1", 10, 12), (2, "chr1", 90, 95)], "id long, chrom string, start long, end long")
    genes = spark.createDataFrame([("chr1", 0, 100, "wide"), ("chr1", 5, 20, "narrow"), ("chr1", 6, 21, "also")], "gene_chrom string, gene_start long, gene_end long, symbol string")
    got = {(r.id, r.symbol): r.picked for r in annotate.annotate(rows, genes, "id").collect()}
    assert got == {(1, "wide"): False, (1, "narrow"): False, (1, "also"): True, (2, "wide"): True}


def test_read_quality_counts(spark):
    r = random.Random(3)
    reads = [("f", "".join(r.choice("ACGT") for _ in range(r.randint(0, 9))), "".join(r.choice("#5I") for _ in range(5))) for _ in range(60)]
    df = spark.createDataFrame(reads, "file string, seq string, quality string")
    bases = Counter((i, b) for _, s, _ in reads for i, b in enumerate(s))
    assert {(x.pos, x.base): x.n for x in qc.base_content(df).collect()} == bases
    for row in qc.quality(df).collect():
        own = [ord(q[row.pos]) - 33 for _, _, q in reads]
        assert (row.n, row.total, row.low, row.high) == (len(own), sum(own), min(own), max(own))
    assert {(x.at): x.n for x in qc.adapter_hits(df, "AC").collect()} == Counter(s.index("AC") + 1 for _, s, _ in reads if "AC" in s)
    starts = Counter(s[:2] for _, s, _ in reads)
    assert {x.start: x.n for x in qc.overrepresented(df, 0.1, 2).collect()} == {k: v for k, v in starts.items() if v >= 6}


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_contigs_span_splits(small_splits, tmp_path):
    r = random.Random(5)
    contigs = {f"c{i}": "".join(r.choice("ACGTN") for _ in range(n)) for i, n in enumerate((1, 700, 16, 0, 333))}
    text = "".join(f">{name} note\n" + "".join(bases[at : at + 17] + "\n" for at in range(0, len(bases), 17)) for name, bases in contigs.items())
    (tmp_path / "g.fa").write_text(text)
    found = text_formats.read_fasta(small_splits, str(tmp_path / "g.fa"), 32)
    assert text_formats.lines_of(small_splits, str(tmp_path / "g.fa")).select("split").distinct().count() > 5
    got: dict[str, dict[int, str]] = {}
    for row in found.collect():
        got.setdefault(row.chrom, {})[row.chunk] = row.bases
    assert {c: "".join(p[i] for i in sorted(p)) for c, p in got.items()} == {c: b for c, b in contigs.items() if b}
    tiles = intervals.reference_tiles(found)
    asked = small_splits.createDataFrame([("c1", 5, 690), ("c1", 0, 701), ("c4", 32, 64), ("c9", 0, 1), (None, 0, 1), ("c1", None, 4)], "chrom string, a long, b long")
    assert {(x.chrom, x.a, x.b): x.s for x in intervals.fetch_sequence(asked, tiles, "chrom", "a", "b", "s").collect()} == {("c1", 5, 690): contigs["c1"][5:690], ("c1", 0, 701): None, ("c4", 32, 64): contigs["c4"][32:64], ("c9", 0, 1): None, (None, 0, 1): None, ("c1", None, 4): None}


def test_slices_longer_than_a_tile(spark):
    r = random.Random(7)
    bases = "".join(r.choice("ACGT") for _ in range(3 * intervals.TILE))
    chunks = [("c", i, bases[i * 32 : i * 32 + 32]) for i in range(len(bases) // 32) if i != 200]
    tiles = intervals.reference_tiles(spark.createDataFrame(chunks, "chrom string, chunk long, bases string"))
    holed = bases[: 200 * 32] + "N" * 32 + bases[201 * 32 :]
    asked = spark.createDataFrame([(100, 12_000), (4095, 4097), (6380, 6450)], "a long, b long").withColumn("chrom", F.lit("c"))
    assert {x.a: x.s for x in intervals.fetch_sequence(asked, tiles, "chrom", "a", "b", "s").collect()} == {a: holed[a:b] for a, b in ((100, 12_000), (4095, 4097), (6380, 6450))}


def test_records_span_splits(small_splits, tmp_path):
    records = [(f"@r{i} x", "ACGT" * (i % 5 + 1), "I" * 4 * (i % 5 + 1)) for i in range(40)]
    for n in range(2):
        (tmp_path / f"{n}.fq").write_text("".join(f"{a}\n{b}\n+\n{c}\n" for a, b, c in records[n * 20 : n * 20 + 20]))
    got = sorted((r.file[-4:], r.row, r.name, r.seq, r.quality) for r in text_formats.read_fastq(small_splits, str(tmp_path)).collect())
    assert got == sorted((f"{i // 20}.fq", i % 20, *records[i]) for i in range(40))


def test_sorted_text_and_regions(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") * 37 % 200).alias("pos"), F.lit("").alias("empty"))
    text_formats.write_tsv(rows, str(tmp_path / "t"), ["pos"])
    lines = [line for f in sorted((tmp_path / "t").glob("part-*")) for line in f.read_text().splitlines() if not line.startswith("pos")]
    assert [int(x.split("\t")[0]) for x in lines] == list(range(200))
    reads = spark.range(100).select(F.concat(F.lit("chr"), F.col("id") % 3).alias("chrom"), F.col("id").alias("pos"), (F.col("id") + 5).alias("end"))
    text_formats.write_alignments(reads, str(tmp_path / "a"))
    own = text_formats.read_region(spark, str(tmp_path / "a"), "chr1", 20, 40)
    assert sorted(r.pos for r in own.collect()) == [x for x in range(1, 100, 3) if x < 40 and x + 5 > 20]
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chrom" in plan and "PushedFilters" in plan


def test_written_tables_can_be_removed(spark):
    kept = cut(spark.range(3), "kept")
    assert kept.count() == 3
    where = kept.inputFiles()[0].removeprefix("file://")
    remove_written(spark)
    import os

    assert not os.path.exists(where)
