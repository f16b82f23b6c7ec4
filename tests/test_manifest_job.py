"""The manifest as one job: enriched, checked and written once, with quarantine."""

import pytest

from locuslens.operators import manifest
from locuslens.session import cut
from locuslens.sources.listing import list_files

SHEET = "ordinal long, id string, uid string, sample_type string, sample_id string, assay string, i7index string, i5index string, flowcell string, lane string, dragen_path string, read1 string, read2 string, cram string, bam string, hotspot_file string, fastq_list string"


def row(ordinal, id_, **given):
    names = [c.split()[0] for c in SHEET.split(", ")]
    values = {"ordinal": ordinal, "id": id_, "uid": "u", "sample_type": "tumor", **given}
    return tuple(values.get(c) for c in names)


@pytest.fixture(scope="module")
def enriched(spark):
    rows = [
        row(1, "a", read1="/d/a_R1_.fastq.gz", read2="/d/a_R2_.fastq.gz", cram="/d/a.cram", dragen_path="/r/a"),
        row(2, "b", fastq_list="L", cram="/d/gone.cram"),
        row(3, "c", fastq_list="L"),
        row(4, "d", bam="/d/d.bam", i7index="TT"),
        row(5, "e f", read1="/d/e.txt", flowcell="own"),
        row(6, None, sample_type=None),
        row(7, "g", read1="/d/g_R1_.fq.gz", read2="/d/lost.fq.gz"),
    ]
    lists = spark.createDataFrame([("L", "b", "/d/b1_R1_.fq.gz", "/d/b1_R2_.fq.gz"), ("L", "b", "/d/b2_R1_.fq.gz", None), ("M", "c", "/d/x", "/d/y")], "list string, RGSM string, Read1File string, Read2File string")
    votes = spark.createDataFrame([("/d/a_R1_.fastq.gz", 9, "AC", "GT", "F", "1"), ("/d/e.txt", 5, "UNKNOWN", None, "F", "2"), ("/d/b2_R1_.fq.gz", 5, "CC", "AA", "G", "3")], "file string, votes long, i7index string, i5index string, flowcell string, lane string")
    return cut(manifest.enrich(spark.createDataFrame(rows, SHEET), lists, votes), "enriched")


@pytest.fixture(scope="module")
def listing(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("disk")
    for name in ("a_R1_.fastq.gz", "a_R2_.fastq.gz", "a.cram", "b1_R1_.fq.gz", "b1_R2_.fq.gz", "d.bam", "e.txt", "g_R1_.fq.gz"):
        (root / "d").mkdir(exist_ok=True)
        (root / "d" / name).write_text("" if name.startswith("a") else "x")
    (root / "top").write_text("")
    files = list_files(spark, str(root))
    assert sorted(r.length for r in files.collect()) == [0, 0, 0, 0, 1, 1, 1, 1, 1], "empty files are files"
    return files.selectExpr(f"substr(path, {len(str(root)) + 1}) as path").union(spark.createDataFrame([("/r/a",)], "path string"))


def test_enriched_rows(enriched):
    got = sorted(((r.ordinal, r.kind, r.read1, r.cram, r.bam, r.dragen_path, r.i7index, r.i5index, r.flowcell, r.lane) for r in enriched.collect()), key=str)
    none = None
    assert got == sorted([
        (1, "reads", "/d/a_R1_.fastq.gz", none, none, "/r/a", "AC", "AC", "F", "1"),
        (1, "cram", none, "/d/a.cram", none, "/r/a", "AC", "AC", "F", "1"),
        (1, "results", none, none, none, "/r/a", "AC", "AC", "F", "1"),
        (2, "reads", "/d/b1_R1_.fq.gz", none, none, none, none, none, none, none),
        (2, "reads", "/d/b2_R1_.fq.gz", none, none, none, "CC", "TT", "G", "3"),
        (3, "none", none, none, none, none, none, none, none, none),
        (4, "bam", none, none, "/d/d.bam", none, "TT", none, none, none),
        (5, "reads", "/d/e.txt", none, none, none, none, none, "own", "2"),
        (6, "none", none, none, none, none, none, none, none, none),
        (7, "reads", "/d/g_R1_.fq.gz", none, none, none, none, none, none, none),
    ], key=str)


def test_both_parts_come_from_one_write(enriched, listing):
    done = manifest.validate(enriched, listing)
    assert (done.rows, done.bad) == (10, 5)
    assert sorted((r.ordinal, r.kind) for r in done.valid.collect()) == [(1, "cram"), (1, "reads"), (1, "results"), (2, "reads"), (4, "bam")]
    assert done.valid.columns == enriched.columns
    assert {(r.ordinal, r.read1): r.errors for r in done.rejected.collect()} == {
        (2, "/d/b2_R1_.fq.gz"): "missing file", (3, None): "no input", (5, "/d/e.txt"): "id,read1 name", (6, None): "id,sample_type,no input", (7, "/d/g_R1_.fq.gz"): "missing file",
    }


def test_strict_jobs_fail_on_the_observed_count(enriched, listing):
    with pytest.raises(ValueError, match="5 of 10 manifest rows are not valid; see .*valid=false"):
        manifest.validate(enriched, listing, strict=True)
    done = manifest.validate(enriched.where("ordinal = 1"), listing, strict=True)
    assert done.bad == 0 and done.rejected.count() == 0 and done.valid.count() == 3
    empty = manifest.validate(enriched.limit(0), listing, strict=True)
    assert (empty.rows, empty.bad, empty.valid.count()) == (0, 0, 0)
