"""Publishing all or nothing, and read names from the head of files only."""

import gzip
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locuslens.operators import manifest, qc
from locuslens.sources import published
from locuslens.sources.fastq_names import read_fastq_names


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "sample string, n long")


def held(spark, path):
    return sorted(((r["sample"], r.n) for r in published.read_published(spark, path).collect()), key=str)


def test_readers_follow_the_pointer(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    published.publish(rows(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4), ("x/y", 5)]), path)
    published.publish(rows(spark, [("b", 30), ("c", 31)]), path)
    want = sorted([("a", 1), ("a", 2), ("b", 30), ("c", 31), (None, 4), ("x/y", 5)], key=str)
    assert held(spark, path) == want
    published.publish(rows(spark, [("a", 7), (None, 8), ("x/y", 9)]), path)
    assert len(published.remove_unpublished(spark, path)) == 1
    assert held(spark, path) == sorted([("a", 7), ("b", 30), ("c", 31), (None, 8), ("x/y", 9)], key=str)


def test_a_job_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/out"
    published.publish(rows(spark, [("a", 1), ("b", 2)]), path)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(published, "write_pointer", dies)
        with pytest.raises(KeyboardInterrupt):
            published.publish(rows(spark, [("a", 10), ("b", 20)]), path)
    assert held(spark, path) == [("a", 1), ("b", 2)], "the staged set is not seen"
    assert len(published.remove_unpublished(spark, path)) == 1


def test_the_audit_refuses_a_set_that_lost_rows(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/out"
    published.publish(rows(spark, [("a", 1)]), path)
    checks = published._checksum
    monkeypatch.setattr(published, "_checksum", lambda columns: [c if i else (c + F.lit(len(os.listdir(tmp_path / "out")) % 7)).alias("rows") for i, c in enumerate(checks(columns))])
    with pytest.raises(RuntimeError, match="staged set"):
        published.publish(rows(spark, [("a", 2), ("a", 3)]), path)
    monkeypatch.undo()
    assert held(spark, path) == [("a", 1)]
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, f"file://{tmp_path}/none")


def test_names_of_a_large_file_cost_its_head(spark, tmp_path):
    r = random.Random(9)
    big = "".join(f"@m:1:F{i % 2}:3 1:N:0:{'AC+GT' if i % 3 else 'AA+GG'}\n{''.join(r.choices('ACGT', k=100))}\n+\n{'I' * 100}\n" for i in range(30_000))
    (tmp_path / "big.fastq.gz").write_bytes(gzip.compress(big.encode()))
    (tmp_path / "small.fq").write_text("@m:1:F:4 1:N:0:A+C\nAC\n+\nII\n@last:1:G:5")
    (tmp_path / "empty.fastq").write_text("")
    (tmp_path / "note.md").write_text("@no\n")
    got = {}
    for x in read_fastq_names(spark, str(tmp_path), 1000).collect():
        got.setdefault(x.file.rsplit("/", 1)[1], []).append(x)
    assert {k: len(v) for k, v in got.items()} == {"big.fastq.gz": 1000, "small.fq": 2}
    assert [x.name for x in sorted(got["big.fastq.gz"], key=lambda x: x.row)] == big.split("\n")[::4][:1000]
    size = (tmp_path / "big.fastq.gz").stat().st_size
    assert max(x.consumed for x in got["big.fastq.gz"]) < size / 8, "the rest of the file is not read"
    votes = {x.file.rsplit("/", 1)[1]: (x.i7index, x.i5index, x.flowcell, x.lane, x.votes) for x in manifest.index_vote(read_fastq_names(spark, str(tmp_path))).collect()}
    assert votes["big.fastq.gz"] == ("AC", "GT", "F1", "3", 666)
    (tmp_path / "none").mkdir()
    assert read_fastq_names(spark, str(tmp_path / "none")).collect() == []


def test_counters_of_long_null_and_empty_reads(spark, monkeypatch):
    r = random.Random(10)
    seqs = ["".join(r.choices("ACGTN", k=n)) for n in (0, 1, 5, 1024, 1025, 9000)] + [None, "ACGT", None]
    df = spark.createDataFrame([(s,) for s in seqs], "seq string").repartition(2)
    want = Counter((i, b) for s in seqs if s for i, b in enumerate(s))
    assert {(x.pos, x.base): x.n for x in qc.base_content(df).collect()} == want
    monkeypatch.setattr(qc, "HELD", 1)
    assert {(x.pos, x.base): x.n for x in qc.base_content(df).collect()} == want
    assert qc.base_content(df.limit(0)).collect() == [] and qc.base_content(df.where("seq is null")).collect() == []
    assert "Generate" not in qc.base_content(df)._jdf.queryExecution().executedPlan().toString()
