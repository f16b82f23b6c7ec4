"""Listings and fastq lists whose tasks, folders and files do not follow the number of names."""

from urllib.parse import quote_plus

from pyspark.sql import functions as F

from locuslens.plans import manifest_queries
from locuslens.sources import listing, text_formats


def test_many_folders_are_listed_by_few_partitions(spark, tmp_path):
    for i in range(700):
        (tmp_path / f"f{i}" / "deep").mkdir(parents=True)
        (tmp_path / f"f{i}" / "deep" / "a.bam").touch()
    (tmp_path / "own").write_text("xy")
    assert len(listing.ListingReader(str(tmp_path)).partitions()) == listing.PARTITIONS + 1
    files = listing.list_files(spark, str(tmp_path))
    assert {(r.path.removeprefix(f"{tmp_path}/"), r.length) for r in files.collect()} == {("own", 2), *((f"f{i}/deep/a.bam", 0) for i in range(700))}


def test_files_are_made_by_many_tasks_in_many_folders(spark, tmp_path):
    names = ["a b/c", "é/ü%", "x+y&z", *(f"/data/n{i}.fq" for i in range(900))]
    paths = spark.createDataFrame([(n,) for n in names + names[:5]], "path string")
    root = f"file://{tmp_path}/made"
    assert listing.make_files(paths.select(F.url_encode("path").alias("name")), root) == len(names)
    held = [len(list(d.iterdir())) for d in (tmp_path / "made").iterdir()]
    assert sum(held) == len(names) and max(held) < 30
    assert sorted(r.path for r in manifest_queries.listing(spark, paths).collect()) == sorted(names)
    assert manifest_queries.listing(spark, paths.limit(0)).collect() == []
    assert quote_plus("a b/c") in {f.name for f in (tmp_path / "made").glob("*/*")}


def test_lists_lie_together_each_in_one_file(spark, tmp_path):
    rows = [(f"u{i % 400}", f"g{i}", f"s,{i}", None, "1", f"/d/{i} R1", None if i % 3 else f'/d/{i}"R2') for i in range(1000)]
    lists = spark.createDataFrame(rows, "list string, RGID string, RGSM string, RGLB string, Lane string, Read1File string, Read2File string").repartition(7)
    path = str(tmp_path / "lists")
    text_formats.write_lists_together(lists, path)
    back = text_formats.read_lists_together(spark, path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert len(list((tmp_path / "lists").glob("*.csv"))) <= 4
    assert back.groupBy("list").agg(F.countDistinct("_metadata.file_path").alias("n")).where("n > 1").count() == 0
