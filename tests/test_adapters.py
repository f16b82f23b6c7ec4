"""Views as Spark computes them against the SQL text that both engines share."""

import hashlib

from pyspark.sql import functions as F

from locuslens import adapters
from locuslens.session import table

SMALL = "/root/testdata/sf0.001"


def test_reads_equal_the_shared_text(spark):
    given = table(spark, SMALL, "lineitem", False)
    odd = given.limit(40).withColumn("l_orderkey", -F.col("l_orderkey") - 3).unionByName(given.limit(5).withColumn("l_orderkey", F.lit(None).cast("bigint")))
    lines = given.unionByName(odd)
    texts = [x.replace('"end"', "`end`") for x in (adapters.READS, adapters.SPARK_READS)]
    want, got = (spark.sql(x, lineitem=lines) for x in texts)
    assert want.schema == got.schema
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
    assert adapters.SPARK_READS.count("md5(") == 2 < adapters.READS.count("md5("), "no read digests its body"
    assert "before" not in adapters.SPARK_READS and " after" not in adapters.SPARK_READS


def test_bases_of_a_chunk_are_computed_after_chunks_are_distinct(spark):
    tiles = adapters.reference(spark, SMALL)
    chunk = lambda c, k: hashlib.md5(f"{c}:{k}".encode()).hexdigest().translate(adapters._BASES)
    site = adapters.view(spark, SMALL, "sites").orderBy("site_id").first()
    asked = spark.createDataFrame([(site.chrom, site.start - 40, site.start + 40)], "chrom string, a long, b long")
    from locuslens.operators import intervals

    text = "".join(chunk(site.chrom, k) for k in range((site.start - 40) // 32, (site.start + 40) // 32 + 1))
    at = (site.start - 40) % 32
    assert intervals.fetch_sequence(asked, tiles, "chrom", "a", "b", "bases").first().bases == text[at : at + 80]


def test_generated_methods_stay_below_what_the_jvm_compiles(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    adapters.view(spark, SMALL, "reads")
    assert int(spark.conf.get(name)) == 8000
    spark.conf.set(name, 4000)
    adapters.view(spark, SMALL, "reads")
    assert int(spark.conf.get(name)) == 4000, "a lower limit stays"
    spark.conf.unset(name)


def test_rounding_without_decimal_texts(spark):
    from decimal import ROUND_HALF_UP, Decimal

    odd = [0.0, -0.0, 0.004999999999999999, 0.005, -0.005, 0.015, 0.025, -0.025, 0.045, 0.5, 1.005, -1.015, 0.07, 0.08, 123456789.015, None]
    assert "round(" not in adapters.SPARK_READS
    text = f"case when t is not null then cast({adapters.CENTS} as bigint) end".replace("l_tax", "t")
    rows = spark.createDataFrame([(x,) for x in odd], "t double").selectExpr("t", f"{text} as got", "cast(round(t * 100) as bigint) as want").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert [r.got for r in rows if r.t is not None] == [int(Decimal(repr(r.t * 100)).quantize(Decimal(1), ROUND_HALF_UP)) for r in rows if r.t is not None]


def test_views_in_few_more_splits_than_cores_are_dealt(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    given = table(spark, SMALL, "lineitem", False)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 40)  # a file a split
    try:
        given.repartition(cores + 1).write.parquet(str(tmp_path / "lineitem.parquet"))
        assert table(spark, str(tmp_path), "lineitem", True).rdd.getNumPartitions() == cores + 1
        assert adapters.view(spark, str(tmp_path), "reads", True).rdd.getNumPartitions() == cores * adapters.WAVES
        assert adapters.view(spark, str(tmp_path), "reads").rdd.getNumPartitions() == cores + 1
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
