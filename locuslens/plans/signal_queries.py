"""Queries over allele-fraction, coverage and read-quality data, and over derived text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslens.adapters import duck, view
from locuslens.operators import cnv, qc
from locuslens.registry import query
from locuslens.session import scratch_dir
from locuslens.sources import text_formats

TILE = "(floor((\"end\" - 1) / 500000) * 500000)::BIGINT"


@query(f"with {duck('vaf')} select chrom, {TILE} as tile, count(*) as n, round(avg(score), 6) as mean from vaf_v group by 1, 2")
def vaf_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnv.tile_stats(view(spark, sf_dir, "vaf")).select("chrom", "tile", "n", F.round("mean", 6).alias("mean"))


RAW = f"""{duck("vaf")}, t as (select chrom, {TILE} as tile, score from vaf_v), st as (select chrom, tile, count(*) as n, stddev_samp(score) as sd from t group by 1, 2 having count(*) >= 21 and stddev_samp(score) > 0),
  v as (select chrom, tile, score, count(*) as times from t group by 1, 2, 3), m as (select v.*, sd * pow(n, -0.2) as h from v join st using (chrom, tile)),
  d as (select chrom, tile, g, round(sum(times * exp(-0.5 * pow((g / 999.0::DOUBLE - score) / h, 2))), 9) as d from m, range(0, 1000) r(g) group by 1, 2, 3),
  w as (select *, lag(d) over (partition by chrom, tile order by g) as a, lead(d) over (partition by chrom, tile order by g) as b from d), raw as (select chrom, tile, g, d from w where d > a and d > b)"""
MODES = f"""{RAW}, ranked as (select chrom, tile, list([g] order by d desc, g) as l from raw group by 1, 2),
  kept as (select chrom, tile, list_sort(list_reduce(l, lambda acc, x: case when len(list_filter(acc, lambda k: abs(k - x[1]) < 10)) = 0 then list_concat(acc, x) else acc end)) as k from ranked),
  modes as (select chrom, tile, array_to_string(list_transform(k, lambda g: round(g / 999.0::DOUBLE, 4)::VARCHAR), ',') as modes from kept)"""


@query(f"with {RAW} select chrom, tile, g from raw")
def vaf_modes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnv.raw_modes(cnv.densities(view(spark, sf_dir, "vaf"))).select("chrom", "tile", "g")


@query(f"with {MODES} select chrom, tile, modes from modes")
def vaf_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnv.modes(cnv.densities(view(spark, sf_dir, "vaf")))


@query(f"""with {duck("vaf")}, {duck("coverage")}, t as (select distinct chrom, {TILE} as tile from vaf_v)
  select t.chrom, tile, round(avg(coverage), 6) as coverage, count(*) as n_intervals from t join coverage_v c on c.chrom = t.chrom and c.start < tile + 500000 and c."end" > tile group by 1, 2""")  # fmt: skip
def window_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = cnv.tiles(view(spark, sf_dir, "vaf")).select("chrom", "tile").distinct().withColumn("modes", F.lit(None).cast("string"))
    return cnv.window_coverage(windows, view(spark, sf_dir, "coverage")).select("chrom", "tile", F.round("coverage", 6).alias("coverage"), "n_intervals")


@query(f"""with {MODES}, {duck("coverage")}, tl as (select distinct chrom, tile from t), tr as (select tl.chrom, tl.tile, max(modes) as modes, avg(coverage) as coverage from tl join coverage_v c on c.chrom = tl.chrom and c.start < tl.tile + 500000 and c."end" > tl.tile
  left join modes on modes.chrom = tl.chrom and modes.tile = tl.tile group by 1, 2) select row_number() over (order by chrom, tile) - 1 as "index", chrom as "Chromosome", tile as "Start", tile + 500000 as "End", modes as "VAF", coverage as "NormalizedCoverage" from tr""")  # fmt: skip
def cnv_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cnv.cnv_track(view(spark, sf_dir, "vaf"), view(spark, sf_dir, "coverage"))


@query(f"with {duck('fastq')}, c as (select seq as start, count(*) as n from fastq_v group by 1) select start, n from c where n >= 0.001::DOUBLE * (select count(*) from fastq_v)")
def qc_overrepresented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.overrepresented(view(spark, sf_dir, "fastq"))


@query(f"with {duck('fastq')}, e as (select unnest(range(0, length(seq))) as pos, seq from fastq_v) select pos, substr(seq, pos + 1, 1) as base, count(*) as n from e group by 1, 2")
def qc_base_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.base_content(view(spark, sf_dir, "fastq"))


@query(f"with {duck('fastq')}, e as (select unnest(range(0, length(quality))) as pos, quality from fastq_v), s as (select pos, ascii(substr(quality, pos + 1, 1)) - 33 as q from e) select pos, count(*) as n, sum(q)::BIGINT as total, min(q)::BIGINT as low, max(q)::BIGINT as high from s group by 1")
def qc_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.quality(view(spark, sf_dir, "fastq"))


@query(f"with {duck('fastq')} select file, instr(seq, 'AGATCGGAAGAGC') as at, count(*) as n from fastq_v where contains(seq, 'AGATCGGAAGAGC') group by 1, 2")
def qc_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc.adapter_hits(view(spark, sf_dir, "fastq"))


@query(f"with {duck('manifest')} select id, uid, nullif(read1, '') as read1 from manifest_v")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark) + "/manifest"
    text_formats.write_tsv(view(spark, sf_dir, "manifest").select("id", "uid", F.nullif("read1", F.lit("")).alias("read1")), path)
    return text_formats.read_manifest(spark, path)


@query(f"with {duck('genes')} select gene_chrom as chrom, gene_start as start, gene_end as \"end\" from genes_v")
def bed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark) + "/genes"
    lines = view(spark, sf_dir, "genes").select(F.concat_ws("\t", "gene_chrom", "gene_start", "gene_end", "symbol").alias("value"))
    lines.write.text(path)
    return text_formats.read_bed(spark, path)


@query(f"with {duck('vaf')} select chrom, start, \"end\", score from vaf_v")
def bedgraph_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark) + "/vaf"
    rows = view(spark, sf_dir, "vaf").select(F.concat_ws(" ", "chrom", "start", "end", "score").alias("value"))
    rows.union(spark.createDataFrame([("track type=bedGraph",)], "value string")).write.option("compression", "gzip").text(path)
    return text_formats.read_bedgraph(spark, path)


@query(f"with {duck('coverage')} select chrom, start, \"end\", coverage from coverage_v")
def coverage_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark) + "/coverage"
    rows = view(spark, sf_dir, "coverage").select(F.concat_ws("\t", "chrom", "start", "end", F.lit("bin"), "coverage", F.lit("1")).alias("value"))
    spark.createDataFrame([("#a",), ("#b",), ("contig\tstart\tstop\tname\tnormalized\tpairs",)], "value string").union(rows).write.text(path)
    return text_formats.read_coverage(spark, path).select("chrom", "start", "end", "coverage")
