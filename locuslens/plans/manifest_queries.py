"""Queries over sample manifests, fastq lists and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.adapters import duck, view
from locuslens.operators import manifest
from locuslens.registry import query
from locuslens.session import scratch_dir
from locuslens.sources.fastq_names import read_fastq_names
from locuslens.sources.listing import list_files, make_files

PATHS = ("dragen_path", "read1", "read2", "cram", "bam", "sample_type")
CLEAN = f"{duck('manifest')}, m as (select * replace ({', '.join(f'''nullif(trim({c}), '') as {c}''' for c in PATHS)}, lane::VARCHAR as lane), null::VARCHAR as sample_id from manifest_v)"
ROUTES = f"{CLEAN}, routes as (" + " union all ".join(f"select ordinal, id, '{k}' as kind, {c} as path from m where {c} is not null" for k, c in (("results", "dragen_path"), ("reads", "read1"), ("cram", "cram"), ("bam", "bam"))) + ")"


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.blank_to_null(view(spark, sf_dir, "manifest"))


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The manifest as a reads sheet and an alignments sheet with different columns."""
    own = rows(spark, sf_dir)
    return own.where("read1 is not null").select("ordinal", "id", "read1"), own.where("cram is not null or bam is not null").select("ordinal", "id", "cram", "bam")


@query(f"with {CLEAN} select ordinal, id, uid, sample_type, sample_id, assay, i7index, i5index, flowcell, lane, dragen_path, read1, read2, cram, bam, hotspot_file from m")
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir)


@query(f"with {CLEAN} select ordinal, id from m where sample_type is not null or dragen_path is not null")
def manifest_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.keep_rows(rows(spark, sf_dir)).select("ordinal", "id")


@query(f"with {ROUTES} select * from routes")
def manifest_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.routes(rows(spark, sf_dir))


@query(f"with {CLEAN} select ordinal, case when id = 'Customer#000000007' then 'tumor' when id = 'Customer#000000014' then 'normal' else sample_type end as sample_type from m")
def role_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.override_roles(rows(spark, sf_dir), "Customer#000000007", "Customer#000000014").select("ordinal", "sample_type")


@query(f"""with {CLEAN}, e as (select ordinal, id, read1 is not null and read2 is null as single_end, list_sort(list_filter([
  case when id is null or regexp_matches(id, '\\s') then 'id' end, case when sample_type is null then 'sample_type' end,
  case when read1 is not null and not regexp_matches(read1, '^\\S+\\.f(ast)?q\\.gz$') then 'read1 name' end, case when read2 is not null and not regexp_matches(read2, '^\\S+\\.f(ast)?q\\.gz$') then 'read2 name' end,
  case when regexp_extract(read1, '\\.(f(?:ast)?q\\.gz)$', 1) <> regexp_extract(read2, '\\.(f(?:ast)?q\\.gz)$', 1) then 'pair suffix' end, case when read1 is null and read2 is not null then 'read1 missing' end], lambda x: x is not null)) as l from m)
  select ordinal, id, array_to_string(l, ',') as errors, single_end from e where len(l) > 0""")  # fmt: skip
def manifest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.row_errors(rows(spark, sf_dir))


def listing(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """A folder in which every path of ``paths (path)`` is an empty file, made by tasks and listed: ``path``."""
    root = scratch_dir(spark, "files")
    if not make_files(paths.select(F.url_encode("path").alias("name")), root):
        return paths.distinct()
    return list_files(spark, root).select(F.url_decode(F.element_at(F.split("path", "/"), -1)).alias("path"))


@query(f"with {ROUTES} select * from routes where path not in (select path from routes where ordinal % 4 <> 1)")
def missing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir)
    return manifest.missing_paths(own, listing(spark, manifest.routes(own).where("ordinal % 4 != 1").select("path")))


@query(f"with {CLEAN} select ordinal, id, concat_ws('.', flowcell, sample_id, i7index, i5index, lane) as rgid, concat_ws('.', id, i7index, i5index) as rglb from m where read1 is not null")
def read_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.read_groups(rows(spark, sf_dir))


SHEET = f"""{CLEAN}, sheet as (select ordinal, uid || '-' || id || '-' || assay as library, i7index || '-' || i5index as "index", flowcell, lane, unnest([read1, read2]) as fastq from m where read1 is not null and read2 is not null)"""


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir).where("read1 is not null and read2 is not null")
    return own.select("ordinal", F.concat_ws("-", "uid", "id", "assay").alias("library"), F.concat_ws("-", "i7index", "i5index").alias("index"), "flowcell", "lane", F.explode(F.array("read1", "read2")).alias("fastq"))


@query(f"""with {SHEET} select ordinal, split_part(library, '-', 1) as uid, split_part(library, '-', 2) as id, split_part(library, '-', 3) as assay, split_part("index", '-', 1) as i7index, split_part("index", '-', 2) as i5index, flowcell, lane,
  case when contains(fastq, '_R1_') then fastq end as read1, case when not contains(fastq, '_R1_') then fastq end as read2, null::VARCHAR as sample_type, null::VARCHAR as sample_id from sheet""")  # fmt: skip
def facility_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.facility_reshape(sheet(spark, sf_dir))


@query(f"""with {SHEET} select a.library, a.flowcell, a."index", a.lane, a.fastq as read1, b.fastq as read2 from sheet a join sheet b on a.library = b.library and a.flowcell = b.flowcell and a."index" = b."index" and a.lane = b.lane and contains(a.fastq, '_R1_') and contains(b.fastq, '_R2_')""")
def pair_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = sheet(spark, sf_dir)
    return manifest.pair_reads(own.where(F.col("fastq").contains("_R1_")), own.where(F.col("fastq").contains("_R2_")))


@query(f"with {SHEET}, f as (select ordinal, [read1, read2] as reads from m where read1 is not null and read2 is not null) select ordinal, 1 as pair, reads[1] as read1, reads[2] as read2 from f")
def read_pairs_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = sheet(spark, sf_dir).groupBy("ordinal").agg(F.array_sort(F.collect_list("fastq")).alias("fastq"))
    first, second = F.filter("fastq", lambda x: x.contains("_R1_")), F.filter("fastq", lambda x: x.contains("_R2_"))
    pairs = lists.select("ordinal", F.posexplode(F.arrays_zip(first.alias("a"), second.alias("b"))).alias("pair", "p"))
    return pairs.select("ordinal", (F.col("pair") + 1).alias("pair"), F.col("p")["a"].alias("read1"), F.col("p")["b"].alias("read2"))


@query(f"with {CLEAN} select a.uid, a.id as tumor, b.id as normal from m a join m b on a.uid = b.uid and a.sample_type = 'tumor' and b.sample_type = 'normal'")
def tumor_normal_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir)
    tumor = own.where("sample_type = 'tumor'").select("uid", F.col("id").alias("tumor"))
    return tumor.join(own.where("sample_type = 'normal'").select("uid", F.col("id").alias("normal")), "uid")


@query(f"with {CLEAN} select a.id, a.dragen_path, b.cram from m a join m b on a.id = b.id where a.dragen_path is not null and b.cram is not null")
def sample_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir)
    return own.where("dragen_path is not null").select("id", "dragen_path").join(own.where("cram is not null").select("id", "cram"), "id")


@query(f"with {CLEAN}, bed as (select '/hot/' || n_name || '.bed' as bed from nation) select uid, bed from (select distinct uid from m) u, bed")
def case_cross_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locuslens.session import table

    beds = table(spark, sf_dir, "nation").select(F.concat(F.lit("/hot/"), "n_name", F.lit(".bed")).alias("bed"))
    # every case meets every file of the bed list, here one per nation; Spark broadcasts the list only if its size allows
    return rows(spark, sf_dir).select("uid").distinct().crossJoin(beds)


@query(f"""with {CLEAN} select uid, string_agg(id || ',' || lane || ',' || split_part(read1, '/', 3) || ',' || coalesce(split_part(read2, '/', 3), ''), ';' order by ordinal) as fastq_list, count(*) as n_files from m where read1 is not null group by uid""")
def case_fastq_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.case_lists(rows(spark, sf_dir))


@query(f"with {CLEAN} select uid, arg_min(id, ordinal) filter (where sample_type = 'tumor') as tumor, arg_min(id, ordinal) filter (where sample_type = 'normal') as normal from m group by uid")
def case_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.case_roles(rows(spark, sf_dir))


@query(f"""with {ROUTES}, g as (select uid, kind, arg_min(m.id, m.ordinal) filter (where sample_type = 'tumor') as tumor, arg_min(m.id, m.ordinal) filter (where sample_type = 'normal') as normal, string_agg(path, ';' order by m.ordinal, path) as files
  from m join routes using (ordinal) where kind <> 'results' group by uid, kind) select * from g where tumor is not null and normal is not null""")  # fmt: skip
def case_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.case_pairs(rows(spark, sf_dir))


@query(f"with {CLEAN} select 'u' || (ordinal % 50)::VARCHAR as uid, hotspot_file, count(*) as n from m group by 1, 2 having count(*) > 1")
def duplicate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir).withColumn("uid", F.concat(F.lit("u"), (F.col("ordinal") % 50).cast("string")))
    return manifest.duplicates(own)


@query(f"with {CLEAN} select ordinal, uid || '_T' || row_number() over (partition by uid order by ordinal)::VARCHAR as sample from m")
def sample_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.row_number().over(W.partitionBy("uid").orderBy("ordinal"))
    return rows(spark, sf_dir).select("ordinal", F.concat("uid", F.lit("_T"), number.cast("string")).alias("sample"))


@query(f"with {CLEAN} select 1 as source, ordinal, id from m where read1 is not null union all select 2 as source, ordinal, id from m where cram is not null or bam is not null")
def input_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, aligned = halves(spark, sf_dir)
    tag = lambda df, n: df.select(F.lit(n).alias("source"), "ordinal", "id")
    return tag(reads, 1).union(tag(aligned, 2))


@query(f"with {CLEAN} select ordinal, id, read1, null as cram, null as bam from m where read1 is not null union all select ordinal, id, null, cram, bam from m where cram is not null or bam is not null")
def manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads, aligned = halves(spark, sf_dir)
    return reads.unionByName(aligned, allowMissingColumns=True)


@query(f"with {duck('versions')} select split_part(process, ':', 3) as module, tool, string_agg(distinct version, ',' order by version) as versions, count(distinct version) > 1 as conflict from versions_v group by 1, 2")
def version_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.version_conflicts(view(spark, sf_dir, "versions"))


@query(f"""with {duck("fastq")}, h as (select file, row_number() over (partition by file order by row) as n, split_part(split_part(name, ' ', 1), ':', 3) as flowcell, split_part(split_part(name, ' ', 1), ':', 4) as lane,
  coalesce(nullif(split_part(split_part(name, ' ', 2), ':', 4), ''), 'UNKNOWN') as idx from fastq_v), v as (select file, idx, count(*) as votes, min(n) as seen, arg_min(flowcell, n) as flowcell, arg_min(lane, n) as lane from h where n <= 1000 group by 1, 2),
  r as (select *, row_number() over (partition by file order by votes desc, seen) as k from v)
  select file, votes, split_part(idx, '+', 1) as i7index, nullif(split_part(idx, '+', 2), '') as i5index, flowcell, lane from r where k = 1""")  # fmt: skip
def fastq_index_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vote over FASTQ files, of which only the first names are read."""
    path = scratch_dir(spark, "fastq")
    records = view(spark, sf_dir, "fastq").select("file", "row", F.concat_ws("\n", "name", "seq", F.lit("+"), "quality").alias("value"))
    records.repartition("file").sortWithinPartitions("file", "row").select("file", "value").write.partitionBy("file").option("compression", "gzip").text(path)
    names = read_fastq_names(spark, path).withColumn("file", F.regexp_extract("file", r"/file=([^/]+)/", 1))
    return manifest.index_vote(names)


@query(f"with {CLEAN}, l as (select id as rgsm, read1 as read1file, read2 as read2file, '/lists/' || flowcell || '.csv' as list from m where read1 is not null) select m.ordinal, m.id, l.read1file, l.read2file from m join l on l.rgsm = m.id and l.list = '/lists/' || m.flowcell || '.csv' where m.sample_type is not null")
def fastq_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = rows(spark, sf_dir).withColumn("list", F.concat(F.lit("/lists/"), "flowcell", F.lit(".csv")))
    lists = own.where("read1 is not null").select("list", F.col("id").alias("rgsm"), F.col("read1").alias("read1file"), F.col("read2").alias("read2file"))
    met = own.where("sample_type is not null").join(lists, (own["list"] == lists["list"]) & (F.col("id") == F.col("rgsm")))
    return met.select("ordinal", "id", "read1file", "read2file")
