"""Domain-shaped views of the given tables, as SQL text that Spark and DuckDB both run.

Bases are generated by rule from MD5 digests, so sites, reads and reference chunks agree without files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from locuslens.operators import intervals
from locuslens.session import table
from locuslens.sources.reference_store import store_reference


def dna(key: str) -> str:
    """32 generated bases for a string key."""
    return f"translate(md5({key}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def whole(expr: str) -> str:
    """Integer part of a quotient."""
    return f"cast(floor({expr}) as bigint)"


def chrom_of(key: str) -> str:
    return f"'chr' || cast({whole(f'(({key} - {key} % 3) % 66) / 3')} + 1 as string)"


def base_of(key: str) -> str:
    return f"(1000 + (({key} - {key} % 3) * 7919) % 2000000 + ({key} % 3) * 40)"


SITES = f"""select p_partkey as site_id, p_brand as source, substr({dna("'d' || cast(p_partkey as string)")}, 1, 20) as dna, substr({dna("'d' || cast(p_partkey as string)")}, 21, 3) as pam,
  {chrom_of("p_partkey")} as chrom, case when p_partkey % 2 = 0 then '+' else '-' end as strand, {base_of("p_partkey")} as start,
  case p_size % 3 when 0 then 'DNA' when 1 then 'RNA' else null end as bulge_type, p_size % 7 as mismatch, p_size % 3 as bulge_size, p_partkey % 97 = 0 as on_target
from {{part}}"""

_CLASS = "case when cast(l_quantity as bigint) % 10 = 0 then 0 else l_linenumber end"
_L = f"select *, {_CLASS} as cls, {chrom_of('l_partkey')} as chrom, {base_of('l_partkey')} - 21 - (l_suppkey % 6) * 10 as pos from {{lineitem}}"
_S = f"""select *, case cls when 0 then '30M2D5M1I60M' when 1 then '96M' when 2 then '40M3D56M' when 3 then '40M2I54M' when 4 then '8S88M' when 5 then '88M8S' when 6 then '30S66M' else '66M30S' end as cigar,
  pos + case cls when 0 then 97 when 1 then 96 when 2 then 99 when 3 then 94 when 4 then 88 when 5 then 88 else 66 end as "end",
  {dna("'a' || cast(l_orderkey % 16 as string)")} || {dna("'b' || cast(l_orderkey % 16 as string)")} || {dna("'c' || cast(l_orderkey % 16 as string)")} as body,
  case when l_suppkey % 2 = 1 then '-' else '+' end as strand, case when l_suppkey % 2 = 1 then '+' else '-' end as other,
  substr({dna(f"chrom || ':' || cast({whole('(pos - 45) / 32')} as string)")}, 9, 8) as before, substr({dna(f"chrom || ':' || cast({whole('(pos + 128) / 32')} as string)")}, 9, 8) as after
from ({_L}) l"""


def _sa(chrom: str, pos: str, strand: str, cigar: str, mq: int) -> str:
    return f"{chrom} || ',' || cast({pos} as string) || ',' || {strand} || ',{cigar},{mq},0;'"


_SA = f"""case
  when cls = 6 then case l_orderkey % 6 when 0 then {_sa("chrom", "pos - 79", "strand", "30M66S", 30)} when 1 then {_sa("'chrX'", "5000", "strand", "30M66S", 30)}
    when 2 then {_sa("'chrX'", "6000", "other", "66S30M", 30)} when 3 then {_sa("chrom", "pos - 59", "strand", "28M68S", 30)} when 4 then {_sa("'chrX'", "7000", "strand", "66S30M", 30)} else null end
  when cls = 7 then case l_orderkey % 6 when 0 then {_sa("chrom", '"end" + 41', "strand", "66S30M", 30)} when 1 then {_sa("'chrX'", "5000", "strand", "66S30M", 30)}
    when 2 then {_sa("'chrX'", "6000", "other", "30M66S", 30)} when 3 then {_sa("chrom", '"end" + 41', "strand", "66S30M", 5)} when 4 then {_sa("'chrX'", "7000", "strand", "30M66S", 30)} else null end
  else null end"""

READS = f"""select case when l_linestatus = 'O' then 'edited' else 'control' end as sample, 'r' || cast(l_partkey as string) || '_' || cast(l_orderkey % 12 as string) as qname,
  1 + case when l_suppkey % 5 <> 0 then 2 else 0 end + case when l_orderkey % 61 = 0 then 4 else 0 end + case when l_orderkey % 41 = 0 then 8 else 0 end
    + cast(l_suppkey % 2 as int) * 16 + case when l_suppkey % 3 = 0 then 32 else 0 end + case when l_linenumber % 2 = 1 then 64 else 128 end
    + case when l_orderkey % 53 = 0 then 256 else 0 end + case when l_orderkey % 50 = 0 then 1024 else 0 end + case when l_orderkey % 59 = 0 then 2048 else 0 end as flag,
  chrom, pos, "end", case when l_orderkey % 17 = 0 then 0 else 20 + cast(l_quantity as bigint) % 40 end as mapq, cigar,
  case when l_suppkey % 5 = 0 then 'chr' || cast(l_suppkey % 22 + 1 as string) else chrom end as mate_chrom,
  case when l_suppkey % 5 = 0 then 1000 + (l_orderkey * 997) % 2000000 else pos + 150 end as mate_pos,
  case cls when 4 then before || substr(body, 9, 88) when 5 then substr(body, 1, 88) || after else body end as seq,
  case when l_orderkey % 10 = 3 then null else cast(round(l_tax * 100) as bigint) end as nm,
  case when l_orderkey % 4 = 0 then {_SA} || 'chrY,500,+,30M66S,3,0;' else {_SA} end as sa, l_orderkey * 8 + l_linenumber as ordinal
from ({_S}) s"""

#: Reads as Spark computes them, row by row equal to ``READS``: the 16 bodies (31 with negative remainders) are a literal list, and the
#: bases around a clip are digested only for the reads that take them.
_BASES = str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT")
_BODIES = ", ".join("'" + "".join(hashlib.md5(f"{c}{r}".encode()).hexdigest() for c in "abc").translate(_BASES) + "'" for r in range(-15, 16))


def _eight(key: str) -> str:
    """Bases 9 to 16 of ``dna(key)``."""
    return f"translate(substr(md5({key}), 9, 8), '0123456789abcdef', 'ACGTACGTACGTACGT')"


_CLIPPED = {"before": "(pos - 45) / 32", "after": "(pos + 128) / 32"}
_AROUND = {name: f"""chrom || ':' || cast({whole(at)} as string)""" for name, at in _CLIPPED.items()}
SPARK_READS = READS.replace(f"""{dna("'a' || cast(l_orderkey % 16 as string)")} || {dna("'b' || cast(l_orderkey % 16 as string)")} || {dna("'c' || cast(l_orderkey % 16 as string)")} as body""", f"element_at(array({_BODIES}), cast(l_orderkey % 16 as int) + 16) as body")
SPARK_READS = SPARK_READS.replace(",\n  " + ", ".join(f"substr({dna(key)}, 9, 8) as {name}" for name, key in _AROUND.items()), "")
SPARK_READS = SPARK_READS.replace("then before ||", f"then {_eight(_AROUND['before'])} ||").replace("|| after else", f"|| {_eight(_AROUND['after'])} else")
#: Spark rounds by way of a decimal text; this is the same rounding, ties away from zero.
CENTS = "(rint(l_tax * 100) + case when l_tax * 100 - rint(l_tax * 100) = 0.5D and l_tax > 0 then 1 when l_tax * 100 - rint(l_tax * 100) = -0.5D and l_tax < 0 then -1 else 0 end)"
SPARK_READS = SPARK_READS.replace("round(l_tax * 100)", CENTS)

VAF = f"""select 'chr' || cast(l_suppkey % 22 + 1 as string) as chrom, (l_orderkey * 997) % 5000000 as start, (l_orderkey * 997) % 5000000 + 1 as "end", l_discount * 10 as score, l_orderkey * 8 + l_linenumber as ordinal from {{lineitem}}"""
COVERAGE = """select 'chr' || cast(o_custkey % 22 + 1 as string) as chrom, (o_orderkey * 4001) % 5000000 as start, (o_orderkey * 4001) % 5000000 + 1000 as "end", round(o_totalprice / 100000, 3) as coverage, o_orderkey as ordinal from {orders}"""
MANIFEST = f"""select c_custkey as ordinal, c_name as id, 'u' || cast({whole("c_custkey / 2")} as string) as uid,
  case when c_custkey % 7 = 0 then ' ' when c_custkey % 2 = 1 then 'tumor' else 'normal' end as sample_type, c_mktsegment as assay,
  substr({dna("c_name")}, 1, 8) as i7index, substr({dna("c_name")}, 9, 8) as i5index, 'FC' || cast(c_nationkey as string) as flowcell, c_custkey % 4 + 1 as lane,
  case when c_custkey % 13 = 0 then '/results/' || c_name else '' end as dragen_path,
  case when c_custkey % 5 = 0 then '' else '/data/' || c_name || '_R1_001' || case when c_custkey % 11 = 0 then '.txt' when c_custkey % 3 = 0 then '.fq.gz' else '.fastq.gz' end end as read1,
  case when c_custkey % 5 = 0 then '' when c_custkey % 9 = 0 then '' else '/data/' || c_name || '_R2_001' || case when c_custkey % 17 = 0 then '.fq.gz' else '.fastq.gz' end end as read2,
  case when c_custkey % 10 = 5 then '/aln/' || c_name || '.cram' else '' end as cram, case when c_custkey % 10 = 0 then '/aln/' || c_name || '.bam' else '' end as bam,
  '/hot/' || cast(c_nationkey as string) || '.bed' as hotspot_file from {{customer}}"""
FASTQ = f"""select 'f' || cast(doc_id % 40 as string) as file, doc_id as row, '@m' || source || ':7:FC' || cast(doc_id % 3 as string) || ':' || cast(doc_id % 4 + 1 as string) || ':' || cast(doc_id as string)
  || case when doc_id % 40 = 7 then '' else ' 1:N:0:' || substr({dna("cast(doc_id % 4 as string)")}, 1, 8) || '+' || substr({dna("cast(doc_id % 4 as string)")}, 9, 8) end as name,
  {dna("'q' || cast(doc_id % 97 as string)")} || {dna("'q' || cast(doc_id as string)")} || case when doc_id % 6 = 0 then 'AGATCGGAAGAGC' else 'TTTTTTTTTTTTT' end as seq,
  translate(md5('x' || cast(doc_id as string)), '0123456789abcdef', '#+5:?ABCDEFGHIJJ') as quality from {{documents}}"""
GENES = """select s_suppkey as gene_id, 'G' || cast(s_suppkey as string) as symbol, 'chr' || cast(s_suppkey % 22 + 1 as string) as gene_chrom, (s_suppkey * 15013) % 2000000 as gene_start, (s_suppkey * 15013) % 2000000 + 20000 + (s_suppkey % 7) * 1000 as gene_end from {supplier}"""
VERSIONS = """select r_name || ':' || n_name || ':' || 'STEP' || cast(n_nationkey % 4 as string) as process, 'tool' || cast(n_nationkey % 2 as string) as tool, '1.' || cast(n_regionkey % 2 as string) as version from {nation} n join {region} r on n.n_regionkey = r.r_regionkey"""

VIEWS = {"sites": (SITES, ["part"]), "reads": (READS, ["lineitem"]), "vaf": (VAF, ["lineitem"]), "coverage": (COVERAGE, ["orders"]), "manifest": (MANIFEST, ["customer"]), "fastq": (FASTQ, ["documents"]), "genes": (GENES, ["supplier"]), "versions": (VERSIONS, ["nation", "region"])}

#: Cheaper text of a view for Spark, with the same rows.
SPARK_TEXTS = {"reads": SPARK_READS}


#: Tasks a core that rows of a dealt view take, where the files give fewer.
WAVES = 4


def view(spark: SparkSession, sf_dir: str, name: str, deal: bool = False) -> DataFrame:
    """A domain view over the tables of ``sf_dir``; ``deal`` where each row costs much."""
    text, tables = VIEWS[name]
    text = SPARK_TEXTS.get(name, text)
    return spark.sql(text.replace('"end"', "`end`"), **{t: table(spark, sf_dir, t, deal, WAVES) for t in tables})


def duck(name: str) -> str:
    """The same view as a DuckDB common table expression ``<name>_v``."""
    text, tables = VIEWS[name]
    return f"{name}_v as ({text.format(**{t: t for t in tables})})"


def reference(spark: SparkSession, sf_dir: str, reach: int = 600) -> DataFrame:
    """A stored reference from generated chunks of 32 bases around all sites."""
    # sites with one range of chunks count once, and a chunk's bases are computed once, not per site
    chunks = spark.sql(
        f"""select chrom, chunk, {dna("chrom || ':' || cast(chunk as string)")} as bases from (select distinct chrom, explode(sequence(a, b)) as chunk from
        (select distinct chrom, cast(greatest(0, floor((start - {reach}) / 32)) as bigint) as a, cast(floor((start + {reach}) / 32) as bigint) as b from {{sites}}) r) c""",
        sites=view(spark, sf_dir, "sites"),
    )
    # looked up once by most queries, so packing would not pay
    return store_reference(intervals.reference_tiles(chunks), pack=False)


def duck_slice(chrom: str, start: str, end: str) -> str:
    """DuckDB expression for reference bases of ``[start, end)``."""
    chunks = f"range(floor(({start}) / 32)::BIGINT, floor((({end}) - 1) / 32)::BIGINT + 1)"
    bases = dna(f"{chrom} || ':' || k::VARCHAR")
    return f"substr(array_to_string(list_transform({chunks}, lambda k: {bases}), ''), (({start}) - floor(({start}) / 32)::BIGINT * 32 + 1)::BIGINT, (({end}) - ({start}))::BIGINT)"
