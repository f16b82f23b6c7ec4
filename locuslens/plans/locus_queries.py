"""Queries over sites, reads and loci: clustering, overlap joins, read classes, alleles, the locus report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslens import adapters
from locuslens.adapters import duck, duck_slice, view
from locuslens.operators import alignments, classify, control, intervals, junctions, loci
from locuslens.registry import query
from locuslens.session import cut

WINDOW, DISTANCE = 100, 25

# ---- shared SQL --------------------------------------------------------------------------------------
INTERVALS = f"""{duck("sites")}, iv as (
  select site_id, chrom, start - 1 as start, start as "end", start as pos, on_target,
    source || ',' || dna || ',' || pam || ',' || chrom || ',' || start::VARCHAR || ',' || strand || ',' || mismatch::VARCHAR || ',' || coalesce(bulge_type, 'nan') || ',' || bulge_size::VARCHAR as info from sites_v)"""
CLUSTERS = f"""{INTERVALS}, cl0 as (select *, case when start <= max("end") over (partition by chrom order by start, "end" rows between unbounded preceding and 1 preceding) + {WINDOW} then 0 else 1 end as fresh from iv),
cl as (select *, sum(fresh) over (partition by chrom order by start, "end" rows between unbounded preceding and current row)::BIGINT as cluster from cl0)"""
LOCI = f"""{CLUSTERS}, loci as (select chrom || ':' || min(start)::VARCHAR as locus, chrom as locus_chrom, min(start) as locus_start, max("end") as locus_end,
  string_agg(pos::VARCHAR, ';' order by pos, site_id) as positions, string_agg(info, ';' order by pos, site_id) as target_info, arg_min(on_target, (start, site_id)) as is_target from cl group by chrom, cluster)"""
PRIMARY = "(flag & 3332) = 0 and mapq > 0"


def op_sum(c: str, ops: str) -> str:
    return f"coalesce(list_sum(list_transform(regexp_extract_all({c}, '([0-9]+)[{ops}]', 1), lambda n: n::BIGINT)), 0)::BIGINT"


def first_n(c: str, pattern: str) -> str:
    return f"coalesce(nullif(regexp_extract({c}, '{pattern}', 1), '')::BIGINT, 0)"


def n_ops(c: str) -> str:
    return f"length(regexp_replace({c}, '[0-9]', '', 'g'))"


BUDGET = f"(nm is null or nm <= 5 or nm - {op_sum('cigar', 'DN')} <= 5)"
PAIRS = f"""{LOCI}, {duck("reads")}, pairs as (select r.*, l.* from reads_v r join loci l on r.chrom = l.locus_chrom and r.pos < l.locus_end + {WINDOW} and r."end" > l.locus_start - {WINDOW})"""
SA = "list_transform(list_filter(string_split(coalesce(sa, ''), ';'), lambda x: x <> ''), lambda x: string_split(x, ','))"
ALIKE = "s[5]::BIGINT >= 10 and s[6]::BIGINT < 5 and s[1] = chrom and s[3] = strand"
CLASSES = f"""{PAIRS}, c1 as (select *, {first_n("cigar", "^([0-9]+)S")} as lc, {first_n("cigar", "([0-9]+)S$")} as rc, pos + 1 as start1, "end" as end1, case when flag & 16 <> 0 then '-' else '+' end as strand, ({SA})[1] as s
  from pairs where {PRIMARY} and {BUDGET}),
c2 as (select *, s[2]::BIGINT as sp, {op_sum("s[4]", "MDN")} as s_span, {first_n("s[4]", "^([0-9]+)[SHP=X]")} as s_left, {first_n("s[4]", "([0-9]+)[SHP=X]$")} as s_right, {op_sum("s[4]", "MI")} as s_query,
  {first_n("s[4]", "^([0-9]+)M")} as s_lead, {first_n("s[4]", "([0-9]+)M$")} as s_tail from c1),
c3 as (select *, coalesce(lc > rc and {ALIKE} and sp < start1 and start1 - sp < 100000, false) as nl, coalesce(rc > lc and {ALIKE} and sp > end1 and sp - end1 < 100000 and s_left > 0 and s_tail > 0, false) as nr from c2),
c4 as (select *, nl and s_right > 0 and s_lead = lc as spl, nr and s_tail = rc as spr,
  case when lc > rc and not nl and lc >= 5 then {duck_slice("chrom", f"pos - {WINDOW}", "pos")} when rc > lc and s is null and rc >= 5 then {duck_slice("chrom", '"end"', f'"end" + {WINDOW}')} end as near,
  case when lc > rc then substr(seq, 1, lc) else right(seq, rc) end as clip from c3),
c5 as (select *, case when lc > rc and instr(reverse(near), reverse(clip)) > 0 then pos - {WINDOW} + length(near) - instr(reverse(near), reverse(clip)) - length(clip) + 1
  when rc > lc and instr(near, clip) > 0 then "end" + instr(near, clip) - 1 end as hit from c4),
c6 as (select *, case when spl then regexp_replace(s[4], '[0-9]+[SHP=X]$', '') || case when pos - (sp - 1 + s_span) > 0 then (pos - (sp - 1 + s_span))::VARCHAR || 'D' else '' end || regexp_replace(cigar, '^[0-9]+S', '')
  when spr then regexp_replace(cigar, '[0-9]+S$', '') || case when sp - 1 - "end" > 0 then (sp - 1 - "end")::VARCHAR || 'D' else '' end || regexp_replace(s[4], '^[0-9]+[SHP=X]', '')
  when hit is not null and lc > rc then lc::VARCHAR || 'M' || case when pos - hit - lc > 0 then (pos - hit - lc)::VARCHAR || 'D' else '' end || regexp_replace(cigar, '^[0-9]+S', '')
  when hit is not null then regexp_replace(cigar, '[0-9]+S$', '') || case when hit - "end" > 0 then (hit - "end")::VARCHAR || 'D' else '' end || rc::VARCHAR || 'M' else cigar end as joined from c5),
c7 as (select * exclude (start1), case when nl then sp when hit is not null and lc > rc then hit + 1 else start1 end as start1 from c6),
c8 as (select * exclude (end1), case when rc > lc and (s is not null or hit is not null) then start1 + {op_sum("joined", "MDN")} else end1 end as end1 from c7),
c9 as (select *, {first_n("joined", "^([0-9]+)[SHP=X]")} as q_from, regexp_replace(regexp_replace(joined, '^[0-9]+[SHP=X]', ''), '[0-9]+[SHP=X]$', '') as core from c8 where start1 - lc < locus_end + {DISTANCE} and end1 + rc > locus_start - {DISTANCE}),
c10 as (select *, {n_ops("core")} > 1 as is_event, {first_n("core", "^([0-9]+)M")} as lead, regexp_replace(regexp_replace(core, '^[0-9]+M', ''), '[0-9]+M$', '') as event from c9),
c11 as (select *, start1 + lead as e_pos, q_from + lead as e_query, {op_sum("event", "MIDNSHP=X")} as e_all,
  case when is_event then case when {n_ops("event")} = 1 and event like '%I' then 'I' when {n_ops("event")} = 1 and regexp_matches(event, '[DN]$') then 'D' else 'C' end end as kind,
  case when s_left > s_right then sp + greatest(0, {op_sum("core", "MI")} + s_query - length(seq)) else sp end as s_pos,
  sp + s_span - 1 - case when s_right > s_left then greatest(0, {op_sum("core", "MI")} + s_query - length(seq)) else 0 end as s_end from c10),
c12 as (select *, case when kind = 'I' then {duck_slice("chrom", "e_pos - 2", "e_pos - 1")} when kind is not null then {duck_slice("chrom", "e_pos - 1", "e_pos + e_all")} end as ref_bases,
  coalesce(not is_event and s is not null and (lc > 0 or rc > 0) and ((s[5]::BIGINT >= 10 and s[6]::BIGINT <= 5 and (s[1] <> chrom or abs(s_pos - start1) >= 100000)) or s[3] <> strand or (rc > 0 and s_end < start1) or (lc > 0 and s_pos > end1)), false) as bnd from c11),
c13 as (select *, case when bnd then case when s[3] = strand and rc > lc and s_left > s_right then 1 when s[3] = strand and lc > rc and s_right > s_left then 2 when s[3] <> strand and rc > lc and s_right > s_left then 3 when s[3] <> strand and lc > rc and s_left > s_right then 4 end end as pat from c12),
c14 as (select *, case when is_event then 'INDEL' when bnd then case when pat is not null then 'BND' end when start1 < locus_end and end1 > locus_start then 'REF' end as type from c13),
classes as (select sample, qname, ordinal, locus, chrom, case type when 'INDEL' then e_pos when 'BND' then case when pat in (1, 3) then end1 else start1 - 1 end else locus_start end as pos,
  case when type = 'BND' then s[1] end as chrom2, case when type = 'BND' then case pat when 1 then s_pos when 2 then s_end + 1 when 3 then s_end else s_pos end end as pos2,
  case type when 'INDEL' then '++' when 'BND' then case when s[3] = strand then '++' else '+-' end else '' end as strands, case type when 'INDEL' then ref_bases when 'BND' then '' else '.' end as ref,
  case type when 'INDEL' then case kind when 'I' then substr(seq, e_query, e_all + 1) when 'D' then substr(ref_bases, 1, 1) else substr(seq, e_query + 2, greatest(0, {op_sum("event", "MI")} - 1)) end when 'BND' then '' else '.' end as alt, type from c14 where type is not null)"""
FIRST = "case type when 'INDEL' then 0 when 'BND' then 1 else 2 end, ordinal, pos, coalesce(chrom2, ''), coalesce(pos2, -1), strands, coalesce(ref, ''), coalesce(alt, '')"
FRAGMENTS = CLASSES + ", fragments as (select sample, locus, qname, " + ", ".join(f"arg_min({c}, ({FIRST})) filter (where {c} is not null) as {c}" for c in classify.ALLELE) + " from classes group by sample, locus, qname)"
ALLELES = FRAGMENTS + ", alleles as (select sample, locus, chrom, pos, chrom2, pos2, strands, ref, alt, type, count(*) as counts from fragments group by all)"
DISTANCES = ALLELES + """, far as (select a.*, positions, case when pos is not null then list_min(list_transform(string_split(positions, ';'), lambda p: least(abs(pos - p::BIGINT), abs(pos + length(ref) - 1 - p::BIGINT)))) end as distance from alleles a join loci l using (locus))"""
DEPTH = f"""depth as (select l.locus, count(distinct qname) as control_reads from loci l left join (select * from reads_v where sample = 'control' and {PRIMARY}) r on r.chrom = l.locus_chrom and r.pos < l.locus_end and r."end" > l.locus_start - {WINDOW} group by l.locus)"""


# ---- shared frames -----------------------------------------------------------------------------------
# SQL cannot align reads: queries with SQL classify by the reads' own alignments, those without it with realignment.
def site_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.site_intervals(view(spark, sf_dir, "sites"))


def locus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.locus_members(site_rows(spark, sf_dir), WINDOW)


def paired(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None, deal: bool = False) -> DataFrame:
    return classify.reads_in_loci(view(spark, sf_dir, "reads", deal), locus_rows(spark, sf_dir) if sites is None else sites, WINDOW)


def class_rows(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None, realigns: bool = False) -> DataFrame:
    sites = cut(locus_rows(spark, sf_dir), "loci") if sites is None else sites
    return classify.classify(paired(spark, sf_dir, sites, True), adapters.reference(spark, sf_dir), WINDOW, DISTANCE, realigns=realigns)


def allele_rows(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None, realigns: bool = False) -> DataFrame:
    return classify.count_alleles(classify.collapse_fragments(class_rows(spark, sf_dir, sites, realigns)))


def distant_rows(spark: SparkSession, sf_dir: str, sites: DataFrame | None = None, realigns: bool = False) -> DataFrame:
    sites = cut(locus_rows(spark, sf_dir), "loci") if sites is None else sites
    return loci.with_distance(allele_rows(spark, sf_dir, sites, realigns).where("sample = 'edited'"), sites)


def unscored_rows(spark: SparkSession, sf_dir: str, sites: DataFrame, least_reads: int = 1, realigns: bool = False) -> DataFrame:
    """Edited alleles that pass all filters but that of the control, whose support is not looked at."""
    return loci.candidate_filter(distant_rows(spark, sf_dir, sites, realigns).withColumn("control_alt", F.lit(0).cast("bigint")), least_reads, distance=DISTANCE)


def filtered_rows(spark: SparkSession, sf_dir: str, sites: DataFrame, least_reads: int = 1) -> DataFrame:
    """Edited alleles that pass all filters, scored in the control; as the filters are joined by "and", those that another one drops need no score."""
    others = cut(unscored_rows(spark, sf_dir, sites, least_reads, realigns=True).drop("control_alt"), "alleles")  # classified once, read by the scorer and the filter
    scored = control.with_control_alt(others, control_reads(spark, sf_dir), sites, adapters.reference(spark, sf_dir), WINDOW)
    return loci.candidate_filter(scored, least_reads, distance=DISTANCE)


def control_reads(spark: SparkSession, sf_dir: str, deal: bool = True) -> DataFrame:
    return view(spark, sf_dir, "reads", deal).where("sample = 'control'")


# ---- sites -------------------------------------------------------------------------------------------
@query(f'with {INTERVALS} select site_id, chrom, start, "end", pos, info, on_target from iv')
def site_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_rows(spark, sf_dir)


@query(f"with {CLUSTERS} select site_id, chrom, cluster from cl")
def interval_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.cluster(site_rows(spark, sf_dir), slack=WINDOW).select("site_id", "chrom", "cluster")


@query(f'with {CLUSTERS} select chrom, min(start) as start, max("end") as "end" from cl group by chrom, cluster')
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.merge(site_rows(spark, sf_dir).select("chrom", "start", "end"), slack=WINDOW)


@query(f"with {LOCI} select locus, locus_chrom, locus_start, locus_end, positions, target_info, is_target from loci")
def locus_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locus_rows(spark, sf_dir)


@query(f"with {LOCI} select locus, locus_start, locus_end from loci where locus_chrom = 'chr19'")
def chrom_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    # restricted before clustering: loci do not cross chromosomes, and the filter reaches the scan
    return loci.locus_members(site_rows(spark, sf_dir).where("chrom = 'chr19'"), WINDOW).select("locus", "locus_start", "locus_end")


@query(f"with {duck('sites')} select site_id, dna, reverse(translate(dna, 'ACGT', 'TGCA')) as revcomp from sites_v")
def revcomp_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.reverse_complement_sites(view(spark, sf_dir, "sites"))


@query(f"with {duck('sites')} select site_id, chrom || ':' || strand || start::VARCHAR as hotspot, coalesce(nullif(bulge_type, ''), 'N/A') as bulge, coalesce(nullif(pam, ''), 'N/A') as pam from sites_v")
def legacy_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A")).alias(c)
    place = F.concat("chrom", F.lit(":"), "strand", F.col("start").cast("string"))
    return view(spark, sf_dir, "sites").select("site_id", place.alias("hotspot"), known("bulge_type").alias("bulge"), known("pam"))


@query(f"with {duck('sites')} select distinct chrom, strand, pam from sites_v")
def distinct_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "sites").select("chrom", "strand", "pam").distinct()


@query(f"with {duck('sites')} select site_id, regexp_replace(chrom, '^chr', '') as chrom, start from sites_v")
def strip_chr(spark: SparkSession, sf_dir: str) -> DataFrame:
    fed = view(spark, sf_dir, "sites").select("site_id", "chrom", "start", "source")
    return fed.withColumn("chrom", F.regexp_replace("chrom", "^chr", "")).drop(fed.columns[-1])


@query(f"""with {duck("sites")}, wide as (select chrom, greatest(0, start - 200) as a, start + 200 as b from sites_v),
  w0 as (select *, case when a <= max(b) over (partition by chrom order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from wide),
  w1 as (select *, sum(fresh) over (partition by chrom order by a, b rows between unbounded preceding and current row) as c from w0),
  m as (select chrom, min(a) as a, max(b) as b from w1 group by chrom, c), e as (select chrom, unnest(range(a, b + 1)) as pos from m)
  select chrom, pos, {duck_slice("chrom", "pos - 1", "pos")} as base, 'N' as alt from e""")  # fmt: skip
def hotspot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locuslens.operators import hotspots

    sites = view(spark, sf_dir, "sites").select("chrom", "start")
    return hotspots.positions(hotspots.site_windows(sites, 200), adapters.reference(spark, sf_dir))


@query(f"with {duck('sites')} select site_id, {duck_slice('chrom', 'start - 11', 'start + 10')} as bases from sites_v")
def ref_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    around = view(spark, sf_dir, "sites").select("site_id", "chrom", (F.col("start") - 11).alias("a"), (F.col("start") + 10).alias("b"))
    return intervals.fetch_sequence(around, adapters.reference(spark, sf_dir), "chrom", "a", "b", "bases").select("site_id", "bases")


@query(f"with {INTERVALS}, {duck('genes')}, hit as (select site_id, symbol, gene_end - gene_start as width from iv join genes_v on chrom = gene_chrom and start < gene_end and \"end\" > gene_start) select site_id, symbol, row_number() over (partition by site_id order by width, symbol) = 1 as picked from hit")
def annotate_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locuslens.operators import annotate

    return annotate.annotate(site_rows(spark, sf_dir), view(spark, sf_dir, "genes"), "site_id")


# ---- reads -------------------------------------------------------------------------------------------
@query(f"with {PAIRS} select qname, ordinal, locus from pairs")
def reads_in_loci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paired(spark, sf_dir).select("qname", "ordinal", "locus")


@query(f"with {duck('reads')} select qname, ordinal, mapq from reads_v where {PRIMARY}")
def primary_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.primary_reads(view(spark, sf_dir, "reads")).select("qname", "ordinal", "mapq")


@query(f"with {duck('reads')} select qname, ordinal, nm from reads_v where {BUDGET}")
def mismatch_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.mismatch_budget(view(spark, sf_dir, "reads")).select("qname", "ordinal", "nm")


@query(f"with {PAIRS} select ordinal, locus from pairs where pos + 1 - {first_n('cigar', '^([0-9]+)S')} < locus_end + 25 and \"end\" + {first_n('cigar', '([0-9]+)S$')} > locus_start - 25")
def locus_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.locus_reach(paired(spark, sf_dir), DISTANCE).select("ordinal", "locus")


@query(f"with {duck('reads')} select qname, ordinal, pos from reads_v where not (pos between 3130 and 5930)")
def exclude_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.exclude_interval(view(spark, sf_dir, "reads")).select("qname", "ordinal", "pos")


@query(f"with {duck('reads')} select qname, ordinal, cigar, {n_ops('cigar')} as n_ops, " + ", ".join(f"{op_sum('cigar', o)} as n_{o.lower()}" for o in "MIDNS") + f", {op_sum('cigar', 'MDN')} as ref_span, {op_sum('cigar', 'MIS')} as query_span, {first_n('cigar', '^([0-9]+)S')} as left_clip, {first_n('cigar', '([0-9]+)S$')} as right_clip from reads_v")
def cigar_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.cigar_profile(view(spark, sf_dir, "reads", True))


EXPLODED = f"{duck('reads')}, ex as (select *, unnest({SA}) as s, unnest(range(0, len({SA}))) as n from reads_v)"


@query(f"with {EXPLODED} select qname, ordinal, n, s[1] as chrom, s[2]::BIGINT as pos, s[3] as strand, s[4] as cigar, s[5]::BIGINT as mq, s[6]::BIGINT as nm from ex")
def sa_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.explode_supplementary(view(spark, sf_dir, "reads", True))


def positions_sql(c: str) -> str:
    """Aligned query positions as a list: one base per entry of the expanded CIGAR, insertions removed."""
    flat = f"array_to_string(list_transform(regexp_extract_all({c}, '[0-9]+[MDNSHP=X]'), lambda o: repeat(right(o, 1), left(o, -1)::INT)), '')"
    return f"list_filter(list_transform(range(1, length({flat}) + 1), lambda i: case when substr({flat}, i, 1) = 'M' then i end), lambda i: i is not null)"


SPLIT_AT = f"sp as (select *, {positions_sql('cigar')} as x, {positions_sql('s[4]')} as y from ex)"


@query(f"with {EXPLODED}, {SPLIT_AT} select qname, ordinal, n, len(x)::BIGINT as aligned, len(y)::BIGINT as sa_aligned, len(list_intersect(x, y))::BIGINT as \"both\" from sp")
def aligned_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.aligned_overlap(view(spark, sf_dir, "reads", True))


MATES = f"""{duck("reads")}, own as (select *, flag & 64 <> 0 as f from reads_v where (flag & 2304) = 0), mate as (select sample, qname, f, arg_min(seq, (ordinal, seq)) as mate_seq from own group by all),
mated as (select o.*, coalesce(m.mate_seq, '.') as mate_seq from own o left join mate m on m.sample = o.sample and m.qname = o.qname and m.f <> o.f)"""


@query(f"with {MATES} select qname, ordinal, mate_seq from mated")
def mate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments.join_mates(view(spark, sf_dir, "reads", True)).select("qname", "ordinal", "mate_seq")


@query(f"with {CLASSES} select ordinal, locus, hit from c5 where hit is not null")
def clip_reanchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = classify.parsed(paired(spark, sf_dir, None, True)).withColumns(classify.near_supplementary()).where(classify.ASKS)
    return classify.reanchor_clips(own, adapters.reference(spark, sf_dir), WINDOW).where("hit is not null").select("ordinal", "locus", "hit")


@query()
def realigned_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads whose near parts cannot be spliced, with their CIGAR between both parts, which SQL cannot compute."""
    own = classify.with_parts(classify.parsed(paired(spark, sf_dir, None, True)))
    return classify.realign_parts(own, adapters.reference(spark, sf_dir)).select("sample", "qname", "ordinal", "locus", "near_left", "cigar", F.col("s")["cigar"].alias("sa_cigar"), "realigned")


@query()
def read_classes_realigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``read_classes`` with reads of unspliced parts aligned anew, as the scored report uses them."""
    return class_rows(spark, sf_dir, realigns=True)


@query(f"with {CLASSES} select * from classes")
def read_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_rows(spark, sf_dir)


@query(f"with {FRAGMENTS} select * from fragments")
def fragment_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.collapse_fragments(class_rows(spark, sf_dir))


@query(f"with {ALLELES} select * from alleles")
def allele_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allele_rows(spark, sf_dir)


@query(f"with {DISTANCES} select locus, pos, ref, alt, type, chrom2, pos2, strands, counts, distance from far where sample = 'edited'")
def site_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distant_rows(spark, sf_dir).select("locus", "pos", "ref", "alt", "type", "chrom2", "pos2", "strands", "counts", "distance")


@query()
def candidate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = cut(locus_rows(spark, sf_dir), "loci")
    return filtered_rows(spark, sf_dir, sites, least_reads=2).select("locus", "pos", "ref", "alt", "type", "counts", "distance", "control_alt")


@query(f"with {DISTANCES} select locus, pos, ref, alt, type, counts, distance from far where sample = 'edited' and ((counts >= 2 and coalesce(distance <= 25, false)) or ref = '.')")
def candidates_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate filter without control scores, which SQL cannot compute."""
    return unscored_rows(spark, sf_dir, cut(locus_rows(spark, sf_dir), "loci"), least_reads=2).select("locus", "pos", "ref", "alt", "type", "counts", "distance")


@query(f"with {ALLELES} select sample, locus, pos, ref, alt, counts from (select * replace (case when counts % 2 = 0 then 'N' || alt else alt end as alt) from alleles) where not contains(alt, 'N')")
def no_ambiguous_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    # generated bases hold no N, so every second allele gets one
    masked = allele_rows(spark, sf_dir).withColumn("alt", F.when(F.col("counts") % 2 == 0, F.concat(F.lit("N"), "alt")).otherwise(F.col("alt")))
    return loci.drop_ambiguous(masked).select("sample", "locus", "pos", "ref", "alt", "counts")


FLANKED = f"{ALLELES}, fl as (select *, {duck_slice('chrom', 'pos - 151', 'pos - 1 + length(ref) + 150')} as ref_hap from alleles where type = 'INDEL' and sample = 'edited')"


@query(f"with {FLANKED} select locus, pos, ref, alt, ref_hap, substr(ref_hap, 1, 150) || alt || right(ref_hap, 150) as alt_hap from fl")
def allele_flanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = allele_rows(spark, sf_dir).where("sample = 'edited'")
    return control.allele_flanks(edited, adapters.reference(spark, sf_dir)).select("locus", "pos", "ref", "alt", "ref_hap", "alt_hap")


@query(f"""with {ALLELES}, cr as (select r.*, l.locus from reads_v r join loci l on r.chrom = l.locus_chrom and r.pos < l.locus_end and r."end" > l.locus_start - {WINDOW} where sample = 'control' and {PRIMARY} and not regexp_full_match(cigar, '[0-9]+M'))
  select a.locus, a.pos, a.ref, a.alt, c.ordinal as control_ordinal from alleles a join cr c using (locus) where a.sample = 'edited' and type = 'INDEL'
  and not (regexp_matches(cigar, '^[0-9]+M') and cigar like '%M' and ((length(alt) < length(ref) and cigar not like '%D%') or (length(alt) > length(ref) and cigar not like '%I%')))""")  # fmt: skip
def control_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = allele_rows(spark, sf_dir).where("sample = 'edited'")
    return control.control_pairs(edited, control_reads(spark, sf_dir), locus_rows(spark, sf_dir), WINDOW).select("locus", "pos", "ref", "alt", "control_ordinal")


@query(f"with {LOCI}, {duck('reads')}, {DEPTH} select locus, control_reads from depth")
def control_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loci.control_depth(control_reads(spark, sf_dir, False), locus_rows(spark, sf_dir), WINDOW)


@query()
def control_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = cut(locus_rows(spark, sf_dir), "loci")
    edited = cut(allele_rows(spark, sf_dir, sites, True).where("sample = 'edited' and type = 'INDEL'"), "alleles")
    return control.control_support(edited, control_reads(spark, sf_dir), sites, adapters.reference(spark, sf_dir), ["locus", "chrom", "pos", "chrom2", "pos2", "strands", "ref", "alt"], WINDOW)


@query(f"""with {DISTANCES}, {DEPTH}, f as (select * from far where sample = 'edited' and ((counts >= 1 and coalesce(distance <= {DISTANCE}, false)) or ref = '.') and not contains(alt, 'N')),
  agg as (select locus, sum(counts)::BIGINT as total_reads, sum(case when type <> 'REF' then counts else 0 end)::BIGINT as indel_reads, count(*) filter (where type = 'INDEL') as indel_count, count(*) filter (where type = 'BND') as bnd_count,
    string_agg(k, ';' order by k) filter (where type = 'INDEL') as indel_info, string_agg(k, ';' order by k) filter (where type = 'BND') as bnd_info from (
    select *, case type when 'INDEL' then concat_ws(':', chrom, pos, ref, alt, counts, 0, coalesce(distance::VARCHAR, '')) when 'BND' then concat_ws(':', chrom, pos, chrom2, pos2, strands, counts, 0, coalesce(distance::VARCHAR, '')) end as k from f) group by locus)
  select locus_chrom as chrom, locus_start as start, locus_end as "end", positions as pam_positions, coalesce(total_reads, 0) as total_reads, coalesce(indel_reads, 0) as indel_reads,
    case when coalesce(total_reads, 0) > 0 then round(indel_reads / total_reads, 4) else 0.0 end::DOUBLE as indel_fraction, case when total_reads is null then 0 else control_reads end as control_reads, 0::BIGINT as control_indel_reads,
    0.0::DOUBLE as control_indel_fraction, coalesce(indel_count, 0) as indel_count, coalesce(indel_info, '.') as indel_info, coalesce(bnd_count, 0) as bnd_count, coalesce(bnd_info, '.') as bnd_info, target_info, is_target
  from loci left join agg using (locus) left join depth using (locus)""")  # fmt: skip
def locus_report_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report before alleles are scored in the control, which SQL cannot do: all of them count."""
    sites = cut(locus_rows(spark, sf_dir), "loci")
    alleles = loci.drop_ambiguous(unscored_rows(spark, sf_dir, sites))
    return loci.locus_report(alleles, sites, loci.control_depth(control_reads(spark, sf_dir, False), sites, WINDOW))


@query()
def locus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = cut(locus_rows(spark, sf_dir), "loci")
    alleles = loci.drop_ambiguous(filtered_rows(spark, sf_dir, sites))
    return loci.locus_report(alleles, sites, loci.control_depth(control_reads(spark, sf_dir, False), sites, WINDOW))


# ---- junctions ---------------------------------------------------------------------------------------
USABLE = "(flag & 3328) = 0 and mapq > 0 and not (pos between 3130 and 5930)"


@query(f"""with {MATES}, j as (select *, mate_pos + case when flag & 32 = 0 then 151 else 0 end as jpos from mated where {USABLE} and flag & 2 = 0 and flag & 8 = 0 and chrom <> mate_chrom)
  select qname, ordinal, mate_chrom as "Chromosome", jpos - 1 as "Start", jpos as "End", 'INS' as "Var", case when flag & 32 = 0 then '+' else '-' end as "Strand", 'ID=' || qname || ';Type=PR;Read1Seq=' || seq || ';Read2Seq=' || mate_seq as "Info", 'PR' as evidence from j""")  # fmt: skip
def junctions_discordant(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = view(spark, sf_dir, "reads", True)
    return junctions.discordant(alignments.join_mates(junctions.apart(junctions.usable(reads)), reads))


@query(f"""with {MATES}, ex as (select *, unnest({SA}) as s from mated where {USABLE} and flag & 2 <> 0 and case when flag & 16 <> 0 then {first_n("cigar", "([0-9]+)S$")} else {first_n("cigar", "^([0-9]+)S")} end >= 20), {SPLIT_AT},
  j as (select *, s[2]::BIGINT + case when s[3] = '+' then len(y) else 0 end as jpos from sp where s[1] <> chrom and s[5]::BIGINT >= 1 and s[6]::BIGINT <= 1 and len(list_intersect(x, y)) < 0.2::DOUBLE * len(x))
  select qname, ordinal, s[1] as "Chromosome", jpos - 1 as "Start", jpos as "End", 'INS' as "Var", s[3] as "Strand", 'ID=' || qname || ';Type=PR;Read1Seq=' || seq || ';Read2Seq=' || case when chrom = mate_chrom then '.' else mate_seq end as "Info", 'SR' as evidence from j""")  # fmt: skip
def junctions_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = view(spark, sf_dir, "reads", True)
    return junctions.split(alignments.join_mates(junctions.clipped(junctions.usable(reads)), reads))
