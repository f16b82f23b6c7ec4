"""Candidate sites, merged loci, allele filters and the locus report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.functions import dna
from locuslens.operators import alignments, intervals
from locuslens.session import cut


def site_intervals(sites: DataFrame) -> DataFrame:
    """Sites with 1-based ``start`` as one-base intervals with their description; missing fields read ``nan``."""
    fields = ["source", "dna", "pam", "chrom", "start", "strand", "mismatch", "bulge_type", "bulge_size"]
    info = F.concat_ws(",", *(F.coalesce(F.col(f).cast("string"), F.lit("nan")) for f in fields))
    return sites.select("site_id", "chrom", (F.col("start") - 1).alias("start"), F.col("start").alias("end"), F.col("start").alias("pos"), info.alias("info"), "on_target")


def locus_members(sites: DataFrame, slack: int = 100) -> DataFrame:
    """Merged loci with the sorted positions and descriptions of their sites and the first site's target flag."""
    own = intervals.cluster(sites, slack=slack)
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "site_id", F.col(c).cast("string").alias("v")))), lambda x: x.v), ";")
    out = own.groupBy("chrom", "cluster").agg(F.min("start").alias("locus_start"), F.max("end").alias("locus_end"), text("pos").alias("positions"), text("info").alias("target_info"), F.min_by("on_target", F.struct("start", "site_id")).alias("is_target"))
    name = F.concat_ws(":", "chrom", F.col("locus_start").cast("string"))
    return out.select(name.alias("locus"), F.col("chrom").alias("locus_chrom"), "locus_start", "locus_end", "positions", "target_info", "is_target")


def site_positions(positions: Column) -> Column:
    return F.transform(F.split(positions, ";"), lambda p: p.cast("bigint"))


def nearest(at: Column, sites: Column) -> Column:
    """Distance of a place to the nearest of ``sites``; null for a null place."""
    return F.array_min(F.transform(sites, lambda s: F.abs(at - s)))


#: Sites of a locus that every allele is compared with; where a locus has more, alleles meet the sites of their stretch of so many bases.
FEW_SITES, STRETCH = 32, 64


def site_stretches(loci: DataFrame, width: int = STRETCH) -> DataFrame:
    """``(locus, _first, _last, _stretch, _near)``: per stretch of a locus its sites, the last one before and the first one behind them.

    Stretches without sites have those around them, so the nearest site of any place is among those of its stretch, or of the locus' nearest one.
    """
    held = loci.select("locus", F.explode(site_positions(F.col("positions"))).alias("p")).groupBy("locus", F.floor(F.col("p") / width).alias("_at")).agg(F.collect_set("p").alias("_own"))
    along = W.partitionBy("locus").orderBy("_at")
    around = F.array_compact(F.array(F.lag(F.array_max("_own")).over(along), F.lead(F.array_min("_own")).over(along)))
    held = held.select("*", around.alias("_around"), F.coalesce(F.lead("_at").over(along) - 1, F.col("_at")).alias("_to"), F.min("_at").over(W.partitionBy("locus")).alias("_first"), F.max("_at").over(W.partitionBy("locus")).alias("_last"))
    return held.select("locus", "_first", "_last", F.explode(F.sequence("_at", "_to")).alias("_stretch"), F.concat("_own", "_around").alias("_near"))


def with_distance(alleles: DataFrame, loci: DataFrame, few: int = FEW_SITES) -> DataFrame:
    """Alleles of ``loci`` with ``distance``: of their first or last reference base to the nearest site; null for a null position.

    ``loci`` are written. Where none has more than ``few`` sites, alleles meet all of their locus; otherwise those of their stretch, as
    loci that grow together would make this work grow with alleles times sites.
    """
    first, last = F.col("pos"), F.col("pos") + F.length("ref") - 1
    if (loci.agg(F.max(F.size(F.split("positions", ";"))).alias("n")).head().n or 0) <= few:
        near = alleles.join(loci.select("locus", site_positions(F.col("positions")).alias("_sites")), "locus")
        return near.withColumn("distance", F.least(nearest(first, F.col("_sites")), nearest(last, F.col("_sites")))).drop("_sites")
    stretches = cut(site_stretches(loci), "site-stretches")
    own = alleles.join(stretches.select("locus", "_first", "_last").distinct(), "locus")
    place = lambda at: F.least(F.greatest(F.floor(at / STRETCH), F.col("_first")), F.col("_last"))
    # a null place lies anywhere, as its distance is null
    own = own.withColumns({"_from": F.when(first.isNull(), F.col("_first")).otherwise(place(first)), "_to": F.when(last.isNull(), F.col("_first")).otherwise(place(last))})
    for end in ("_from", "_to"):
        own = own.join(stretches.select("locus", F.col("_stretch").alias(end), F.col("_near").alias(f"_near{end}")), ["locus", end])
    distance = F.least(nearest(first, F.col("_near_from")), nearest(last, F.col("_near_to")))
    return own.select("locus", *(c for c in alleles.columns if c != "locus"), distance.alias("distance"))


def candidate_filter(alleles: DataFrame, least_reads: int = 1, most_control: int = 0, distance: int = 25) -> DataFrame:
    """Alleles with enough reads, little control support and a near site; REF rows always pass, unknown distances never."""
    passes = (F.col("counts") >= least_reads) & (F.col("control_alt") <= most_control) & F.coalesce(F.col("distance") <= distance, F.lit(False))
    return alleles.where(passes | (F.col("ref") == "."))


def drop_ambiguous(alleles: DataFrame) -> DataFrame:
    return alleles.where(~F.col("alt").contains("N"))


def control_depth(reads: DataFrame, loci: DataFrame, window: int = 100) -> DataFrame:
    """Distinct fragments of the control per locus, over ``[start - window, end)``; 0 for loci without any."""
    wide = loci.select("locus", "locus_chrom", (F.col("locus_start") - window).alias("_from"), "locus_end")
    met = intervals.indexed_join(alignments.primary_reads(reads).select("qname", "chrom", "pos", "end"), wide, ("chrom", "pos", "end"), ("locus_chrom", "_from", "locus_end"))
    counts = met.groupBy("locus").agg(F.countDistinct("qname").alias("control_reads"))
    return loci.select("locus").join(counts, "locus", "left").select("locus", F.coalesce("control_reads", F.lit(0)).alias("control_reads"))


def locus_report(alleles: DataFrame, loci: DataFrame, depth: DataFrame) -> DataFrame:
    """One row per locus and 16 columns; ``alleles`` (filtered) carry counts, control_alt and distance."""
    indel, bnd = F.col("type") == "INDEL", F.col("type") == "BND"
    text = lambda *cs: F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cs))
    keys = lambda cond, *cs: F.array_join(F.array_sort(F.collect_list(F.when(cond, text(*cs)))), ";")
    sums = alleles.groupBy("locus").agg(
        F.sum("counts").alias("total_reads"), F.sum(F.when(F.col("type") != "REF", F.col("counts")).otherwise(0)).alias("indel_reads"), F.avg("control_alt").cast("bigint").alias("control_indel_reads"),
        F.count_if(indel).alias("indel_count"), keys(indel, "chrom", "pos", "ref", "alt", "counts", "control_alt", "distance").alias("indel_info"),
        F.count_if(bnd).alias("bnd_count"), keys(bnd, "chrom", "pos", "chrom2", "pos2", "strands", "counts", "control_alt", "distance").alias("bnd_info"),
    )
    whole = loci.join(sums, "locus", "left").join(depth, "locus", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    dot = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("."))
    share = lambda a, b: F.when(zero(b) > 0, F.round(zero(a) / zero(b), 4)).otherwise(F.lit(0.0))
    control = F.when(F.col("total_reads").isNull(), F.lit(0)).otherwise(zero("control_reads")).cast("bigint")
    return whole.select(
        F.col("locus_chrom").alias("chrom"), F.col("locus_start").alias("start"), F.col("locus_end").alias("end"), F.col("positions").alias("pam_positions"),
        zero("total_reads").alias("total_reads"), zero("indel_reads").alias("indel_reads"), share("indel_reads", "total_reads").alias("indel_fraction"),
        control.alias("control_reads"), zero("control_indel_reads").alias("control_indel_reads"), share("control_indel_reads", "control_reads").alias("control_indel_fraction"),
        zero("indel_count").alias("indel_count"), dot("indel_info").alias("indel_info"), zero("bnd_count").alias("bnd_count"), dot("bnd_info").alias("bnd_info"), "target_info", "is_target",
    )


def reverse_complement_sites(sites: DataFrame) -> DataFrame:
    return sites.select("site_id", "dna", dna.reverse_complement(F.col("dna")).alias("revcomp"))
