"""Filters and derived columns of alignments ``(sample, qname, flag, chrom, pos, end, mapq, cigar, ...)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.functions import dna


def primary_reads(reads: DataFrame) -> DataFrame:
    """Mapped primary alignments that are no duplicates and have a mapping quality."""
    return reads.where(~dna.has_flag(dna.UNMAPPED | dna.SECONDARY | dna.DUPLICATE | dna.SUPPLEMENTARY) & (F.col("mapq") > 0))


def mismatch_budget(reads: DataFrame, most: int = 5) -> DataFrame:
    """At most ``most`` mismatches, deleted and skipped bases not counted; unknown counts pass."""
    gaps = dna.op_total(F.col("cigar"), "DN")
    return reads.where(F.col("nm").isNull() | (F.col("nm") <= most) | (F.col("nm") - gaps <= most))


def exclude_interval(reads: DataFrame, first: int = 3130, last: int = 5930) -> DataFrame:
    """Reads that do not start inside ``[first, last]``, both ends inclusive."""
    return reads.where(~F.col("pos").between(first, last))


def locus_reach(pairs: DataFrame, distance: int = 25) -> DataFrame:
    """Read-locus pairs where the read with its clips comes within ``distance`` of the locus (1-based read start)."""
    left, right = dna.left_clip(F.col("cigar")), dna.right_clip(F.col("cigar"))
    return pairs.where((F.col("pos") + 1 - left < F.col("locus_end") + distance) & (F.col("end") + right > F.col("locus_start") - distance))


def cigar_profile(reads: DataFrame) -> DataFrame:
    """Per read the number of operations, totals per operation, spans and clips."""
    c = F.col("cigar")
    totals = [dna.op_total(c, op).alias(f"n_{op.lower()}") for op in "MIDNS"]
    return reads.select("qname", "ordinal", "cigar", dna.op_count(c).alias("n_ops"), *totals, dna.op_total(c, "MDN").alias("ref_span"), dna.op_total(c, "MIS").alias("query_span"), dna.left_clip(c).alias("left_clip"), dna.right_clip(c).alias("right_clip"))


def explode_supplementary(reads: DataFrame) -> DataFrame:
    """One row per entry of the SA tag."""
    return reads.select("qname", "ordinal", F.posexplode(dna.supplementary(F.col("sa"))).alias("n", "s")).select("qname", "ordinal", F.col("n").cast("bigint").alias("n"), *(F.col("s")[f].alias(f) for f in ("chrom", "pos", "strand", "cigar", "mq", "nm")))


def aligned_overlap(reads: DataFrame) -> DataFrame:
    """Per SA entry the query positions aligned by the read, by the entry and by both."""
    entries = reads.select("qname", "ordinal", "cigar", F.posexplode(dna.supplementary(F.col("sa"))).alias("n", "s"))
    spans = entries.select("qname", "ordinal", F.col("n").cast("bigint").alias("n"), dna.aligned_ranges(F.col("cigar")).alias("x"), dna.aligned_ranges(F.col("s")["cigar"]).alias("y"))
    return spans.select("qname", "ordinal", "n", dna.range_total(F.col("x")).alias("aligned"), dna.range_total(F.col("y")).alias("sa_aligned"), dna.range_overlap(F.col("x"), F.col("y")).alias("both"))


def join_mates(reads: DataFrame, mates: DataFrame | None = None) -> DataFrame:
    """Primary reads with the sequence of their mate, ``.`` where it is missing.

    ``mates`` holds all reads, where ``reads`` are a selection: mates of other reads are dropped before
    their sequences are aggregated.
    """
    primary = ~dna.has_flag(dna.SECONDARY | dna.SUPPLEMENTARY)
    own = reads.where(primary).withColumn("_first", ~dna.has_flag(dna.FIRST))
    keys = ["sample", "qname", "_first"]
    others = (reads if mates is None else mates).where(primary).select("sample", "qname", dna.has_flag(dna.FIRST).alias("_first"), "seq", "ordinal")
    if mates is not None:
        others = others.join(own.select(*keys).distinct(), keys, "left_semi")
    found = others.groupBy(*keys).agg(F.min(F.struct("ordinal", "seq"))["seq"].alias("mate_seq"))
    return own.join(found, keys, "left").drop("_first").withColumn("mate_seq", F.coalesce("mate_seq", F.lit(".")))
