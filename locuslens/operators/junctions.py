"""Transgene junctions from discordant pairs and from split reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslens.functions import dna
from locuslens.operators import alignments

COLUMNS = ["qname", "ordinal", "Chromosome", "Start", "End", "Var", "Strand", "Info", "evidence"]


def _info(mate: Column) -> Column:
    return F.concat(F.lit("ID="), F.col("qname"), F.lit(";Type=PR;Read1Seq="), F.col("seq"), F.lit(";Read2Seq="), mate)


def apart(reads: DataFrame) -> DataFrame:
    """Reads whose mate is mapped to another contig, not as a proper pair."""
    return reads.where(~dna.has_flag(dna.PROPER | dna.MATE_UNMAPPED) & (F.col("chrom") != F.col("mate_chrom")))


def discordant(reads: DataFrame, read_length: int = 151) -> DataFrame:
    """Reads with mates on another contig: the junction lies at the mate's end that faces the read.

    ``reads`` carry ``mate_seq`` (``alignments.join_mates``)."""
    forward = ~dna.has_flag(dna.MATE_REVERSE)
    at = (F.col("mate_pos") + F.when(forward, read_length).otherwise(0)).cast("bigint")
    strand = F.when(forward, "+").otherwise("-")
    return apart(reads).select("qname", "ordinal", F.col("mate_chrom").alias("Chromosome"), (at - 1).alias("Start"), at.alias("End"), F.lit("INS").alias("Var"), strand.alias("Strand"), _info(F.col("mate_seq")).alias("Info"), F.lit("PR").alias("evidence"))


def clipped(reads: DataFrame, least_clip: int = 20, least_mapq: int = 1, most_mismatches: int = 1, most_shared: float = 0.2) -> DataFrame:
    """Properly paired reads whose outer clip aligns on another contig, one row for each such supplementary entry ``s``."""
    c = F.col("cigar")
    outer = F.when(dna.has_flag(dna.REVERSE), dna.right_clip(c)).otherwise(dna.left_clip(c))
    own = reads.where(F.col("sa").isNotNull() & dna.has_flag(dna.PROPER) & (outer >= least_clip)).select("*", F.explode(dna.supplementary(F.col("sa"))).alias("s"))
    own = own.where((F.col("s")["chrom"] != F.col("chrom")) & (F.col("s")["mq"] >= least_mapq) & (F.col("s")["nm"] <= most_mismatches))
    own = own.withColumns({"x": dna.aligned_ranges(c), "y": dna.aligned_ranges(F.col("s")["cigar"])})
    own = own.withColumns({"n_x": dna.range_total(F.col("x")), "n_y": dna.range_total(F.col("y")), "n_both": dna.range_overlap(F.col("x"), F.col("y"))})
    return own.where((F.col("n_x") > 0) & (F.col("n_both") < most_shared * F.col("n_x"))).drop("x", "y")


def split(reads: DataFrame) -> DataFrame:
    """Junctions of ``clipped`` reads that carry ``mate_seq``; the mate's bases are told only if it lies on another contig."""
    at = F.col("s")["pos"] + F.when(F.col("s")["strand"] == "+", F.col("n_y")).otherwise(0)
    mate = F.when(F.col("chrom") == F.col("mate_chrom"), ".").otherwise(F.col("mate_seq"))
    return reads.select("qname", "ordinal", F.col("s")["chrom"].alias("Chromosome"), (at - 1).alias("Start"), at.alias("End"), F.lit("INS").alias("Var"), F.col("s")["strand"].alias("Strand"), _info(mate).alias("Info"), F.lit("SR").alias("evidence"))


def junctions(reads: DataFrame, exclude: tuple[int, int] | None = (3130, 5930), contig: str | None = None) -> DataFrame:
    """All junctions of ``reads`` (of one ``contig`` if given), sorted by place: discordant pairs and split reads.

    Candidates are chosen first; only their mates' sequences are looked up, among all reads.
    """
    own = usable(reads if contig is None else reads.where(F.col("chrom") == contig), exclude)
    pairs = discordant(alignments.join_mates(apart(own), reads))
    parts = split(alignments.join_mates(clipped(own), reads))
    return pairs.unionByName(parts).orderBy("Chromosome", "Start", "qname", "ordinal", "Info")


def usable(reads: DataFrame, exclude: tuple[int, int] | None = (3130, 5930)) -> DataFrame:
    """Primary, unduplicated reads with a mapping quality outside the excluded interval."""
    own = reads.where(~dna.has_flag(dna.SECONDARY | dna.DUPLICATE | dna.SUPPLEMENTARY) & (F.col("mapq") > 0))
    return alignments.exclude_interval(own, *exclude) if exclude else own
