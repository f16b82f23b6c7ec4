"""Hotspot positions: windows around sites and given intervals, merged and listed base by base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.operators import intervals
from locuslens.sources.reference_store import unpacked


#: Header lines of the position list (fixed format).
HEADER = ("##fileformat=VCFv4.1", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")


def site_windows(sites: DataFrame, window: int = 200) -> DataFrame:
    """``[start - window, start + window)`` around 1-based site starts, cut off at 0."""
    return sites.select("chrom", F.greatest(F.lit(0), F.col("start") - window).cast("bigint").alias("start"), (F.col("start") + window).cast("bigint").alias("end"))


def positions(windows: DataFrame, reference: DataFrame) -> DataFrame:
    """Every position of the merged windows, both ends included, with its reference base; null where it is not covered.

    Windows are cut at the borders of reference tiles, so a window may be of any length.
    """
    size = intervals.TILE
    last = lambda c: F.greatest(F.lit(0), F.col(c) - 1)
    merged = intervals.merge(windows).select("*", F.explode(F.sequence(F.floor(last("start") / size), F.floor(last("end") / size))).alias("tile"))
    listed = merged.select("chrom", "tile", F.greatest("start", F.when(F.col("tile") > 0, F.col("tile") * size + 1).otherwise(F.lit(0))).alias("a"), F.least("end", (F.col("tile") + 1) * size).alias("b"))
    at, n = F.greatest("a", F.lit(1)) - F.col("tile") * size, F.col("b") - F.col("a") + 1
    slice_ = unpacked(at - 1, n) if "packed" in reference.columns else F.substring("bases", at.cast("int"), n.cast("int"))
    met = listed.join(reference, ["chrom", "tile"], "left").select("chrom", F.greatest("a", F.lit(1)).alias("from"), slice_.alias("bases"), F.explode(F.sequence("a", "b")).alias("pos"))
    base = F.when(F.col("pos") > 0, F.nullif(F.substring("bases", (F.col("pos") - F.col("from") + 1).cast("int"), F.lit(1)).cast("string"), F.lit("")))
    return met.select("chrom", "pos", base.alias("base"), F.lit("N").alias("alt"))


def vcf_lines(found: DataFrame) -> DataFrame:
    """Text lines of a position list in VCF 4.1, header first; sort by ``rank, chrom, pos``."""
    spark = found.sparkSession
    header = spark.createDataFrame([(0, "", i, line) for i, line in enumerate(HEADER)], "rank int, chrom string, pos bigint, value string")
    body = found.select(F.lit(1).alias("rank"), "chrom", "pos", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "base", "alt", F.lit("."), F.lit("."), F.lit(".")).alias("value"))
    return header.unionByName(body)
