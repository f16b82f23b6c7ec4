"""Overlap annotation of intervals with genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.operators import intervals


def annotate(rows: DataFrame, genes: DataFrame, key: str) -> DataFrame:
    """One row per (row, overlapping gene), one of them picked per row: the narrowest gene, then by symbol."""
    met = intervals.overlap_join(rows.select(key, "chrom", "start", "end"), genes, ("chrom", "start", "end"), ("gene_chrom", "gene_start", "gene_end"), width=1 << 16)
    order = W.partitionBy(key).orderBy(F.col("gene_end") - F.col("gene_start"), "symbol")
    return met.select(key, "symbol", (F.row_number().over(order) == 1).alias("picked"))
