"""Allele-fraction modes and mean coverage per fixed window."""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.operators import intervals

WINDOW, LEAST, GRID, APART = 500_000, 21, 1000, 10
MOMENTS, REACH = 16, 10.0


def tiles(vaf: DataFrame, size: int = WINDOW) -> DataFrame:
    return vaf.select("chrom", intervals.tile(F.col("end"), size).alias("tile"), "score", "ordinal")


def tile_stats(vaf: DataFrame, size: int = WINDOW) -> DataFrame:
    """Count, mean and standard deviation of the scores of each tile."""
    return tiles(vaf, size).groupBy("chrom", "tile").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("sd"))


def kernel_cells(vaf: DataFrame, size: int = WINDOW) -> DataFrame:
    """Weighted moments of the scores in cells of half a bandwidth: ``chrom, tile, h, centre, m0 .. m15``.

    With ``z = (score - centre) / h``, moment k is the sum of ``exp(-z * z / 2) * z ** k / k!``.
    """
    values = tiles(vaf, size).where("score is not null").groupBy("chrom", "tile", "score").agg(F.count("*").alias("times"))
    stats = tile_stats(vaf, size).where((F.col("n") >= LEAST) & (F.col("sd") > 0))
    stats = stats.select("chrom", "tile", (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("h"))
    placed = values.join(stats, ["chrom", "tile"]).withColumn("centre", F.round(F.col("score") / F.col("h") * 2) * F.col("h") / 2)
    scaled = placed.withColumn("z", (F.col("score") - F.col("centre")) / F.col("h")).withColumn("w", F.col("times") * F.exp(F.col("z") * F.col("z") * -0.5))
    return scaled.groupBy("chrom", "tile", "h", "centre").agg(*((F.sum(F.col("w") * F.pow("z", F.lit(float(k)))) / math.factorial(k)).alias(f"m{k}") for k in range(MOMENTS)))


def densities(vaf: DataFrame, size: int = WINDOW, grid: int = GRID) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth h) of each tile on ``grid`` points over [0, 1], not normalised.

    A fast Gauss transform: scores are summed into the moments of cells of width h / 2, and a grid point at
    ``u = (point - centre) / h`` gets ``exp(-u * u / 2) * sum(m_k * u ** k)`` from each cell with ``|u| <= REACH``.
    The series errs by at most 4.5e-17 a score and the cut by 2.3e-21, less than the rounding of a plain sum of
    doubles, so comparisons of neighbours are those of the plain sum. A distinct score costs ``MOMENTS`` products;
    a tile then takes about 45,000 terms at most, whatever its number of scores. Tiles with too few or constant
    values have none, nor do grid points beyond the reach of every cell (density 0). Rows: chrom, tile, g, density.
    """
    step, reach = grid - 1, F.lit(REACH) * F.col("h")
    near = F.greatest(F.lit(0.0), F.ceil((F.col("centre") - reach) * step).cast("double"))
    far = F.least(F.lit(float(step)), F.floor((F.col("centre") + reach) * step).cast("double"))
    cells = kernel_cells(vaf, size).withColumn("near", near).withColumn("far", far).where("near <= far")
    met = cells.withColumn("g", F.explode(F.sequence(F.col("near").cast("int"), F.col("far").cast("int"))))
    met = met.withColumn("u", (F.col("g") / step - F.col("centre")) / F.col("h"))
    series = functools.reduce(lambda total, k: total * F.col("u") + F.col(f"m{k}"), range(MOMENTS - 2, -1, -1), F.col(f"m{MOMENTS - 1}"))
    return met.groupBy("chrom", "tile", "g").agg(F.sum(F.exp(F.col("u") * F.col("u") * -0.5) * series).alias("density"))


def raw_modes(density: DataFrame, grid: int = GRID) -> DataFrame:
    """Grid indices whose density is above both neighbours, both ends excluded; points without a row have density 0."""
    by = W.partitionBy("chrom", "tile").orderBy("g")
    flat = F.round("density", 9)
    beside = lambda shift, there: F.when(shift("g").over(by) == there, shift(flat).over(by)).otherwise(0.0)
    near = density.select("chrom", "tile", "g", flat.alias("d"), beside(F.lag, F.col("g") - 1).alias("a"), beside(F.lead, F.col("g") + 1).alias("b"))
    inner = near.where(F.col("g").between(1, grid - 2) & (F.col("d") > F.col("a")) & (F.col("d") > F.col("b")))
    return inner.select("chrom", "tile", F.col("g").cast("bigint").alias("g"), "d")


def modes(density: DataFrame, apart: int = APART, grid: int = GRID) -> DataFrame:
    """Modes at least ``apart`` grid points from any higher one, as text per tile: at most ``grid`` / 2 of a tile meet."""
    ranked = raw_modes(density, grid).groupBy("chrom", "tile").agg(F.array_sort(F.collect_list(F.struct((-F.col("d")).alias("d"), "g"))).alias("m"))
    near = lambda kept, x: F.exists(kept, lambda k: F.abs(k - x.g) < apart)
    kept = F.aggregate("m", F.array().cast("array<bigint>"), lambda kept, x: F.when(near(kept, x), kept).otherwise(F.concat(kept, F.array(x.g))))
    text = F.transform(F.sort_array(kept), lambda k: F.round(k / (grid - 1), 4).cast("string"))
    return ranked.select("chrom", "tile", F.array_join(text, ",").alias("modes"))


def window_coverage(windows: DataFrame, coverage: DataFrame, size: int = WINDOW) -> DataFrame:
    """Mean coverage of each window ``(chrom, tile, ...)`` that overlaps any interval, with its first ``modes``."""
    wide = windows.withColumnRenamed("chrom", "w_chrom").withColumn("w_end", F.col("tile") + size)
    met = intervals.overlap_join(coverage, wide, ("chrom", "start", "end"), ("w_chrom", "tile", "w_end"), width=size)
    return met.groupBy("chrom", "tile").agg(F.max("modes").alias("modes"), F.avg("coverage").alias("coverage"), F.count("*").alias("n_intervals"))


def cnv_track(vaf: DataFrame, coverage: DataFrame, size: int = WINDOW) -> DataFrame:
    """index, Chromosome, Start, End, VAF (modes, null for tiles without), NormalizedCoverage per window; ``index`` counts them by place."""
    found = modes(densities(vaf, size))
    windows = tiles(vaf, size).select("chrom", "tile").distinct().join(found, ["chrom", "tile"], "left")
    track = window_coverage(windows, coverage, size)
    # windows are numbered inside a chromosome, and chromosomes by their counts
    inside = F.row_number().over(W.partitionBy("chrom").orderBy("tile"))
    counts = track.groupBy("chrom").agg(F.count("*").alias("n"))
    before = counts.select("chrom", F.coalesce(F.sum("n").over(W.orderBy("chrom").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = track.withColumn("inside", inside).join(before, "chrom")
    return placed.select((F.col("before") + F.col("inside") - 1).alias("index"), F.col("chrom").alias("Chromosome"), F.col("tile").alias("Start"), (F.col("tile") + size).alias("End"), F.col("modes").alias("VAF"), F.col("coverage").alias("NormalizedCoverage"))
