"""Interval joins, clustering, merging and tiling on 0-based half-open intervals.

An overlap join is an equi join on (chromosome, bin): both sides list the bins they touch, and a pair is
kept in the first bin that both touch, so it comes out once. Hot bins are ordinary skewed join keys,
which adaptive execution splits. A list of intervals that is measured to be small becomes an index that every
executor holds, and the other side, the reads, does not move (``indexed_join``). Clustering finds islands inside coarse bins first and stitches the
islands, so the per-chromosome window sees islands rather than rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.session import cut, in_memory_bytes
from locuslens.sources.reference_store import unpacked


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.sequence(F.floor(start / width), F.greatest(F.floor(start / width), F.floor((end - 1) / width)))


def overlap_join(left: DataFrame, right: DataFrame, left_on: tuple[str, str, str], right_on: tuple[str, str, str], width: int = 4096) -> DataFrame:
    """All pairs whose intervals share a base; column names of both sides must differ."""
    (lc, ls, le), (rc, rs, re_) = left_on, right_on
    a = left.select("*", F.explode(_bins(F.col(ls), F.col(le), width)).alias("_bin"))
    b = right.select("*", F.explode(_bins(F.col(rs), F.col(re_), width)).alias("_bin2"))
    return a.join(b, _meets(left_on, right_on, width)).drop("_bin", "_bin2")


#: Memory that an index of intervals may take on every executor.
INDEX_BYTES = 32 << 20


def indexed_join(rows: DataFrame, intervals: DataFrame, rows_on: tuple[str, str, str], intervals_on: tuple[str, str, str], width: int = 4096, most_bytes: int = INDEX_BYTES) -> DataFrame:
    """``overlap_join`` of many ``rows`` with a list of ``intervals`` that may be small.

    The list is written with its bins, every interval once per bin it touches, and measured as it would lie in
    memory: up to ``most_bytes`` it is sent to all executors and looked up by (chromosome, bin), so that rows are joined where
    they are; a longer one is joined by a shuffle of both sides. The pairs are the same.
    """
    (lc, ls, le), (rc, rs, re_) = rows_on, intervals_on
    index = cut(intervals.select("*", F.explode(_bins(F.col(rs), F.col(re_), width)).alias("_bin2")), "interval-index")
    small = in_memory_bytes(index) <= most_bytes
    a = rows.select("*", F.explode(_bins(F.col(ls), F.col(le), width)).alias("_bin"))
    return a.join(F.broadcast(index) if small else index.hint("merge"), _meets(rows_on, intervals_on, width)).drop("_bin", "_bin2")


def _meets(left_on: tuple[str, str, str], right_on: tuple[str, str, str], width: int) -> Column:
    (lc, ls, le), (rc, rs, re_) = left_on, right_on
    first = F.greatest(F.floor(F.col(ls) / width), F.floor(F.col(rs) / width))
    return (F.col(lc) == F.col(rc)) & (F.col("_bin") == F.col("_bin2")) & (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)) & (F.col("_bin") == first)


def cluster(df: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end", slack: int = 0, out: str = "cluster", width: int = 1 << 20) -> DataFrame:
    """``df`` with a number per chromosome: intervals at most ``slack`` apart share one (1, 2, ... by start)."""
    by_bin = W.partitionBy(chrom, "_bin").orderBy(start, end)
    rows = df.withColumn("_bin", F.floor(F.col(start) / width))
    reach = F.max(end).over(by_bin.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when(F.col(start) <= reach + slack, 0).otherwise(1)).withColumn("_isle", F.sum("_new").over(by_bin.rowsBetween(W.unboundedPreceding, 0))).drop("_new")
    isles = rows.groupBy(chrom, "_bin", "_isle").agg(F.min(start).alias("_a"), F.max(end).alias("_b"))
    whole = W.partitionBy(chrom).orderBy("_a", "_b")
    ahead = F.max("_b").over(whole.rowsBetween(W.unboundedPreceding, -1))
    isles = isles.withColumn("_new", F.when(F.col("_a") <= ahead + slack, 0).otherwise(1))
    isles = isles.select(chrom, "_bin", "_isle", F.sum("_new").over(whole.rowsBetween(W.unboundedPreceding, 0)).cast("bigint").alias(out))
    return rows.join(isles, [chrom, "_bin", "_isle"]).select(*df.columns, out)


def merge(df: DataFrame, chrom: str = "chrom", start: str = "start", end: str = "end", slack: int = 0) -> DataFrame:
    """Union of intervals at most ``slack`` apart."""
    return cluster(df, chrom, start, end, slack, "_c").groupBy(chrom, "_c").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_c")


def tile(end: Column, size: int) -> Column:
    """Start of the fixed tile of a signal interval: it belongs to a tile while its end does not pass it."""
    return (F.floor((end - 1) / size) * size).cast("bigint")


#: Bases of a reference tile, and rows without a slice are dealt over so many join keys.
TILE, SPREAD = 4096, 4096


def reference_tiles(chunks: DataFrame, chunk: int = 32) -> DataFrame:
    """``(chrom, tile, bases)``: the bases from position ``tile * TILE`` on, up to the last known one of the tile,
    as bytes, which are cut without a walk over the characters before.

    ``chunks`` are ``(chrom, chunk, bases)`` pieces of ``chunk`` bases; lacking ones read ``N``.
    """
    tile = F.floor(F.col("chunk") * chunk / TILE).alias("tile")
    held = chunks.groupBy("chrom", tile).agg(F.array_sort(F.collect_list(F.struct("chunk", "bases"))).alias("parts"))
    padded = F.transform("parts", lambda x, i: F.concat(F.repeat(F.lit("N"), ((x.chunk - F.when(i == 0, F.col("tile") * (TILE // chunk) - 1).otherwise(F.get("parts.chunk", i - 1)) - 1) * chunk).cast("int")), x.bases))
    return held.select("chrom", "tile", F.array_join(padded, "").cast("binary").alias("bases"))


#: Memory that a whole reference may take on every executor; its index has a piece every ``STEP`` bases that goes on for ``REACH`` more.
REFERENCE_BYTES, STEP, REACH = 128 << 20, 512, 256


def sequence_index(tiles: DataFrame, most_bytes: int = REFERENCE_BYTES) -> DataFrame | None:
    """``(_chrom, _piece, _bases)``: overlapping pieces of unpacked ``tiles``, written; None where they are measured to take more than ``most_bytes``.

    A slice of at most ``REACH`` bases lies whole in the piece of its first base. Pieces are short, as a row of the join copies its piece.
    """
    if "bases" not in tiles.columns or 2 * in_memory_bytes(tiles) > most_bytes:
        return None
    per = TILE // STEP
    cut_at = lambda i: F.substring("bases", (i * STEP + 1).cast("int"), F.lit(STEP))
    # tiles lie in as many files as the table has buckets: few tasks read them, as each writes a block for every other one
    held = tiles.coalesce(tiles.sparkSession.sparkContext.defaultParallelism)
    own = held.select(F.col("chrom").alias("_chrom"), F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(per - 1)), cut_at)).alias("_i", "_own"), "tile")
    own = own.where(F.length("_own") > 0).select("_chrom", (F.col("tile") * per + F.col("_i")).alias("_piece"), "_own")
    after = own.select("_chrom", (F.col("_piece") - 1).alias("_piece"), F.substring("_own", F.lit(1), F.lit(REACH)).alias("_more"))
    # a piece that ends early has nothing behind it
    whole = F.when((F.length("_own") == STEP) & F.col("_more").isNotNull(), F.concat("_own", "_more")).otherwise(F.col("_own"))
    index = cut(own.join(after, ["_chrom", "_piece"], "left").select("_chrom", "_piece", whole.alias("_bases")), "reference-index")
    return index if in_memory_bytes(index) <= most_bytes else None


def look_up_sequence(df: DataFrame, index: DataFrame, chrom: str, start: str, end: str, out: str) -> DataFrame:
    """``fetch_sequence`` of slices of at most ``REACH`` bases from a ``sequence_index``, in place: no row is moved. Longer slices are null."""
    a, size = F.col(start), (F.col(end) - F.col(start)).cast("int")
    own = df.withColumn("_at", F.when((a >= 0) & size.between(1, REACH), F.floor(a / STEP)))
    met = own.join(F.broadcast(index), (F.col(chrom) == F.col("_chrom")) & (F.col("_at") == F.col("_piece")), "left")
    text = F.substring("_bases", (F.pmod(a, F.lit(STEP)) + 1).cast("int"), size).cast("string")
    return met.withColumn(out, text).withColumn(out, F.when(F.length(out) == size, F.col(out))).drop("_at", "_chrom", "_piece", "_bases")


def fetch_sequence(df: DataFrame, tiles: DataFrame, chrom: str, start: str, end: str, out: str) -> DataFrame:
    """``df`` with ``out``: reference bases of ``[start, end)``, 0-based; null for null, empty, negative or uncovered slices.

    Distinct slices are cut at tile borders, looked up by one equi join and put together again, so a slice
    may be of any length; rows then meet their slice by its place. Rows without a slice are dealt over many
    join keys, so that none holds them all. ``tiles`` hold ``bases`` or are a stored reference, which does not move.
    """
    valid = (F.col(start) >= 0) & (F.col(end) > F.col(start))
    asked = df.where(valid).select(F.col(chrom).alias("_c"), F.col(start).alias("_s"), F.col(end).alias("_e")).distinct()
    parts = asked.select("*", F.explode(F.sequence(F.floor(F.col("_s") / TILE), F.floor((F.col("_e") - 1) / TILE))).alias("_t"))
    stored = "packed" in tiles.columns
    known = tiles.select(F.col("chrom").alias("_kc"), F.col("tile").alias("_kt"), *(("size", "packed", "lower", "other") if stored else ("bases",)))
    known = known.hint("merge") if stored else known
    met = parts.join(known, (F.col("_c") == F.col("_kc")) & (F.col("_t") == F.col("_kt")))
    a = F.greatest(F.col("_s") - F.col("_t") * TILE, F.lit(0))
    size = F.least(F.col("_e") - F.col("_t") * TILE, F.lit(TILE)) - a
    piece = unpacked(a, size) if stored else F.substring("bases", (a + 1).cast("int"), size.cast("int")).cast("string")
    pieces = met.select("_c", "_s", "_e", "_t", piece.alias("_p"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_t", "_p"))), lambda x: x._p), "")
    slices = pieces.groupBy("_c", "_s", "_e").agg(text.alias(out)).where(F.length(out) == F.col("_e") - F.col("_s"))
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.simpleString() in ("string", "bigint", "int")]
    own = df.withColumn("_at", F.when(valid, F.col(start)).otherwise(-1 - F.pmod(F.xxhash64(*plain), F.lit(SPREAD))))
    return own.join(slices, (F.col(chrom) == F.col("_c")) & (F.col("_at") == F.col("_s")) & (F.col(end) == F.col("_e")), "left").drop("_at", "_c", "_s", "_e")
