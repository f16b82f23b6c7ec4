"""A stored reference: tiles with two bits a base, bucketed by place, so that lookups never move it.

A, C, G and T take two bits; stretches of lower case and of other codes are lists of runs beside them, so every
base comes back as it was. The table is bucketed and sorted by (chromosome, tile): a lookup shuffles the
asked slices to the buckets and reads the tiles where they lie.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslens.functions.dna import let
from locuslens.session import TABLES, scratch_dir

#: Bases in one packed word of 32 bits.
WORD = 16


def runs(text: Column, pattern: str) -> Column:
    """``at, n, code`` of every match of ``pattern``: 0-based start, length, first character."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,n:int,code:string>>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        at, n = acc.at + pair.gap, F.length(pair.run)
        run = F.struct(at.alias("at"), n.alias("n"), F.substring(pair.run, 1, 1).alias("code"))
        return F.struct((at + n).alias("at"), F.concat(acc.out, F.array(run)).alias("out"))

    pairs = F.zip_with(F.slice(between, F.lit(1), F.size(found)), found, lambda gap, run: F.struct(gap.alias("gap"), run.alias("run")))
    return F.aggregate(pairs, start, step, lambda acc: acc.out)


def packed_tiles(tiles: DataFrame) -> DataFrame:
    """``chrom, tile, size, packed, lower, other`` of tiles ``(chrom, tile, bases)``."""
    text = tiles.select("chrom", "tile", F.col("bases").cast("string").alias("text")).withColumn("upper", F.upper("text"))
    plain = F.translate(F.regexp_replace("upper", "[^ACGT]", "A"), "ACGT", "0123")
    words = F.greatest(F.ceil(F.length("text") / WORD), F.lit(1)).cast("int")
    word = lambda digits, i: F.lpad(F.conv(F.substring(digits, i * WORD + 1, F.lit(WORD)), 4, 16), 8, "0")
    packed = F.unhex(let(F.rpad(plain, words * WORD, F.lit("0")), lambda digits: F.array_join(F.transform(F.sequence(F.lit(0), words - 1), lambda i: word(digits, i)), "")))
    return text.select("chrom", "tile", F.length("text").alias("size"), packed.alias("packed"), runs(F.col("text"), "[a-z]+").alias("lower"), runs(F.col("upper"), r"([^ACGT])\1*").alias("other"))


def unpacked(a: Column, size: Column) -> Column:
    """Bases ``[a, a + size)`` of a packed tile, up to its end."""
    n = F.greatest(F.lit(0), F.least(a + size, F.col("size")) - a).cast("int")
    first = F.floor(a / WORD).cast("int")
    count = F.floor((a + F.greatest(n, F.lit(1)) - 1) / WORD).cast("int") - first + 1
    word = lambda digits, i: F.lpad(F.conv(F.substring(digits, i * 8 + 1, F.lit(8)), 16, 4), WORD, "0")
    digits = let(F.hex(F.substring(F.col("packed"), first * 4 + 1, count * 4)), lambda digits: F.array_join(F.transform(F.sequence(F.lit(0), count - 1), lambda i: word(digits, i)), ""))
    text = F.translate(F.substring(digits, (a - first * WORD + 1).cast("int"), n), "0123", "ACGT")
    inside = lambda c: F.filter(c, lambda r: (r.at < a + n) & (r.at + r.n > a))
    place = lambda r: (F.greatest(r.at - a, F.lit(0)) + 1).cast("int")
    long = lambda r: (F.least(r.at + r.n, a + n) - F.greatest(r.at, a)).cast("int")
    text = F.aggregate(inside("other"), text, lambda s, r: F.overlay(s, F.repeat(r.code, long(r)), place(r), long(r)))
    text = F.aggregate(inside("lower"), text, lambda s, r: F.overlay(s, F.lower(F.substring(s, place(r), long(r))), place(r), long(r)))
    return F.when(n > 0, text).otherwise(F.lit(""))


def store_reference(tiles: DataFrame, buckets: int | None = None, path: str | None = None, name: str | None = None, pack: bool = True) -> DataFrame:
    """Write tiles ``(chrom, tile, bases)`` as a bucketed table and give it back; without ``pack`` a base takes a byte,
    which is four times as much to read and less to compute."""
    spark = tiles.sparkSession
    name = name or f"reference_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (packed_tiles(tiles) if pack else tiles).repartition(buckets, "chrom", "tile").write.bucketBy(buckets, "chrom", "tile").sortBy("chrom", "tile").option("path", path or scratch_dir(spark, "reference")).saveAsTable(name)
    TABLES.append(name)
    return spark.table(name)
