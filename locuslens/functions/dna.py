"""Column expressions over bases, CIGAR strings, flags and supplementary-alignment tags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements, upper and lower case (fixed values).
CODES, COMPLEMENTS = "ACGTRYMKVBHDacgtrymkvbhd", "TGCAYRKMBVDHtgcayrkmbvdh"
REFERENCE_OPS, QUERY_OPS, CLIP_OPS = "MDN", "MI", "SHP=X"
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x1, 0x2, 0x4, 0x8, 0x10, 0x20, 0x40, 0x80, 0x100, 0x400, 0x800


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside a lambda (a projected column would be inlined there)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def has_flag(bits: int, flag: str = "flag") -> Column:
    """Any of ``bits`` is set."""
    return F.col(flag).bitwiseAND(F.lit(bits)) != 0


def reverse_complement(bases: Column) -> Column:
    return F.reverse(F.translate(bases, CODES, COMPLEMENTS))


def op_total(cigar: Column, ops: str) -> Column:
    """Total length of the given operations; 0 for none, null for a null CIGAR."""
    found = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{ops}]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def first_length(cigar: Column, pattern: str) -> Column:
    """Length captured by ``pattern``, 0 where it does not match."""
    return F.coalesce(F.nullif(F.regexp_extract(cigar, pattern, 1), F.lit("")).cast("bigint"), F.lit(0).cast("bigint"))


def left_clip(cigar: Column, ops: str = "S") -> Column:
    return first_length(cigar, f"^([0-9]+)[{ops}]")


def right_clip(cigar: Column, ops: str = "S") -> Column:
    return first_length(cigar, f"([0-9]+)[{ops}]$")


def op_count(cigar: Column) -> Column:
    """Number of operations."""
    return F.length(F.regexp_replace(cigar, "[0-9]", "")).cast("bigint")


def aligned_ranges(cigar: Column) -> Column:
    """0-based half-open stretches of the query axis that are aligned; clips, deletions and skips advance it."""
    ops = F.transform(F.regexp_extract_all(cigar, F.lit("[0-9]+[MIDNSHP=X]"), F.lit(0)), lambda o: F.struct(F.right(o, F.lit(1)).alias("op"), F.regexp_replace(o, "[^0-9]", "").cast("bigint").alias("n")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("out"))

    def step(acc: Column, o: Column) -> Column:
        to = acc.at + F.when(o.op == "I", F.lit(0)).otherwise(o.n)
        out = F.when(o.op == "M", F.concat(acc.out, F.array(F.struct(acc.at.alias("a"), to.alias("b"))))).otherwise(acc.out)
        return F.struct(to.cast("bigint").alias("at"), out.alias("out"))

    return F.aggregate(ops, start, step, lambda acc: acc.out)


def range_total(ranges: Column) -> Column:
    return F.aggregate(ranges, F.lit(0).cast("bigint"), lambda t, r: t + r.b - r.a)


def range_overlap(x: Column, y: Column) -> Column:
    """Number of positions in both lists of disjoint ranges."""
    one = lambda a: F.aggregate(y, F.lit(0).cast("bigint"), lambda t, b: t + F.greatest(F.lit(0), F.least(a.b, b.b) - F.greatest(a.a, b.a)))
    return F.aggregate(x, F.lit(0).cast("bigint"), lambda t, a: t + one(a))


def supplementary(tag: Column) -> Column:
    """Entries of an SA tag as structs; empty for null."""
    parts = F.filter(F.split(F.coalesce(tag, F.lit("")), ";"), lambda s: s != "")
    field = lambda s, i: F.split(s, ",").getItem(i)
    return F.transform(parts, lambda s: F.struct(field(s, 0).alias("chrom"), field(s, 1).cast("bigint").alias("pos"), field(s, 2).alias("strand"), field(s, 3).alias("cigar"), field(s, 4).cast("bigint").alias("mq"), field(s, 5).cast("bigint").alias("nm")))


def first_supplementary(tag: Column) -> Column:
    """The text of the first entry of an SA tag; null for none."""
    first = F.substring_index(F.ltrim(tag, F.lit(";")), ";", 1)
    return F.when(first != "", first)


def supplementary_fields(parts: Column) -> Column:
    """The struct of an SA entry that was split at its commas."""
    fields = {"chrom": "string", "pos": "bigint", "strand": "string", "cigar": "string", "mq": "bigint", "nm": "bigint"}
    return F.when(parts.isNotNull(), F.struct(*(parts.getItem(i).cast(t).alias(c) for i, (c, t) in enumerate(fields.items()))))
