"""One variant record per read and locus: insertion, deletion, complex, breakend or unchanged.

All steps are column expressions, for all loci and samples at once; CIGARs are parsed once per distinct string of a batch
(``functions.cigars``). A reference that is measured to be small lies on every executor, and reads take their
bases where they are; only slices longer than a tile are moved. For a larger one, pairs with their parsed fields are written,
and only rows that ask for bases are joined with them. Records without reference bases are written, so that plans stay small. Deletions implied by a clip are true gaps between the two aligned parts, so that the same deletion
gets one allele whether a read was clipped or not. A read whose supplementary alignment is near but of a shape
that cannot be spliced is aligned anew to the reference between both parts; only these few pairs leave the
JVM, distinct by sequence and slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslens.functions import cigars, dna
from locuslens.operators import alignments, intervals, realign
from locuslens.session import cut

KEY = ["sample", "qname", "ordinal", "locus"]


def reads_in_loci(reads: DataFrame, loci: DataFrame, window: int = 100) -> DataFrame:
    """Pairs of reads and loci ``(locus, locus_chrom, locus_start, locus_end)`` within ``window`` bases."""
    wide = loci.select("locus", "locus_chrom", "locus_start", "locus_end", (F.col("locus_start") - window).alias("_from"), (F.col("locus_end") + window).alias("_to"))
    return intervals.indexed_join(reads, wide, ("chrom", "pos", "end"), ("locus_chrom", "_from", "_to")).drop("_from", "_to")


def fetch_asked(rows: DataFrame, reference: DataFrame, asks: str, start: str, end: str, out: str, index: DataFrame | None = None, most: int | None = None, size: str | None = None) -> DataFrame:
    """``fetch_sequence`` for written ``rows``, of which only those that ask are moved to the reference; ``out`` of the others is null.

    Rows that do not ask have no ``start``. With ``index`` the reference comes to the rows, and only longer slices are moved. Where none is over ``most``, rows need not be written.
    ``size`` names a written column with the length of a slice, null for rows that do not ask, so that files without longer slices are not read for them.
    """
    if index is not None:
        if most is not None and most <= intervals.REACH:
            return intervals.look_up_sequence(rows, index, "chrom", start, end, out)
        long = f"{size or f'case when {asks} then {end} - {start} end'} > {intervals.REACH}"
        longer = rows.where(long)
        if longer.isEmpty():
            return intervals.look_up_sequence(rows, index, "chrom", start, end, out)
        near = intervals.look_up_sequence(rows.where(f"not coalesce({long}, false)"), index, "chrom", start, end, out)
        return near.unionByName(intervals.fetch_sequence(longer, reference, "chrom", start, end, out))
    found = intervals.fetch_sequence(rows.where(asks), reference, "chrom", start, end, out)
    return found.unionByName(rows.where(f"not coalesce({asks}, false)").withColumn(out, F.lit(None).cast("string")))


def reanchor_clips(pairs: DataFrame, reference: DataFrame, window: int = 100, least: int = 5, asks: Column | None = None, index: DataFrame | None = None) -> DataFrame:
    """``pairs`` with ``hit``: where the longer clip lies in the adjacent ``window`` of reference, if it does.

    Left clips take the last occurrence that ends before the read, right clips the first after it; ``hit``
    is the 0-based start of the occurrence. Pairs that ``asks`` rules out have none.
    """
    left, right = F.col("left_clip"), F.col("right_clip")
    asked = F.lit(True) if asks is None else F.coalesce(asks, F.lit(False))
    on_left = F.col("_on_left")
    sided = pairs.withColumn("_on_left", F.when(asked & (left > right) & (left >= least), True).when(asked & (right > left) & (right >= least), False))
    sided = sided.withColumns({"_a": F.when(on_left, F.greatest(F.lit(0), F.col("pos") - window)).when(~on_left, F.col("end")), "_b": F.when(on_left, F.col("pos")).when(~on_left, F.col("end") + window)})
    near = fetch_asked(sided, reference, "_on_left is not null", "_a", "_b", "_near", index, window)
    found = near.withColumn("_clip", F.when(F.col("_near").isNotNull(), F.when(on_left, F.substring("seq", F.lit(1), left.cast("int"))).otherwise(F.right("seq", right.cast("int")))))
    # what is behind the last occurrence; the whole text if there is none, which puts it before the text
    behind = F.call_function("substring_index", F.col("_near"), F.col("_clip"), F.lit(-1))
    at = F.when(on_left, F.length("_near") - F.length(behind) - F.length("_clip")).otherwise(F.instr("_near", F.col("_clip")) - 1)
    found = found.withColumn("_at", at)
    return found.withColumn("hit", F.when(F.col("_at") >= 0, F.col("_a") + F.col("_at")).cast("bigint")).drop("_a", "_b", "_near", "_clip", "_on_left", "_at")


def parsed(pairs: DataFrame, max_nm: int = 5, write: bool = True) -> DataFrame:
    """Primary pairs within the mismatch budget with clips, strand, 1-based ends and the first supplementary entry ``s``; written, unless read once."""
    own = alignments.mismatch_budget(alignments.primary_reads(pairs), max_nm)
    own = own.withColumns({"start1": F.col("pos") + 1, "end1": F.col("end"), "strand": F.when(dna.has_flag(dna.REVERSE), "-").otherwise("+"), "_sa": F.split(dna.first_supplementary(F.col("sa")), ",")})
    own = own.withColumn("s", dna.supplementary_fields(F.col("_sa")))
    own = own.withColumns({"_clips": cigars.clips("cigar"), "_part": cigars.part(F.col("s")["cigar"])})
    own = own.withColumns({c: F.col("_clips")[c] for c in ("left_clip", "right_clip")})
    columns = {c: F.col("_part")[c] for c in ("s_span", "s_left", "s_right", "s_query", "s_lead", "s_tail")}
    kept = [*KEY, "chrom", "pos", "end", "cigar", "seq", "locus_start", "locus_end", "left_clip", "right_clip", "start1", "end1", "strand", "s"]
    rows = own.withColumns(columns).select(*kept, *columns)
    return cut(rows, "read-pairs") if write else rows


def near_supplementary(min_sa_mapq: int = 10, max_nm: int = 5, far: int = 100_000) -> dict[str, Column]:
    """``near_left``, ``near_right``: the supplementary entry goes on where the longer clip begins, on the same strand and not too far."""
    left, right, s = F.col("left_clip"), F.col("right_clip"), F.col("s")
    alike = (s["mq"] >= min_sa_mapq) & (s["nm"] < max_nm) & (s["chrom"] == F.col("chrom")) & (s["strand"] == F.col("strand"))
    before = (left > right) & alike & (s["pos"] < F.col("start1")) & (F.col("start1") - s["pos"] < far)
    after = (right > left) & alike & (s["pos"] > F.col("end1")) & (s["pos"] - F.col("end1") < far)
    return {"near_left": F.coalesce(before, F.lit(False)), "near_right": F.coalesce(after & (F.col("s_left") > 0) & (F.col("s_tail") > 0), F.lit(False))}


#: Clips without a usable supplementary alignment may lie in the reference nearby.
ASKS = "(left_clip > right_clip and not near_left) or (right_clip > left_clip and s is null)"


def with_parts(own: DataFrame, min_sa_mapq: int = 10, max_nm: int = 5, far: int = 100_000) -> DataFrame:
    """Parsed pairs with how their supplementary alignment goes on: near on which side, whether it can be spliced, whether the clip asks the reference."""
    own = own.withColumns(near_supplementary(min_sa_mapq, max_nm, far))
    splice_left = F.col("near_left") & (F.col("s_right") > 0) & (F.col("s_lead") == F.col("left_clip"))
    splice_right = F.col("near_right") & (F.col("s_tail") == F.col("right_clip"))
    return own.withColumns({"splice_left": splice_left, "splice_right": splice_right, "asks": F.expr(ASKS)})


#: Near parts that cannot be spliced: the whole read is aligned from the first base of one part to the last of the other.
UNSPLICED = "seq is not null and (near_left and not splice_left or near_right and not splice_right)"


def realign_parts(own: DataFrame, reference: DataFrame) -> DataFrame:
    """Pairs of ``UNSPLICED`` shape with ``realigned``, the read's CIGAR on the slice of both parts; null where the reference lacks it."""
    odd = own.where(UNSPLICED)
    odd = odd.withColumn("_a", F.when(F.col("near_left"), F.col("s")["pos"] - 1).otherwise(F.col("pos")))
    odd = odd.withColumn("_b", F.when(F.col("near_left"), F.col("end")).otherwise(F.col("s")["pos"] - 1 + F.col("s_span")))
    odd = cut(intervals.fetch_sequence(odd, reference, "chrom", "_a", "_b", "slice"), "unspliced-reads")
    # written, as its readers would align the reads again
    found = cut(realign.realigned(odd.where("slice is not null and seq != ''")), "realigned-reads")
    return odd.join(found, ["slice", "seq"], "left").select(*own.columns, "realigned")


def classify(pairs: DataFrame, reference: DataFrame, window: int = 100, distance: int = 25, min_sa_mapq: int = 10, max_nm: int = 5, far: int = 100_000, least_clip: int = 5, realigns: bool = True) -> DataFrame:
    """Variant record of every read-locus pair that passes the filters: the key columns, ``chrom2``, ``pos2``, ``strands``, ``ref``, ``alt``, ``type``.

    Without ``realigns``, reads whose near parts cannot be spliced go by their own alignment.
    """
    c, left, right = F.col("cigar"), F.col("left_clip"), F.col("right_clip")
    index = intervals.sequence_index(reference)
    own = with_parts(parsed(pairs, max_nm, realigns or index is None or window > intervals.REACH), min_sa_mapq, max_nm, far)
    if realigns:
        own = own.where(f"not coalesce({UNSPLICED}, false)").withColumn("realigned", F.lit(None).cast("string")).unionByName(realign_parts(own, reference))
    else:
        own = own.withColumn("realigned", F.lit(None).cast("string"))
    own = reanchor_clips(own, reference, window, least_clip, F.col("asks"), index)
    body = F.regexp_replace(c, "^[0-9]+S", "")
    trunk = F.regexp_replace(c, "[0-9]+S$", "")
    gap = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("D"))).otherwise(F.lit(""))
    m = lambda n: F.concat(n.cast("string"), F.lit("M"))
    joined = (
        F.when(F.col("splice_left"), F.concat(F.regexp_replace(F.col("s")["cigar"], f"[0-9]+[{dna.CLIP_OPS}]$", ""), gap(F.col("pos") - (F.col("s")["pos"] - 1 + F.col("s_span"))), body))
        .when(F.col("splice_right"), F.concat(trunk, gap(F.col("s")["pos"] - 1 - F.col("end")), F.regexp_replace(F.col("s")["cigar"], f"^[0-9]+[{dna.CLIP_OPS}]", "")))
        .when(F.col("realigned").isNotNull(), F.col("realigned"))
        .when(F.col("hit").isNotNull() & (left > right), F.concat(m(left), gap(F.col("pos") - F.col("hit") - left), body))
        .when(F.col("hit").isNotNull(), F.concat(trunk, gap(F.col("hit") - F.col("end")), m(right)))
        .otherwise(c)
    )
    start = F.when(F.col("near_left"), F.col("s")["pos"]).when(F.col("hit").isNotNull() & (left > right), F.col("hit") + 1).otherwise(F.col("start1"))
    own = own.withColumns({"joined": joined, "start1": start}).withColumn("_event", cigars.event("joined"))
    own = own.withColumns({c: F.col("_event")[c] for c in ("span", "q_from", "p_query", "lead", "is_event", "kind", "e_all", "e_query_total")})
    end = F.when((right > left) & (F.col("s").isNotNull() | F.col("hit").isNotNull()), F.col("start1") + F.col("span")).otherwise(F.col("end1"))
    own = own.withColumn("end1", end)
    # a column, not a filter, which would be pushed below and compute the start again
    reaches = (F.col("start1") - left < F.col("locus_end") + distance) & (F.col("end1") + right > F.col("locus_start") - distance)
    own = own.withColumns({"e_pos": F.col("start1") + F.col("lead"), "e_query": F.col("q_from") + F.col("lead")})
    # breakends: trim the overlap of the two parts, then test distance and order
    trim = F.greatest(F.lit(0), F.col("p_query") + F.col("s_query") - F.length("seq"))
    s_pos = F.when(F.col("s_left") > F.col("s_right"), F.col("s")["pos"] + trim).otherwise(F.col("s")["pos"])
    s_end = F.when(F.col("s_right") > F.col("s_left"), F.col("s")["pos"] + F.col("s_span") - 1 - trim).otherwise(F.col("s")["pos"] + F.col("s_span") - 1)
    own = own.withColumns({"s_pos": s_pos, "s_end": s_end})
    apart = (F.col("s")["chrom"] != F.col("chrom")) | (F.abs(F.col("s_pos") - F.col("start1")) >= far)
    trusted = (F.col("s")["mq"] >= min_sa_mapq) & (F.col("s")["nm"] <= max_nm) & (F.col("s")["mq"] > 0) & apart
    broken = trusted | (F.col("s")["strand"] != F.col("strand")) | ((right > 0) & (F.col("s_end") < F.col("start1"))) | ((left > 0) & (F.col("s_pos") > F.col("end1")))
    chimeric = ~F.col("is_event") & F.col("s").isNotNull() & ((left > 0) | (right > 0)) & broken
    own = own.withColumn("bnd", F.coalesce(chimeric, F.lit(False)))
    same = F.col("s")["strand"] == F.col("strand")
    rl, lr = right > left, left > right
    sl, sr = F.col("s_left") > F.col("s_right"), F.col("s_right") > F.col("s_left")
    pattern = F.when(same & rl & sl, 1).when(same & lr & sr, 2).when(~same & rl & sr, 3).when(~same & lr & sl, 4)
    own = own.withColumn("pattern", F.when(F.col("bnd"), pattern))
    touches = (F.col("start1") < F.col("locus_end")) & (F.col("end1") > F.col("locus_start"))
    kind_of = F.when(F.col("is_event"), "INDEL").when(F.col("bnd"), F.when(F.col("pattern").isNotNull(), "BND")).when(touches, "REF")
    own = own.withColumn("type", F.when(reaches, kind_of))
    by_type = lambda indel, bnd, ref: F.when(F.col("type") == "INDEL", indel).when(F.col("type") == "BND", bnd).otherwise(ref)
    query = lambda a, n: F.substring("seq", a.cast("int"), n.cast("int"))
    # bases of the read that replace the reference; a deletion keeps the first reference base instead
    own_bases = F.when(F.col("kind") == "I", query(F.col("e_query"), F.col("e_all") + 1)).when(F.col("kind") == "C", query(F.col("e_query") + 2, F.greatest(F.lit(0), F.col("e_query_total") - 1)))
    odd = F.col("pattern").isin(1, 3)
    pos = by_type(F.col("e_pos"), F.when(odd, F.col("end1")).otherwise(F.col("start1") - 1), F.col("locus_start"))
    pos2 = F.when(F.col("pattern") == 1, F.col("s_pos")).when(F.col("pattern") == 2, F.col("s_end") + 1).when(F.col("pattern") == 3, F.col("s_end")).when(F.col("pattern") == 4, F.col("s_pos"))
    none, empty, number = F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("bigint")
    from_, to = F.when(F.col("kind") == "I", F.col("e_pos") - 2).when(F.col("kind").isNotNull(), F.col("e_pos") - 1), F.when(F.col("kind") == "I", F.col("e_pos") - 1).when(F.col("kind").isNotNull(), F.col("e_pos") + F.col("e_all"))
    narrow = own.select(
        *KEY, "chrom", pos.alias("pos"), by_type(none, F.col("s")["chrom"], none).alias("chrom2"), by_type(number, pos2, number).alias("pos2"),
        by_type(F.lit("++"), F.when(same, "++").otherwise("+-"), empty).alias("strands"), "type", "kind", own_bases.alias("own_bases"), from_.alias("ref_from"), to.alias("ref_to"), (to - from_).alias("ref_size"),
    )
    # only these columns travel to the reference
    narrow = cut(narrow, "records").where("type is not null")
    found = fetch_asked(narrow, reference, "kind is not null", "ref_from", "ref_to", "ref_bases", index, size="ref_size")
    alt = F.when(F.col("kind") == "D", F.substring("ref_bases", 1, 1)).otherwise(F.col("own_bases"))
    return found.select(*KEY, "chrom", "pos", "chrom2", "pos2", "strands", by_type(F.col("ref_bases"), empty, F.lit(".")).alias("ref"), by_type(alt, empty, F.lit(".")).alias("alt"), "type")


def collapse_fragments(records: DataFrame) -> DataFrame:
    """One record per sample, locus and read name: INDEL before BND before REF, ties by ordinal and then by the
    record itself, and per column the first value that is not null in that order. Records have a chromosome, position, strands and type."""
    rank = F.when(F.col("type") == "INDEL", 0).when(F.col("type") == "BND", 1).otherwise(2)
    known = lambda c, value="": F.coalesce(c, F.lit(value)).alias(c)
    # a total order of records, so that equal ordinals cannot make the result depend on the order of rows
    order = F.struct(rank.alias("r"), "ordinal", "pos", known("chrom2"), known("pos2", -1), "strands", known("ref"), known("alt"))
    whole = ("chrom", "pos", "strands", "type")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    # plain records travel, not a record and its order for every column; columns that no record lacks come from the first record at once
    dealt = records.repartition("sample", "locus", "qname")
    found = dealt.groupBy("sample", "locus", "qname").agg(F.min_by(F.struct(*whole), order).alias("_first"), *(first(c) for c in ALLELE if c not in whole))
    return found.select("sample", "locus", "qname", *(F.col("_first")[c].alias(c) if c in whole else F.col(c) for c in ALLELE))


ALLELE = ["chrom", "pos", "chrom2", "pos2", "strands", "ref", "alt", "type"]


def count_alleles(fragments: DataFrame) -> DataFrame:
    """Fragments per sample, locus and allele; nulls in the allele form groups."""
    return fragments.groupBy("sample", "locus", *ALLELE).agg(F.count("*").alias("counts"))
