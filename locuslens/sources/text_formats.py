"""Readers and writers of manifests, BED, bedGraph, coverage, SAM, FASTA and FASTQ text.

Readers take a path or folder that Spark can reach and split by lines; only a manifest's first line is
looked at on the driver, to find its separator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Required columns of a SAM line, in order (fixed format).
SAM = ["qname", "flag", "chrom", "pos", "mapq", "cigar", "mate_chrom", "mate_pos", "tlen", "seq", "qual"]
#: Columns of a fastq list, in order (fixed format).
FASTQ_LIST = ["RGID", "RGSM", "RGLB", "Lane", "Read1File", "Read2File"]
#: Header spellings of site files and the names used here.
SITE_NAMES = {"source": "source", "dna_sequence": "dna", "pam": "pam", "chromosome": "chrom", "strand": "strand", "strand_direction": "strand", "start": "start", "bulge_type": "bulge_type", "mismatch": "mismatch", "bulge_size": "bulge_size", "on_target": "on_target"}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A delimited sheet with a header, all text; the separator is the most frequent candidate of the first line."""
    first = spark.read.text(path).head()
    line = first[0] if first else ""
    separator = max(",\t;|", key=line.count)
    return spark.read.csv(path, sep=separator, header=True)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """A candidate site table; both header spellings are accepted."""
    raw = spark.read.csv(path, header=True)
    named = [F.col(f"`{c}`").alias(SITE_NAMES[n]) for c in raw.columns if (n := c.strip().lower().replace(" ", "_")) in SITE_NAMES]
    return raw.select(*named).withColumns({"start": F.col("start").cast("bigint"), "mismatch": F.col("mismatch").cast("int"), "on_target": F.col("on_target") == "1"})


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """First three columns of a headerless BED file."""
    parts = F.split("value", "\t")
    return spark.read.text(path).where("value != ''").select(parts[0].alias("chrom"), parts[1].cast("bigint").alias("start"), parts[2].cast("bigint").alias("end"))


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """Lines of exactly four fields; gzip files are read by their suffix."""
    parts = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).select(parts.alias("p")).where(F.size("p") == 4)
    return lines.select(F.col("p")[0].alias("chrom"), F.col("p")[1].cast("bigint").alias("start"), F.col("p")[2].cast("bigint").alias("end"), F.col("p")[3].cast("double").alias("score"))


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Normalised coverage; header lines are those whose second field is no number."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).select(parts[0].alias("chrom"), F.expr("try_cast(get(split(value, '\t'), 1) as bigint)").alias("start"), F.expr("try_cast(get(split(value, '\t'), 2) as bigint)").alias("end"), F.get(parts, F.lit(3)).alias("name"), F.expr("try_cast(get(split(value, '\t'), 4) as double)").alias("coverage"), F.expr("try_cast(get(split(value, '\t'), 5) as bigint)").alias("pairs"))
    return rows.where("start is not null")


def read_sam(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """Alignments from SAM text: 0-based start and end, mate contig resolved, NM, SA and MC tags as columns."""
    from locuslens.functions import dna

    parts = F.split("value", "\t")
    raw = spark.read.text(path).where("value != '' and not startswith(value, '@')")
    tag = lambda name: F.nullif(F.regexp_extract("value", rf"\t{name}:[AiZf]:([^\t]*)", 1), F.lit(""))
    rows = raw.select(*(parts[i].alias(c) for i, c in enumerate(SAM)), tag("NM").cast("bigint").alias("nm"), tag("SA").alias("sa"), tag("MC").alias("mc"), F.monotonically_increasing_id().alias("ordinal"))
    start = F.col("pos").cast("bigint") - 1
    mate = F.when(F.col("mate_chrom") == "=", F.col("chrom")).otherwise(F.col("mate_chrom"))
    return rows.select(F.lit(sample).alias("sample"), "qname", F.col("flag").cast("int").alias("flag"), "chrom", start.alias("pos"), (start + dna.op_total(F.col("cigar"), "MDN=X")).alias("end"), F.col("mapq").cast("int").alias("mapq"), "cigar", mate.alias("mate_chrom"), (F.col("mate_pos").cast("bigint") - 1).alias("mate_pos"), "seq", "nm", "sa", "mc", "ordinal")


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, at, value`` of all lines: ``split`` is where the reader's split begins, ``at`` the order inside it."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")


def read_fasta(spark: SparkSession, path: str, chunk: int = 32) -> DataFrame:
    """Reference chunks ``(chrom, chunk, bases)``, read line by line; a contig may span any number of splits.

    Lines are placed inside their split, and splits carry the open contig and its length on to the next one.
    """
    inside = W.partitionBy("file", "split").orderBy("at")
    head = F.startswith("value", F.lit(">"))
    lines = lines_of(spark, path).select("file", "split", "at", head.alias("head"), F.when(head, F.regexp_extract("value", r"^>\s*(\S*)", 1)).alias("name"), F.when(head, "").otherwise(F.regexp_replace("value", r"\s", "")).alias("bases"))
    lines = lines.withColumns({"n": F.count_if("head").over(inside), "own": F.last("name", True).over(inside), "size": F.length("bases").cast("bigint")})
    ahead = W.partitionBy("file", "split", "n").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    lines = lines.withColumn("start", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    runs = lines.groupBy("file", "split", "n").agg(F.sum("size").alias("size"), F.max("own").alias("own"))
    splits = runs.groupBy("file", "split").agg(F.max("n").alias("heads"), F.max_by("size", "n").alias("tail"), F.max_by("own", "n").alias("own"))
    by_file = W.partitionBy("file").orderBy("split")
    splits = splits.withColumn("era", F.count_if(F.col("heads") > 0).over(by_file))
    splits = splits.withColumn("open", F.sum("tail").over(W.partitionBy("file", "era").orderBy("split")))
    carried = splits.select("file", "split", F.lag("open").over(by_file).alias("before"), F.last("own", True).over(by_file.rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    placed = lines.where("size > 0").join(carried, ["file", "split"])
    start = F.col("start") + F.when(F.col("n") == 0, F.coalesce("before", F.lit(0))).otherwise(F.lit(0))
    placed = placed.select(F.coalesce("own", "carried").alias("chrom"), start.alias("a"), (start + F.col("size")).alias("b"), "bases")
    parts = placed.select("*", F.explode(F.sequence(F.floor(F.col("a") / chunk), F.floor((F.col("b") - 1) / chunk))).alias("chunk"))
    from_ = F.greatest(F.col("a"), F.col("chunk") * chunk)
    piece = F.substring("bases", (from_ - F.col("a") + 1).cast("int"), (F.least(F.col("b"), (F.col("chunk") + 1) * chunk) - from_).cast("int"))
    held = parts.select("chrom", "chunk", F.struct(from_.alias("at"), piece.alias("p")).alias("part")).groupBy("chrom", "chunk").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return held.select("chrom", "chunk", F.array_join("parts.p", "").alias("bases"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Four-line records of all files below ``path``: file, row, name, seq, quality.

    Lines are numbered inside their split, and splits by the lines before them.
    """
    lines = lines_of(spark, path)
    counts = lines.groupBy("file", "split").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(W.partitionBy("file", "split").orderBy("at")) - 1
    numbered = lines.withColumn("i", inside).join(counts.select("file", "split", before.alias("before")), ["file", "split"]).withColumn("n", F.col("before") + F.col("i"))
    rows = numbered.select("file", F.floor(F.col("n") / 4).alias("row"), (F.col("n") % 4).alias("part"), "value")
    field = lambda i: F.max(F.when(F.col("part") == i, F.col("value")))
    return rows.groupBy("file", "row").agg(field(0).alias("name"), field(1).alias("seq"), field(3).alias("quality"))


def read_fastq_lists(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all fastq lists below ``path`` with ``list``, the name of the folder that holds each one's file."""
    rows = spark.read.option("recursiveFileLookup", True).csv(path, header=True, schema=", ".join(f"{c} string" for c in FASTQ_LIST))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(F.regexp_replace(F.url_decode(folder), "^list=", "").alias("list"), *FASTQ_LIST)


def write_lists_together(lists: DataFrame, path: str) -> None:
    """Fastq lists ``(list, ...)`` as sheets that hold many lists, each whole and in one file, with its name as first column.

    ``write_csv`` by list makes a folder and a file per list, which suits few lists; the files here follow the amount of data.
    """
    lists.select("list", *FASTQ_LIST).repartition("list").sortWithinPartitions("list").write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_lists_together(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all lists that ``write_lists_together`` wrote, with the columns of ``read_fastq_lists``."""
    return spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in ["list", *FASTQ_LIST]))


def write_alignments(reads: DataFrame, path: str) -> None:
    """Alignments as Parquet, one folder per contig and sorted by place, so that a region reads few row groups."""
    reads.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.partitionBy("chrom").mode("overwrite").parquet(path)


def read_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """Alignments over ``[start, end)`` of one contig: its folder only, the places as pushed-down filters."""
    return spark.read.parquet(path).where((F.col("chrom") == chrom) & (F.col("pos") < end) & (F.col("end") > start))


def write_sam(reads: DataFrame, path: str) -> None:
    """SAM text of alignments: 1-based places, ``=`` for a mate on the same contig, tags for what is known."""
    tag = lambda name, kind: F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{name.upper()}:{kind}:"), F.col(name).cast("string")))
    mate = F.when(F.col("mate_chrom") == F.col("chrom"), "=").otherwise(F.col("mate_chrom"))
    text = lambda c: F.col(c).cast("string")
    fields = ["qname", text("flag"), "chrom", (F.col("pos") + 1).cast("string"), text("mapq"), "cigar", mate, (F.col("mate_pos") + 1).cast("string"), F.lit("0"), "seq", F.lit("*"), tag("nm", "i"), tag("sa", "Z")]
    reads.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, path: str, sort: list[str | Column] | None = None) -> None:
    """Tab-separated text with a header; with ``sort`` in global order (ranges of rows, sorted, one file each)."""
    out = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    out.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Comma-separated text with a header, one folder per value of ``by`` if given."""
    writer = df.write.mode("overwrite").option("header", True).option("emptyValue", "")
    (writer.partitionBy(by) if by else writer).csv(path)


def write_lines(lines: DataFrame, path: str, order: list[str]) -> None:
    """The ``value`` column as text in global order (ranges of rows, sorted, one file each)."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)
