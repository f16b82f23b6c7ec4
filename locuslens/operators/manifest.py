"""Sample manifests: normalising, validating, reshaping, grouping and pairing rows.

Rows carry ``ordinal`` (their place in the sheet), ``id``, ``uid``, ``sample_type`` and optional path columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuslens.functions import dna
from locuslens.session import cut, scratch_dir

#: Columns of a normalised manifest row, in order (fixed format).
COLUMNS = ["id", "uid", "sample_type", "sample_id", "assay", "i7index", "i5index", "flowcell", "lane", "dragen_path", "read1", "read2", "cram", "bam", "hotspot_file"]
FASTQ_NAME = r"^\S+\.f(ast)?q\.gz$"


def blank_to_null(rows: DataFrame, columns: list[str] = COLUMNS) -> DataFrame:
    """The fixed columns with blank text as null; missing columns are added as null, others kept."""
    fix = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return rows.select(*(c for c in rows.columns if c not in columns), *fix)


def keep_rows(rows: DataFrame) -> DataFrame:
    """Rows with a sample type or a result path."""
    return rows.where(F.col("sample_type").isNotNull() | F.col("dragen_path").isNotNull())


def override_roles(rows: DataFrame, tumor: str | None = None, normal: str | None = None) -> DataFrame:
    """Sample types set by the ids of the tumor and the normal sample, where given."""
    role = F.when(F.col("id") == F.lit(tumor), "tumor").when(F.col("id") == F.lit(normal), "normal").otherwise(F.col("sample_type"))
    return rows.withColumn("sample_type", role)


def routes(rows: DataFrame) -> DataFrame:
    """One row per kind of input that a manifest row brings: results, reads, cram or bam."""
    kinds = {"results": "dragen_path", "reads": "read1", "cram": "cram", "bam": "bam"}
    present = F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.struct(F.lit(k).alias("kind"), F.col(c).alias("path"))) for k, c in kinds.items())))
    return rows.select("ordinal", "id", F.explode(present).alias("r")).select("ordinal", "id", F.col("r")["kind"].alias("kind"), F.col("r")["path"].alias("path"))


def broken_rules() -> Column:
    """Broken rules of a row as a sorted list of text."""
    bad = lambda cond, text: F.when(F.coalesce(cond, F.lit(False)), F.lit(text))
    ending = lambda c: F.regexp_extract(c, r"\.(f(?:ast)?q\.gz)$", 1)
    rules = [
        bad(F.col("id").isNull() | F.col("id").rlike(r"\s"), "id"),
        bad(F.col("sample_type").isNull(), "sample_type"),
        bad(F.col("read1").isNotNull() & ~F.col("read1").rlike(FASTQ_NAME), "read1 name"),
        bad(F.col("read2").isNotNull() & ~F.col("read2").rlike(FASTQ_NAME), "read2 name"),
        bad(ending(F.col("read1")) != ending(F.col("read2")), "pair suffix"),
        bad(F.col("read1").isNull() & F.col("read2").isNotNull(), "read1 missing"),
    ]
    return F.array_sort(F.array_compact(F.array(*rules)))


def row_errors(rows: DataFrame) -> DataFrame:
    """Broken rules per row as sorted text; rows without any are left out."""
    found = rows.select("ordinal", "id", F.array_join(broken_rules(), ",").alias("errors"), (F.col("read1").isNotNull() & F.col("read2").isNull()).alias("single_end"))
    return found.where("errors != ''")


def missing_paths(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths of the manifest that the listing ``(path)`` lacks."""
    return routes(rows).join(listing.select("path"), "path", "left_anti").select("ordinal", "id", "kind", "path")


def findings(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """``ordinal, id, errors`` of rows that break a rule or name a file that the listing lacks."""
    lost = missing_paths(rows, listing).select("ordinal").distinct().withColumn("lost", F.lit("missing file"))
    all_ = rows.select("ordinal", "id").join(row_errors(rows).select("ordinal", "errors"), "ordinal", "left").join(lost, "ordinal", "left")
    return all_.where("errors is not null or lost is not null").select("ordinal", "id", F.concat_ws(",", "errors", "lost").alias("errors"))


def require_valid(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """``rows`` if none has findings; else an error that tells how many have and shows the first ones."""
    found = findings(rows, listing)
    bad = found.count()
    if bad:
        shown = "; ".join(f"row {r.ordinal} ({r.id}): {r.errors}" for r in found.orderBy("ordinal").limit(5).collect())
        raise ValueError(f"{bad} manifest rows are not valid: {shown}")
    return rows


#: Columns of a manifest that name files.
PATHS = ("read1", "read2", "cram", "bam", "dragen_path")


def with_listed_reads(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows that name a list in ``fastq_list`` once per read pair that it holds for their id, without alignments; other rows as they are.

    A row whose list has nothing for it stays without reads."""
    named = rows.where("fastq_list is not null").drop("read1", "read2", "cram", "bam")
    held = lists.select(F.col("list").alias("_list"), F.col("RGSM").alias("_id"), F.col("Read1File").alias("read1"), F.col("Read2File").alias("read2"))
    found = named.join(held, (F.col("fastq_list") == F.col("_list")) & (F.col("id") == F.col("_id")), "left").drop("_list", "_id")
    return rows.where("fastq_list is null").unionByName(found, allowMissingColumns=True)


def with_names(rows: DataFrame, votes: DataFrame, path: str = "read1") -> DataFrame:
    """Rows with reads take index, flowcell and lane from the vote of their first file's read names where the sheet lacks them.

    The second index is read from the other strand. Unknown indexes stay null."""
    given = votes.select(F.col("file").alias("_file"), F.nullif("i7index", F.lit("UNKNOWN")).alias("_i7index"), dna.reverse_complement(F.col("i5index")).alias("_i5index"), F.col("flowcell").alias("_flowcell"), F.col("lane").alias("_lane"))
    met = rows.where(F.col(path).isNotNull()).join(given, F.col(path) == F.col("_file"), "left")
    filled = met.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in ("i7index", "i5index", "flowcell", "lane")}).select(*rows.columns)
    return rows.where(F.col(path).isNull()).unionByName(filled)


def by_input(rows: DataFrame) -> DataFrame:
    """One row per kind of input that a row brings, with the paths of that kind (results stay beside reads and alignments); rows without any have kind ``none``."""
    own = {"reads": ("read1", "read2", "dragen_path"), "cram": ("cram", "dragen_path"), "bam": ("bam", "dragen_path"), "results": ("dragen_path",)}
    present = F.array_compact(F.array(*(F.when(F.col(paths[0]).isNotNull(), F.lit(kind)) for kind, paths in own.items())))
    kinds = rows.select("*", F.explode(F.when(F.size(present) > 0, present).otherwise(F.array(F.lit("none")))).alias("kind"))
    keep = lambda c: F.when(F.col("kind").isin([kind for kind, paths in own.items() if c in paths]), F.col(c)).alias(c)
    return kinds.select(*(keep(c) if c in PATHS else F.col(c) for c in kinds.columns))


def enrich(rows: DataFrame, lists: DataFrame, votes: DataFrame, path: str = "read1") -> DataFrame:
    """A sheet as the steps after it need it: reads of fastq lists, index, flowcell and lane from read names, one row per kind of input."""
    return by_input(with_names(with_listed_reads(rows, lists), votes, path))


def checked(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """``rows`` with ``errors``: broken rules, ``no input`` and ``missing file`` for paths that ``listing (path)`` lacks; null if none."""
    once = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "sheet")
    named = once.select("_row", F.explode(F.array_compact(F.array(*PATHS))).alias("path"))
    lost = named.join(listing.select("path"), "path", "left_anti").select("_row").distinct().withColumn("_lost", F.lit("missing file"))
    nothing = F.when(F.col("kind") == "none", F.lit("no input")) if "kind" in rows.columns else F.lit(None)
    errors = F.nullif(F.concat_ws(",", F.array_join(broken_rules(), ","), nothing, "_lost"), F.lit(""))
    told = once.join(lost, "_row", "left").withColumn("errors", F.nullif(F.ltrim(errors, F.lit(",")), F.lit("")))
    return told.select(*rows.columns, "errors")


class Validated(NamedTuple):
    """Both parts of a checked sheet, and how many rows they have."""

    valid: DataFrame
    rejected: DataFrame
    rows: int
    bad: int


def validate(rows: DataFrame, listing: DataFrame, strict: bool = False) -> Validated:
    """Check a sheet and write it once, valid rows and, with their ``errors``, rejected ones in quarantine.

    The counts are observed while it is written. With ``strict`` any rejected row fails the job; what it wrote stays."""
    spark, seen = rows.sparkSession, Observation("sheet")
    told, path = checked(rows, listing), scratch_dir(rows.sparkSession, "validated")
    told.withColumn("valid", F.col("errors").isNull()).observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("errors").isNotNull()).alias("bad")).write.partitionBy("valid").parquet(path)
    written = spark.read.schema(T.StructType([*told.schema.fields, T.StructField("valid", T.BooleanType())])).parquet(path)
    counts = seen.get
    if strict and counts["bad"]:
        raise ValueError(f"{counts['bad']} of {counts['rows']} manifest rows are not valid; see {path}/valid=false")
    return Validated(written.where("valid").drop("valid", "errors"), written.where("not valid").drop("valid"), counts["rows"], counts["bad"])


def expand_folders(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Result folders ``(id, folder)`` with each file of a listing ``(folder, path)`` below them."""
    return folders.join(files, "folder").select("id", "path")


def fastq_lists(rows: DataFrame) -> DataFrame:
    """Rows of fastq lists of each case ``uid``: read group, sample, library, lane and both files."""
    groups = read_groups(rows).select("ordinal", F.col("rgid").alias("RGID"), F.col("rglb").alias("RGLB"))
    own = rows.where("read1 is not null").select("ordinal", "uid", F.col("id").alias("RGSM"), F.col("lane").cast("string").alias("Lane"), F.col("read1").alias("Read1File"), F.col("read2").alias("Read2File"))
    return own.join(groups, "ordinal").select("uid", "RGID", "RGSM", "RGLB", "Lane", "Read1File", "Read2File")


def look_up_lists(rows: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """Rows with every read pair that the list named by their column ``name`` holds for their id."""
    return rows.join(lists, (rows[name] == lists["list"]) & (rows["id"] == lists["RGSM"]))


def provenance_lines(versions: DataFrame) -> DataFrame:
    """Text lines of modules and their tools' versions; sort by ``module, rank, tool``."""
    own = version_conflicts(versions)
    heads = own.select("module", F.lit(0).alias("rank"), F.lit("").alias("tool"), F.concat("module", F.lit(":")).alias("value")).distinct()
    return heads.unionByName(own.select("module", F.lit(1).alias("rank"), "tool", F.concat(F.lit("    "), "tool", F.lit(": "), "versions").alias("value")))


def read_groups(rows: DataFrame) -> DataFrame:
    """Read-group id and library of rows with reads; null parts are left out."""
    group = F.concat_ws(".", "flowcell", F.nullif("sample_id", F.lit("")), "i7index", "i5index", "lane")
    return rows.where("read1 is not null").select("ordinal", "id", group.alias("rgid"), F.concat_ws(".", "id", "i7index", "i5index").alias("rglb"))


def facility_reshape(sheet: DataFrame) -> DataFrame:
    """A facility sheet ``(ordinal, library, index, flowcell, lane, fastq)``: split library and index, read number from the name."""
    part = lambda c, i: F.get(F.split(c, "-"), F.lit(i))
    first = F.col("fastq").contains("_R1_")
    return sheet.select("ordinal", part("library", 0).alias("uid"), part("library", 1).alias("id"), part("library", 2).alias("assay"), part("index", 0).alias("i7index"), part("index", 1).alias("i5index"), "flowcell", "lane", F.when(first, F.col("fastq")).alias("read1"), F.when(~first, F.col("fastq")).alias("read2"), F.lit(None).cast("string").alias("sample_type"), F.lit(None).cast("string").alias("sample_id"))


def facility_pairs(sheet: DataFrame) -> DataFrame:
    """A facility sheet with both files in a row ``(ordinal, library, index, flowcell, lane, read1, read2)``, reshaped alike."""
    part = lambda c, i: F.get(F.split(c, "-"), F.lit(i))
    none = F.lit(None).cast("string")
    return sheet.select("ordinal", part("library", 0).alias("uid"), part("library", 1).alias("id"), part("library", 2).alias("assay"), part("index", 0).alias("i7index"), part("index", 1).alias("i5index"), "flowcell", "lane", "read1", "read2", none.alias("sample_type"), none.alias("sample_id"))


def pair_reads(first: DataFrame, second: DataFrame) -> DataFrame:
    """First and second reads of the same library, flowcell, index and lane."""
    keys = ["library", "flowcell", "index", "lane"]
    return first.select(*keys, F.col("fastq").alias("read1")).join(second.select(*keys, F.col("fastq").alias("read2")), keys)


def ordered(columns: list[str], order: str, where: Column | None = None) -> Column:
    """Values joined by ``;`` in the order of ``order``: a list that belongs to one case."""
    item = F.struct(F.col(order).alias("o"), F.concat_ws(",", *columns).alias("v"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(item if where is None else F.when(where, item))), lambda x: x.v), ";")


def case_lists(rows: DataFrame) -> DataFrame:
    """Fastq list of each case: sample id and base names of its reads, in sheet order."""
    base = lambda c: F.coalesce(F.element_at(F.split(c, "/"), -1), F.lit(""))
    named = rows.where("read1 is not null").withColumns({"r1": base("read1"), "r2": base("read2")})
    return named.groupBy("uid").agg(ordered(["id", "lane", "r1", "r2"], "ordinal").alias("fastq_list"), F.count("*").alias("n_files"))


def case_roles(rows: DataFrame) -> DataFrame:
    """First tumor and first normal sample of each case in sheet order."""
    first = lambda role: F.min_by("id", F.when((F.col("sample_type") == role) & F.col("id").isNotNull(), F.col("ordinal"))).alias(role)
    return rows.groupBy("uid").agg(first("tumor"), first("normal"))


def case_pairs(rows: DataFrame) -> DataFrame:
    """Cases with both roles, by kind of input, with their files in sheet order; others are dropped."""
    inputs = rows.join(routes(rows).where("kind != 'results'").select("ordinal", "kind", "path"), "ordinal")
    first = lambda role: F.min_by("id", F.when(F.col("sample_type") == role, F.col("ordinal"))).alias(role)
    grouped = inputs.groupBy("uid", "kind").agg(first("tumor"), first("normal"), ordered(["path"], "ordinal").alias("files"))
    return grouped.where("tumor is not null and normal is not null")


def duplicates(rows: DataFrame) -> DataFrame:
    """Sample and file pairs that occur more than once."""
    return rows.groupBy("uid", "hotspot_file").agg(F.count("*").alias("n")).where("n > 1")


def version_conflicts(versions: DataFrame) -> DataFrame:
    """Modules (last part of the process name) and tools with their versions; conflict if there are several."""
    module = F.element_at(F.split("process", ":"), -1)
    grouped = versions.groupBy(module.alias("module"), "tool").agg(F.array_join(F.array_sort(F.collect_set("version")), ",").alias("versions"), F.countDistinct("version").alias("n"))
    return grouped.select("module", "tool", "versions", (F.col("n") > 1).alias("conflict"))


def index_vote(reads: DataFrame, first: int = 1000) -> DataFrame:
    """Most common index, flowcell and lane among the first read names of each file; ties go to the first seen.

    Names without an index vote for ``UNKNOWN``."""
    from pyspark.sql import Window as W

    head = reads.withColumn("_n", F.row_number().over(W.partitionBy("file").orderBy("row"))).where(F.col("_n") <= first)
    field = lambda c, i: F.get(F.split(c, ":"), F.lit(i))
    parts = F.split("name", " ")
    index = F.coalesce(F.nullif(field(F.get(parts, F.lit(1)), 3), F.lit("")), F.lit("UNKNOWN"))
    named = head.select("file", "_n", field(F.get(parts, F.lit(0)), 2).alias("flowcell"), field(F.get(parts, F.lit(0)), 3).alias("lane"), index.alias("index"))
    votes = named.groupBy("file", "index").agg(F.count("*").alias("votes"), F.min("_n").alias("seen"), F.min_by("flowcell", "_n").alias("flowcell"), F.min_by("lane", "_n").alias("lane"))
    best = votes.groupBy("file").agg(F.max(F.struct("votes", (-F.col("seen")).alias("seen"), "index", "flowcell", "lane")).alias("b"))
    split = lambda i: F.get(F.split(F.col("b")["index"], r"\+"), F.lit(i))
    return best.select("file", F.col("b")["votes"].alias("votes"), split(0).alias("i7index"), split(1).alias("i5index"), F.col("b")["flowcell"].alias("flowcell"), F.col("b")["lane"].alias("lane"))
