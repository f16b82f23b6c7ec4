"""A corpus pipeline of five stages over the documents table.

Language identification (documents without a known language go), exact deduplication, near-duplicate
removal (one document of each group stays), mixing to target weights (each document appears as often as
the mix takes it, in whole copies whose words meet the targets), and sampled SentencePiece segmentations of what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm import exactdup, langid, mix, neardup
from locuslens.llm.queries import segmentations
from locuslens.session import cut, table

#: A whole copy, in the integer units in which remainders add up.
UNIT = 1 << 24

#: The language stage rejects by a learned model, which SQL cannot express.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; texts far from every learned language (unless very short) or without letters, and null texts, go. Every column passes through."""
    model = langid.fit(learned := langid.training_rows(docs, ~langid.held_out()))
    packed = docs.select("doc_id", "text", F.struct(*(F.col(c) for c in docs.columns)).alias("row"))
    known = langid.identify(packed, model, carry=("row",), limit=langid.loss_limit(learned, model)).where(F.col("lang_pred") != langid.UNKNOWN)
    return known.select("row.*")


def row_key() -> Column:
    """What tells the rows of one doc_id apart, ordered by doc_id (null last): rows of one key are equal for every stage."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.sha2(exactdup.normalised("text"), 256).alias("sha"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the smallest doc_id; repeated rows become one."""
    kept = exactdup.exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    marked = docs.withColumn("_own", F.sha2(exactdup.normalised("text"), 256))
    stay = marked.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")), "left_semi")
    return stay.dropDuplicates(["doc_id", "_own"]).drop("_own")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates: that of the smallest doc_id. Texts that share a doc_id are documents of their own."""
    marked = docs.withColumn("_row", row_key())
    kept = neardup.near_duplicates(marked.select("_row", "text"), key="_row").where("kept").select(F.col("_row").alias("_kept"))
    return marked.join(kept, F.col("_row") == F.col("_kept"), "left_semi").drop("_row")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them, without bias; texts without words go.

    Each row has ``taken div size`` copies; the remainders give one more to a systematic sample of a
    shard's rows in order of size, so that the words of a shard miss what it takes by about one document.
    Texts that share a doc_id are taken each for itself.
    """
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(exactdup.normalised("text"), 256))
    marked = docs.withColumn("_row", key)
    mixed = mix.mix_documents(marked.select("_row", "text", "source"), key="_row").where("size > 0").withColumn("_rest", F.expr(f"(taken % size) * {UNIT}L div size"))
    place = ("source", "shard")
    start = mix.hash32(F.concat_ws(":", F.lit("mix-copies"), *(F.col(c).cast("string") for c in place))) % UNIT
    upto = F.sum("_rest").over(W.partitionBy(*place).orderBy("size", F.xxhash64("_row"), "_row", "taken").rowsBetween(W.unboundedPreceding, 0)) + start
    one = (F.floor(upto / UNIT) - F.floor((upto - F.col("_rest")) / UNIT)).cast("int")
    times = (F.expr("int(taken div size)") + one).cast("int")
    taken = mixed.select(F.col("_row").alias("_id"), times.alias("_times")).where("_times > 0").dropDuplicates(["_id"])
    joined = marked.join(taken, F.col("_row") == F.col("_id"))
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), "_times")).alias("_copy")).drop("_copy")


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every row, with inclusion scores and a decoding check."""
    return segmentations(docs)


STAGES = [("language_id", language_stage), ("exact_dedup", exact_stage), ("minhash_neardup", near_stage), ("mix_sources", mix_stage), ("sentencepiece", piece_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
