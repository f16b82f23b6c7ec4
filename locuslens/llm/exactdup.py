"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Normalised texts are cut into blocks of a fixed number of characters. Distinct blocks are dealt out by
hash and sorted; a block's partition and its place there make its integer name. Adjacent names of a
document form pairs, the distinct pairs are sorted and named again, and so on until every document has
one name. Equal names mean equal
texts, without any chance of collision: block contents travel once, to be made distinct and sorted, and meet their names by
a 64-bit hash only where that hash belongs to one block; blocks that share a hash meet by content.

Names are cut to the shared folder at every level, so retries and lost executors cannot change them.
Frequent blocks are combined before they travel, and hot join keys are split by adaptive execution.

Defined results: null counts as the empty text; texts that differ in white space only are equal; among
rows of equal text and length the smallest key stays, null keys last; rows repeated whole are one
document of which the first copy stays; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm.common import let
from locuslens.session import cut

BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: str) -> Column:
    """The text without ASCII white space; empty for null."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def sorted_names(distinct: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``columns`` of distinct rows with ``name``: the partition and the place in its sort order, as one integer."""
    return cut(distinct.sortWithinPartitions(*columns).select(*columns, F.monotonically_increasing_id().alias("name")), name)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = 4096, hash_range: int | None = None) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256, copy`` per row of ``docs``.

    ``hash_range`` narrows the block hash, to test blocks that share one.
    """
    place = F.xxhash64 if hash_range is None else lambda c: F.pmod(F.xxhash64(c), F.lit(hash_range))
    whole = docs.select(F.col(key), F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"), normalised(text).alias("norm"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("norm") - 1) / block)).cast("int"))
    part = lambda i, text="norm": F.substring(F.col(text) if isinstance(text, str) else text, i * block + 1, F.lit(block))
    rows = cut(whole.select(key, "chars", F.sha2("norm", 256).alias("sha"), let(F.col("norm"), lambda text: F.transform(starts, lambda i: place(part(i, text)))).alias("hashes")), "block-hashes")
    row_key = F.concat_ws(":", F.col(key).cast("string"), "sha")

    # level 0: distinct blocks in order; the content is dropped once it is sorted
    pieces = whole.select(F.explode(starts).alias("i"), "norm").select(part(F.col("i")).alias("block"))
    blocks = pieces.select("block", place(F.col("block")).alias("hash")).distinct()
    names = cut(blocks.sortWithinPartitions("hash", "block").select("hash", F.monotonically_increasing_id().alias("name")), "block-names")
    once = rows.dropDuplicates([key, "sha"]).select(row_key.alias("k"), F.size("hashes").alias("n"), F.posexplode("hashes").alias("pos", "hash"))
    clashing = cut(names.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1").select("hash"), "clashing-hashes")
    named = once.join(names, "hash")
    if not clashing.isEmpty():
        # the i-th of the blocks that share a hash gets the i-th of their names
        rank = lambda c: F.row_number().over(W.partitionBy("hash").orderBy(c)).alias("r")
        inside = blocks.join(clashing, "hash", "left_semi").select("hash", "block", rank("block"))
        ranked = names.join(clashing, "hash", "left_semi").select("hash", "name", rank("name"))
        by_content = inside.join(ranked, ["hash", "r"]).select("block", "name")
        cells = whole.select(F.concat_ws(":", F.col(key).cast("string"), F.sha2("norm", 256)).alias("k"), F.size(starts).alias("n"), F.posexplode(starts).alias("pos", "i"), "norm")
        cells = cells.select("k", "n", "pos", part(F.col("i")).alias("block")).withColumn("hash", place(F.col("block"))).join(clashing, "hash", "left_semi").dropDuplicates(["k", "pos"])
        named = named.join(clashing, "hash", "left_anti").select("k", "n", "pos", "name").union(cells.join(by_content, "block").select("k", "n", "pos", "name"))
    named, level, done = cut(named.select("k", "n", "pos", "name"), "names-0"), 0, []
    while True:
        done.append(named.where("n = 1").select("k", F.lit(level).alias("level"), "name"))
        going = named.where("n > 1")
        if going.isEmpty():
            break
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = cut(
            going.groupBy("k", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(even, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"), F.ceil(F.first("n") / 2).cast("int").alias("n")),
            f"pairs-{level}",
        )
        pair_names = sorted_names(pairs.select("left", "right").distinct(), ["left", "right"], f"pair-names-{level}")
        named = cut(pairs.join(pair_names, ["left", "right"]).select("k", "n", "pos", "name"), f"names-{level}")
    identity = done[0]
    for d in done[1:]:
        identity = identity.union(d)
    copies = rows.groupBy(key, "chars", "sha").agg(F.count("*").alias("copies")).withColumn("k", row_key)
    owned = cut(copies.join(identity, "k"), "identities")
    groups = owned.groupBy("level", "name").agg(F.sum("copies").alias("group_size"), F.min(F.struct(-F.col("chars"), F.col(key).isNull().alias("none"), F.col(key).alias("id"))).alias("best"))
    groups = cut(groups.select("level", "name", "group_size", F.col("best.id").alias("keep_id"), F.col("best.col1").alias("best_chars")), "groups")
    # groups of more than a thousandth of all rows are fewer than a thousand: these are broadcast, the others joined
    total = groups.agg(F.sum("group_size").alias("total"))
    hot = groups.where("group_size > 1000").join(F.broadcast(total), F.expr("group_size * 1000 > total")).drop("total")
    place = ["level", "name"]
    rest = owned.join(F.broadcast(hot.select(*place)), place, "left_anti").join(groups, place)
    found = rest.unionByName(owned.join(F.broadcast(hot), place))
    copy = found.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    stays = F.col(key).eqNullSafe(F.col("keep_id")) & (F.col("chars") == -F.col("best_chars")) & (F.col("copy") == 1)
    return copy.select(key, "keep_id", "group_size", stays.alias("kept"), F.col("sha").alias("text_sha256"), "copy")
