"""Mixing sources to target weights with Sainte-Lague quotas, in DataFrame operations only.

Targets share a total by weight under a cap per source, the excess reshared until none is above its cap
(one pass over the sources in order of cap per weight). Equal-token blocks go to sources by the highest
quotients ``target / (2 s - 1)``: a divisor bound gives every source a number of blocks that it surely
has, and only the few contested quotients, about two per source, are ranked. The same apportionment
spreads a source's blocks over its shards (hashed; as many as its words or its rows ask for, so that a hot source has many). Inside a shard the
documents lie end to end in seeded order, cut into equal blocks; a seeded affine permutation picks
exactly the quota, and a document takes the words of its span that lie in picked blocks.

Defined results: null text has size 0 and takes 0; the null source is one source, ordered last; repeated
rows count and take separately; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm.common import WORD_PATTERN, salted
from locuslens.session import cut

WEIGHTS = (3, 1, 2)
#: A prime above any number of blocks in a shard: its multiples visit every block once.
STRIDE = 2147483647


def hash32(text: Column) -> Column:
    """A 32-bit integer from the MD5 of a string, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def apportion(votes: DataFrame, group: list[str], order: str, value: str, seats: str, out: str) -> DataFrame:
    """``votes`` with ``out``: Sainte-Lague seats of each row among the ``seats`` of its group.

    The final divisor lies where ``total / divisor`` is within half a seat per row of ``seats``, which
    bounds every row's seats from both sides; only quotients between the bounds compete.
    """
    every = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    bound = votes.select("*", F.sum(value).over(every).alias("_sum"), F.count("*").over(every).alias("_rows"))
    share = lambda n: F.coalesce(F.floor(F.expr(f"try_divide({value} * ({n}), _sum)") + 0.5), F.lit(0)).cast("bigint")
    bound = bound.withColumn("_low", F.greatest(F.lit(0), share(f"{seats} - _rows / 2.0"))).withColumn("_high", F.when(F.col(value) > 0, share(f"{seats} + _rows / 2.0") + 1).otherwise(F.lit(0)))
    bound = bound.withColumn("_open", F.col(seats) - F.sum("_low").over(every))
    contest = bound.where("_high > _low").select(*group, order, "_open", F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_s"), value)
    rank = F.row_number().over((W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy((F.col(value) / (2 * F.col("_s") - 1)).desc(), F.col(order)))
    won = contest.select(*group, order, "_open", rank.alias("_rank")).where("_rank <= _open").groupBy(*group, order).agg(F.count("*").alias("_won"))
    joined = bound.join(won, [*group, order], "left")
    return joined.withColumn(out, F.col("_low") + F.coalesce("_won", F.lit(0))).drop("_sum", "_rows", "_low", "_high", "_open", "_won")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, rank, source_size, rows, weight, target, total`` per source of ``sizes (source, size)``."""
    every = W.partitionBy(F.lit(0))
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    rank = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    own = own.select("source", "source_size", "rows", rank.alias("rank"))
    own = own.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    own = own.withColumn("total", F.sum("source_size").over(every) * share).withColumn("_cap", F.col("source_size") * cap)
    own = own.withColumn("_per", F.col("_cap") / F.col("weight"))
    ahead = every.orderBy("_per", "rank").rowsBetween(W.unboundedPreceding, -1)
    behind = every.orderBy("_per", "rank").rowsBetween(0, W.unboundedFollowing)
    own = own.withColumn("_level", (F.col("total") - F.coalesce(F.sum("_cap").over(ahead), F.lit(0.0))) / F.sum("weight").over(behind))
    own = own.withColumn("_place", F.row_number().over(every.orderBy("_per", "rank")))
    own = own.withColumn("_first", F.min(F.when(F.col("_level") <= F.col("_per"), F.col("_place"))).over(every))
    own = own.withColumn("_all", F.max(F.when(F.col("_place") == F.col("_first"), F.col("_level"))).over(every))
    target = F.coalesce(F.least("_cap", F.col("weight") * F.col("_all")), F.col("_cap"))
    return own.select("source", "rank", "source_size", "rows", "weight", target.alias("target"), "total")


def mix_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2, block: int = 64, shard_words: int = 1 << 18, shard_rows: int = 1 << 16, seed: str = "mix") -> DataFrame:
    """``key, size, source, source_size, target, taken, shard`` per row of ``docs``; ``taken`` <= ``cap`` * ``size``."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN)).cast("bigint")
    # rows of a key that very many share are told apart by what they hold, so that they spread over shards
    own = salted(docs.select(F.col(key).alias("id"), F.col(source).alias("source"), words.alias("size")), "id")
    told = F.concat_ws(":", F.lit(""), F.coalesce("source", F.lit("")), F.col("size").cast("string"), F.col("_copy").cast("string"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.when(F.col("_copy").isNotNull(), told).otherwise(F.lit("")))
    sizes = cut(own.select("id", "source", "size", F.md5(name).alias("mark")), "sizes")
    every = W.partitionBy(F.lit(0))
    targets = source_targets(sizes, weights, share, float(cap))
    tokens = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("total") / (1000 * F.count("*").over(every))))).cast("bigint")
    targets = targets.withColumn("tokens", tokens).withColumn("blocks", F.floor(F.col("total") / F.col("tokens") + 0.5).cast("bigint"))
    quotas = apportion(targets, [], "rank", "target", "blocks", "quota")
    quotas = cut(quotas.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("rows") / shard_rows)).cast("bigint")), "source-quotas")

    # the quota table has one row per source; Spark broadcasts it only if it is small
    cell = (F.conv(F.substring("mark", 1, 8), 16, 10).cast("bigint") % F.col("shards")).alias("shard")
    placed = cut(sizes.join(quotas.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select("id", "source", "size", "mark", "rank", cell), "placed")
    cells = placed.groupBy("rank", "shard").agg(F.sum("size").alias("length"))
    cells = cells.join(quotas.select("rank", "quota", "tokens"), "rank").withColumn("votes", F.col("length").cast("double"))
    cells = apportion(cells, ["rank"], "shard", "votes", "quota", "seats")
    cells = cells.withColumn("m", F.greatest(F.lit(1), F.floor(F.col("length") / F.col("tokens") + 0.5)).cast("bigint"))
    cells = cells.withColumn("q", F.least(F.col("seats"), cap * F.col("m")))
    shift = hash32(F.concat(F.lit(f"{seed}-shift:"), F.col("rank").cast("string"), F.lit(":"), F.col("shard").cast("string")))
    cells = cut(cells.select("rank", "shard", "length", "m", F.expr("q div m").alias("passes"), (F.col("q") % F.col("m")).alias("rest"), shift.alias("shift")), "shard-quotas")

    before = W.partitionBy("rank", "shard").orderBy("mark", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    spans = placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("end", F.expr("start + size"))
    spans = spans.join(cells, ["rank", "shard"]).join(quotas.select("rank", "source_size", "target"), "rank")
    inside = f"""aggregate(
        sequence(((start + 1) * m - 1) div length, (end * m - 1) div length), 0L,
        (a, j) -> a + if((j * {STRIDE}L + shift) % m < rest, least(end, ((j + 1) * length) div m) - greatest(start, (j * length) div m), 0L))"""
    taken = F.when(F.col("size") > 0, F.col("passes") * F.col("size") + F.expr(inside)).otherwise(F.lit(0)).cast("bigint")
    return spans.select(F.col("id").alias(key), "size", "source", "source_size", "target", taken.alias("taken"), "shard")
