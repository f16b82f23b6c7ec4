"""Merkle dataset manifest: a postorder append log per source, addressed by closed-form positions.

Rows become leaves; the leaves of a source, in the order of their keys, form a tree of ``ARITY`` children
a node (the last run of a level may have fewer, even one), and the roots of the sources form one more such
tree. A tree is kept as a log of its nodes in the order in which they are complete. Where a node stands
there follows from sizes alone: the complete nodes left of its first leaf, plus its own subtree. So no
node stores links, and the siblings of a proof are found by arithmetic.

Builders work on aligned blocks of ``ARITY ** SPAN`` nodes of one level: a builder reads them in order,
appends each node when its last child is there, and hands one block root on; blocks of block roots come
next, so the number of passes is the tree's height divided by ``SPAN``, and no task sees more than a block
of a tree at once, however many rows a source has. Proofs come down the same way: a block gets the path of
its root and its part of the log, and each of its nodes the siblings at the computed positions.

Leaves are numbered by a range sort whose partition sizes give the offsets. Every pass is written.

Defined results: a null field is ``-``; null keys come first, equal keys go by their leaf; repeated rows
are leaves of their own; the null source is one source, first of all; rows with a null key are never
tampered with; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from locuslens.llm.common import with_fields
from locuslens.session import cut

ARITY, SPAN = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    """SHA-256 of the concatenated texts, in lower-case hexadecimal."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: tuple[str, ...], instead: dict[str, Column] | None = None) -> Column:
    """Digest of a row: each field as its byte count, ``:`` and its value."""
    text = lambda c: (instead or {}).get(c, F.col(c)).cast("string")
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in fields)), 256)


@dataclass(frozen=True)
class Shape:
    """Closed forms of a tree of ``n`` leaves."""

    n: int
    arity: int = ARITY

    def height(self) -> int:
        level, reach = 0, 1
        while reach < self.n:
            level, reach = level + 1, reach * self.arity
        return level

    def width(self, level: int) -> int:
        """Nodes of a level."""
        return -(-self.n // self.arity**level)

    def position(self, level: int, index: int) -> int:
        """Where node ``index`` of ``level`` stands in the postorder log: after all nodes complete before its first leaf, at the end of its own subtree."""
        first = index * self.arity**level
        below = min(self.arity**level, self.n - first)
        before, unit = 0, 1
        while unit <= first:
            before, unit = before + first // unit, unit * self.arity
        return before + sum(-(-below // self.arity**j) for j in range(level + 1)) - 1

    def run(self, level: int, index: int) -> range:
        """Indexes of the run of ``level`` that ``index`` is in."""
        start = index - index % self.arity
        return range(start, min(start + self.arity, self.width(level)))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``rank``: 0, 1, ... in ``order``; rows are sorted by ranges and ranges placed by their sizes."""
    rows = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).alias("_part")
    sizes = rows.groupBy(part).agg(F.count("*").alias("_n"))  # one row per task
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")


def by_block(rows: DataFrame, order: list[str], work: Callable, schema: str) -> DataFrame:
    """``work`` over rows ``(tree, block, ...)`` that come block by block, inside a block in ``order``."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order).mapInArrow(work, schema)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block; a block has at most a bounded number."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


NODE, PATH = "tree bigint, n bigint, level int, idx bigint, pos bigint, digest string", "tree bigint, n bigint, idx bigint, path array<string>"
NODES = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("pos", pa.int64()), ("digest", pa.string())])
PATHS = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("idx", pa.int64()), ("path", pa.list_(pa.string()))])


def append_nodes(leaves: DataFrame, base: int, span: int, arity: int) -> DataFrame:
    """Nodes of the levels ``base`` (if 0) to ``base + span`` over ``leaves (tree, n, idx, digest)`` of level ``base``, in log order within a block."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            shape = Shape(block[0]["n"], arity)
            top, log = min(base + span, shape.height()), []
            runs: list[list[str]] = [[] for _ in range(top + 1)]

            def append(level: int, index: int, value: str) -> None:
                log.append((block[0]["tree"], shape.n, level, index, shape.position(level, index), value))
                if level < top:
                    runs[level].append(value)
                    if index + 1 == shape.run(level, index).stop:
                        children, runs[level] = runs[level], []
                        append(level + 1, index // arity, digest(*children))

            for row in block:
                append(base, row["idx"], row["digest"])
            if base:
                log = [node for node in log if node[2] > base]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*log, strict=True), NODES, strict=True)], schema=NODES)

    cells = leaves.withColumn("block", F.floor(F.col("idx") / arity**span))
    return by_block(cells.select("tree", "block", "n", "idx", "digest"), ["idx"], work, NODE)


def build(leaves: DataFrame, name: str, arity: int = ARITY, span: int = SPAN) -> list[DataFrame]:
    """Logs of all trees of ``leaves (tree, n, idx, digest)``, one DataFrame per pass of builders, lowest first."""
    passes, base = [], 0
    while not passes or not leaves.isEmpty():
        passes.append(cut(append_nodes(leaves, base, span, arity), f"{name}-log"))
        base += span
        leaves = passes[-1].where((F.col("level") == base) & (F.col("n") > arity**base)).select("tree", "n", "idx", "digest")
    return passes


def roots(passes: list[DataFrame], arity: int = ARITY) -> DataFrame:
    """``tree, n, digest`` of every root: the only node of its level."""
    every = passes[0]
    for more in passes[1:]:
        every = every.union(more)
    above = F.expr(f"level = 0 and n = 1 or n > cast(power({arity}, level - 1) as bigint) and n <= cast(power({arity}, level) as bigint)")
    return every.where((F.col("idx") == 0) & above).select("tree", "n", "digest")


def proofs(passes: list[DataFrame], tops: DataFrame, leaves: DataFrame | None, work: Callable, schema: str, arity: int = ARITY, span: int = SPAN) -> DataFrame:
    """``work``'s rows for all leaves: it gets each leaf with its sibling path.

    ``tops (tree, path)`` holds what follows a tree's root: digests left and right of it, level by level.
    ``leaves (tree, idx, n, ...)`` are rows that want a path; if None, each leaf of the log does.
    """
    upper = None
    for base in range((len(passes) - 1) * span, -1, -span):
        # the nodes of a block: those of level ``base``, from the pass below, and the ones above them but the block's root
        nodes = (passes[0] if not base else passes[base // span - 1].where(F.col("level") == base).union(passes[base // span].where(F.col("level") > base))).where(F.col("level") < base + span)
        here = F.lit(True) if not base else F.col("n") > arity**base  # trees that reach this pass
        inside = nodes.where(here).withColumn("block", F.floor(F.col("idx") / F.pow(F.lit(float(arity)), F.lit(base + span) - F.col("level"))).cast("bigint"))
        inside = inside.select("tree", "block", "n", F.lit(1).alias("kind"), "pos", "idx", "level", "digest")
        lowest = arity ** (base + span)
        sizes = passes[0].where("level = 0 and idx = 0").select("tree", "n")
        first = tops.join(sizes, "tree").where(here & (F.col("n") <= lowest)).select("tree", F.lit(0).cast("bigint").alias("block"), "n", F.lit(0).alias("kind"), "path")
        above = first if upper is None else first.unionByName(upper.select("tree", F.col("idx").alias("block"), "n", F.lit(0).alias("kind"), "path"))
        rows = above.unionByName(inside, allowMissingColumns=True)
        if not base and leaves is not None:
            wanted = leaves.withColumns({"block": F.floor(F.col("idx") / arity**span), "kind": F.lit(2)})
            rows = rows.unionByName(wanted, allowMissingColumns=True)
        last = not base
        task = work if last else paths
        rows = by_block(rows, ["kind", "pos", "idx"], along(base, span, arity, leaves is not None and last, task), schema if last else PATH)
        if last:
            return rows
        upper = cut(rows, "block-paths")
    raise AssertionError("a log has at least one pass")


def paths(rows: Iterator[tuple[dict, list[str]]]) -> pa.RecordBatch:
    """The paths themselves."""
    return pa.RecordBatch.from_pylist([{"tree": row["tree"], "n": row["n"], "idx": row["idx"], "path": path} for row, path in rows], PATHS)


def along(base: int, span: int, arity: int, given: bool, task: Callable) -> Callable:
    """A task over blocks: finds the siblings of each wanted node by their positions and adds the block's own path."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            shape = Shape(block[0]["n"], arity)
            top = min(base + span, shape.height())
            onward = block[0]["path"]
            log = {row["pos"]: row["digest"] for row in block if row["kind"] == 1}
            found: dict[tuple[int, int], list[str]] = {}

            def siblings(level: int, index: int) -> list[str]:
                """Concatenated digests left and right of a node in its run."""
                if (level, index) not in found:
                    run = shape.run(level, index)
                    side = lambda indexes: "".join(log[shape.position(level, i)] for i in indexes)
                    found[level, index] = [side(range(run.start, index)), side(range(index + 1, run.stop))]
                return found[level, index]

            def path(index: int) -> list[str]:
                return [x for level in range(base, top) for x in siblings(level, index // arity ** (level - base))] + onward

            wanted = [row for row in block if (row["kind"] == 2 if given else row["kind"] == 1 and row["level"] == base)]
            if wanted:
                yield task((row, path(row["idx"])) for row in wanted)

    return work


def fold(start: str, path: list[str]) -> str:
    """The root that a leaf and its sibling path give."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        start = digest(left, start, right)
    return start


def manifest(docs: DataFrame, key: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, tampered: dict[str, Column] | None = None, arity: int = ARITY, span: int = SPAN) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Leaves of all rows ``(key, _source, leaf, changed, tree, n, idx)``, the sources ``(_source, tree, n)``, and the logs of the source trees.

    ``changed`` is the leaf of the row with ``tampered`` columns in place of its own.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), leaf(fields).alias("leaf"), leaf(fields, tampered).alias("changed")).withColumn("_copy", F.monotonically_increasing_id())
    order = [F.col("_source").asc_nulls_first(), F.col("_key").asc_nulls_first(), F.col("leaf"), F.col("_copy")]
    placed = cut(ranked(cut(rows, "leaf-rows"), order, "sorted-leaves").drop("_copy"), "ranked-leaves")
    counted = placed.groupBy("_source").agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    sources = cut(ranked(counted, [F.col("_source").asc_nulls_first()], "sorted-sources").withColumnRenamed("rank", "tree"), "sources")
    own = placed.join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
    leaves = cut(own.select("_key", "_source", "leaf", "changed", "tree", "n", (F.col("rank") - F.col("first")).alias("idx")), "leaves")
    return leaves, sources, build(leaves.select("tree", "n", "idx", F.col("leaf").alias("digest")), "source", arity, span)


def prove(docs: DataFrame, key: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, tampered: dict[str, Column] | None = None, arity: int = ARITY, span: int = SPAN) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of ``docs``."""
    leaves, sources, logs = manifest(docs, key, source, fields, tampered, arity, span)
    total = sources.count()
    subroots = cut(roots(logs, arity).select("tree", F.col("digest").alias("subroot")), "subroots")
    top = build(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(total).cast("bigint").alias("n"), F.col("tree").alias("idx"), F.col("subroot").alias("digest")), "top", arity, span)
    root = roots(top, arity).head()  # one row
    root = root.digest if root else None
    none = docs.sparkSession.createDataFrame([(0, [])], "tree bigint, path array<string>")
    tops = cut(proofs(top, none, None, paths, PATH, arity, span).select(F.col("idx").alias("tree"), "path"), "source-paths")
    given = leaves.select("tree", "n", "idx", F.col("_key").alias("key"), "leaf", "changed").join(subroots, "tree")

    def check(rows: Iterator[tuple[dict, list[str]]]) -> pa.RecordBatch:
        out = []
        for row, path in rows:
            folded = fold(row["changed"], path)
            out.append({"key": row["key"], "leaf": row["leaf"], "subroot": row["subroot"], "root": root, "proof_sha256": digest(*path), "folded_root": folded, "verified": folded == root})
        return pa.RecordBatch.from_pylist(out, result)

    texts = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    result = pa.schema([("key", to_arrow_type(docs.schema[key].dataType)), *((c, pa.string()) for c in texts), ("verified", pa.bool_())])
    schema = with_fields(leaves.select(F.col("_key").alias("key")).schema, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proofs(logs, tops, given, check, schema, arity, span).withColumnRenamed("key", key)


def without_newlines(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """Tampering that deletes the line feeds of a text where 2 divides the CRC-32 of the decimal key."""
    even = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return {text: F.when(even, F.translate(F.col(text), "\n", "")).otherwise(F.col(text))}
