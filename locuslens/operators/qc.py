"""Read quality: base content and quality per position, adapter hits, over-represented sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions of a block of counters, byte values of a position, and blocks that a task holds before it gives them out.
BLOCK, CODES, HELD = 1024, 256, 64


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch's texts and their positions inside their text; nulls have none."""
    texts = column.drop_null()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return codes, np.arange(len(codes)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))


def position_counts(reads: DataFrame, column: str) -> DataFrame:
    """``pos, code, n``: how many texts have each byte at each position; texts are ASCII.

    A task adds whole batches to counters of fixed length, blocks of positions by byte values, and gives out only
    those above zero, so what is shuffled follows the length of a read and not the number of bases.
    """

    def rows(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
        cells = [(b * BLOCK + at // CODES, at % CODES, n[at]) for b, n in blocks.items() for at in np.flatnonzero(n)]
        pos, code, count = (np.array(c, np.int64) for c in zip(*cells, strict=True)) if cells else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(pos), pa.array(code.astype(np.int32)), pa.array(count)], names=["pos", "code", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            codes, pos = flat_text(batch.column(0))
            cell = pos * CODES + codes
            for b in np.unique(pos // BLOCK):
                own = cell if len(pos) and pos.max() < BLOCK else cell[pos // BLOCK == b]
                count = np.bincount(own - b * BLOCK * CODES, minlength=BLOCK * CODES)
                blocks[b] = blocks[b] + count if b in blocks else count
            if len(blocks) > HELD:  # very long reads
                yield rows(blocks)
                blocks = {}
        yield rows(blocks)

    parts = reads.select(F.col(column).cast("string")).mapInArrow(work, "pos bigint, code int, n bigint")
    return parts.groupBy("pos", "code").agg(F.sum("n").alias("n"))


def base_content(reads: DataFrame) -> DataFrame:
    """Reads with each base at each position."""
    return position_counts(reads, "seq").select("pos", F.char("code").alias("base"), "n")


def quality(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Count, total, least and greatest quality at each position."""
    q = (F.col("code") - offset).cast("bigint")
    counts = position_counts(reads, "quality").select("pos", q.alias("q"), "n")
    return counts.groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("q") * F.col("n")).alias("total"), F.min("q").alias("low"), F.max("q").alias("high"))


def adapter_hits(reads: DataFrame, adapter: str = "AGATCGGAAGAGC") -> DataFrame:
    """Reads per file whose sequence holds the adapter, by its first position."""
    at = F.instr("seq", F.lit(adapter))
    return reads.where(at > 0).groupBy("file", at.cast("bigint").alias("at")).agg(F.count("*").alias("n"))


def overrepresented(reads: DataFrame, share: float = 0.001, length: int | None = None) -> DataFrame:
    """Sequences, or their first ``length`` bases, that make up at least ``share`` of all reads."""
    start = F.col("seq") if length is None else F.substring("seq", 1, length)
    counts = reads.groupBy(start.alias("start")).agg(F.count("*").alias("n"))
    total = reads.agg(F.count("*").alias("total"))  # one row
    return counts.join(F.broadcast(total), F.col("n") >= share * F.col("total")).select("start", "n")
