"""Packing documents into training sequences: shortest-pack-first over the length histogram.

Documents become token identifiers with one end identifier, and are cut into pieces of a whole sequence
and one rest. The histogram of piece lengths, at most ``capacity`` numbers whatever the input, is packed
on the driver: lengths are placed longest first, each into the emptiest open pack that still fits, and a
pack is not one sequence but a pattern with a count, so a step moves any number of sequences at once. The
patterns are listed as slots: for a length, so many places from a first sequence on, at an offset. Pieces
are ranked among the pieces of their length and meet their slot by rank.

Ranks need no sort: a task numbers its own pieces of each length as it writes them, and the counts of the
tasks give the offsets. There are at most two patterns per length and ``capacity`` slots per pattern's
sequence, so the table of slots is bounded by ``capacity`` and broadcast.

Defined results: null and empty texts are the end identifier alone; null and repeated keys are packed row
by row; an empty table gives an empty result; the text of the vocabulary's special token is that token, as
the tokenizer library reads it; further columns are ignored. Which of several equally long pieces shares a
sequence with which others follows the order of the input's rows.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm.common import small_batches, with_fields
from locuslens.session import cut

#: Ranks of the vocabulary of ``byte_bpe_50k.json``; they give the same identifiers several times as fast.
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
CAPACITY, END = 2048, 1

#: A pattern: how many sequences have it, and its lengths with their multiplicities, longest first.
Pattern = tuple[int, list[tuple[int, int]]]


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    """One per Python worker; ``vocabulary`` is a file name of the tokenizer package."""
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` identifiers: whole sequences, then the rest."""
    return [(at, min(capacity, n - at)) for at in range(0, n, capacity)]


def pieces(docs: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, task, place`` per piece; ``place`` counts the pieces of a length in a task."""
    schema = with_fields(docs.select(key).schema, "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, place bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = tokenizer(vocabulary).encode_to_numpy, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in small_batches(batches):
            owner, rows = [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(value, allowed_special="all") if value else [], end).astype("<u4")
                for start, length in cut_points(len(ids), capacity):
                    owner.append(i)
                    rows.append((start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), task, int(seen[length])))
                    seen[length] += 1
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), [pa.field("", t) for t in (pa.int64(),) * 4 + (pa.int32(), pa.int64())], strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *columns], names=schema.fieldNames())

    return docs.select(key, text).mapInArrow(work, schema)


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of ``counts`` (length: number), by shortest pack first."""
    open_: dict[int, list[Pattern]] = {}  # by used space
    done: list[Pattern] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            used = min((s for s in open_ if s + length <= capacity), default=None)
            if used is None:
                count, lengths = left, []
                used = 0
            else:
                count, lengths = open_[used].pop()
                if not open_[used]:
                    del open_[used]
            moved = min(count, left)
            if moved < count:
                open_.setdefault(used, []).append((count - moved, lengths))
            last = lengths[-1] if lengths else (0, 0)
            grown = [*lengths[:-1], (length, last[1] + 1)] if last[0] == length else [*lengths, (length, 1)]
            (done if used + length == capacity else open_.setdefault(used + length, [])).append((moved, grown))
            left -= moved
    return done + [pattern for used in sorted(open_, reverse=True) for pattern in open_[used]]


def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """``length, first_rank, places, first_sequence, times, at``: the places for pieces of a length in each pattern."""
    given: Counter[int] = Counter()
    out, sequence = [], 0
    for count, lengths in patterns:
        at = 0
        for length, times in lengths:
            out.append((length, given[length], count * times, sequence, times, at))
            given[length] += count * times
            at += length * times
        sequence += count
    return out


def padding(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[int, int]:
    """Filling and sequences of a packing; a sequence whose length is a power of two is not filled up."""
    sizes = [(count, sum(length * times for length, times in lengths)) for count, lengths in pack_histogram(counts, capacity)]
    return sum(count * (capacity - size) for count, size in sizes if size & (size - 1)), sum(count for count, _ in sizes)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece of ``docs``."""
    spark = docs.sparkSession
    written = cut(pieces(docs, key, text, vocabulary, capacity, end), "pieces")
    counts = cut(written.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = spark.createDataFrame(slots(pack_histogram(histogram, capacity)), "_length bigint, first_rank bigint, places bigint, first_sequence bigint, times bigint, at bigint")
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # the offsets grow with the tasks and compress so well that their files look smaller than they are: never broadcast
    ranks = written.join(counts.select("length", "task", before.alias("before")).hint("merge"), ["length", "task"]).withColumn("_rank", F.col("before") + F.col("place"))
    # bounded by the capacity, whatever the input
    own = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("places"))
    place = F.col("_rank") - F.col("first_rank")
    sequence = F.col("first_sequence") + F.floor(place / F.col("times"))
    return ranks.join(F.broadcast(table), own).select(key, "start", "length", "ids_crc32", "doc_tokens", sequence.cast("bigint").alias("sequence_id"), (F.col("at") + place % F.col("times") * F.col("length")).alias("offset"))
