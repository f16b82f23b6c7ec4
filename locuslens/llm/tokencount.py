"""Token counts per document from flat token files, found by scanning for separators.

``write_flat`` tokenises documents and lays their identifiers end to end, each followed by the
end-of-document identifier, in fixed-size blocks without an index (one flat file per input partition;
a manifest keeps the order of the documents). ``separator_scan`` knows only the blocks: every block is
searched as one vector, and an exclusive prefix scan over block summaries (separators so far, end of
the last document) stitches documents that cross blocks, however many.

Defined results: null and empty texts have 0 tokens; identifiers after the last separator of a file
form one unfinished document (``complete`` false); repeated rows count separately; the text of a special
token in a document is ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import prefix_scan, small_batches, with_fields
from locuslens.session import cut

VOCABULARY, SEPARATOR = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50256
#: Splitting pattern of the vocabulary (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_BYTES = 1 << 16


@lru_cache(maxsize=2)
def encoder(path: str):
    """A tokenizer from a public rank file; one per Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def write_flat(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, separator: int = SEPARATOR, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(blocks, manifest)``: blocks hold little-endian 16-bit identifiers; both come from one written table."""
    schema = with_fields(docs.select(key).schema, "file_id int, number bigint, payload binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, encode = TaskContext.get().partitionId(), encoder(vocabulary).encode_ordinary
        held, size, block, document = [], 0, 0, 0
        end = np.array([separator], "<u2").tobytes()

        def out(ids: pa.Array, numbers: list[int], payloads: list[bytes | None]) -> pa.RecordBatch:
            n = len(numbers)
            return pa.RecordBatch.from_arrays([ids, pa.array([own] * n, pa.int32()), pa.array(numbers, pa.int64()), pa.array(payloads, pa.binary())], names=[key, "file_id", "number", "payload"])

        for batch in small_batches(batches):
            none = batch.column(0).type
            yield out(batch.column(0), list(range(document, document + batch.num_rows)), [None] * batch.num_rows)
            document += batch.num_rows
            for value in batch.column(1).to_pylist():
                held.append((np.array(encode(value), "<u2").tobytes() if value else b"") + end)
                size += len(held[-1])
            if size >= block_bytes:
                flat = b"".join(held)
                full = size - size % block_bytes
                parts = [flat[i : i + block_bytes] for i in range(0, full, block_bytes)]
                yield out(pa.nulls(len(parts), none), list(range(block, block + len(parts))), parts)
                block += len(parts)
                held, size = [flat[full:]], size - full
        if size:
            yield out(pa.nulls(1, none), [block], [b"".join(held)])

    written = cut(docs.select(key, text).mapInArrow(work, schema), "flat-tokens", "zstd")
    blocks = written.where(F.col("payload").isNotNull()).select("file_id", F.col("number").alias("block_no"), "payload")
    return blocks, written.where(F.col("payload").isNull()).select(key, "file_id", F.col("number").alias("ordinal"))


def separator_scan(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """``file_id, ordinal, n_tokens, complete`` of every document in ``blocks (file_id, block_no, payload)``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 64):
            found, sizes = [], []
            for payload in batch.column(2).to_pylist():
                ids = np.frombuffer(payload or b"", "<u2")
                found.append(np.flatnonzero(ids == separator).astype(np.int32))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["file_id", "block_no", "size", "at"])

    found = cut(blocks.select("file_id", "block_no", "payload").mapInArrow(search, "file_id int, block_no bigint, size bigint, at array<int>"), "separators")
    sized = prefix_scan(found.select("file_id", "block_no", "size", F.size("at").cast("bigint").alias("n"), F.when(F.size("at") > 0, F.element_at("at", -1)).alias("last")), "file_id", "block_no", sums=("size", "n"))
    ends = sized.withColumn("end", F.coalesce(F.col("size_before") + F.col("last") + 1, F.lit(0)))
    stitched = prefix_scan(ends, "file_id", "block_no", maxima=("end",)).select("file_id", "block_no", "size_before", "n_before", "end_before")
    rows = stitched.join(found.where(F.size("at") > 0), ["file_id", "block_no"])
    lengths = F.transform("at", lambda x, i: F.when(i == 0, x.cast("bigint") + F.col("size_before") - F.col("end_before")).otherwise(x.cast("bigint") - F.element_at(F.col("at"), F.greatest(i, F.lit(1))) - 1))
    whole = rows.select("file_id", "n_before", F.posexplode(lengths).alias("i", "n_tokens")).select("file_id", (F.col("n_before") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("complete"))
    tails = ends.groupBy("file_id").agg(F.sum("n").alias("ordinal"), (F.sum("size") - F.max("end")).alias("n_tokens")).where("n_tokens > 0")
    return whole.unionByName(tails.withColumn("complete", F.lit(False)))


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens`` for every row of ``docs``, read from the flat files alone."""
    blocks, manifest = write_flat(docs, key, text, vocabulary)
    return manifest.join(separator_scan(blocks), ["file_id", "ordinal"]).select(key, "n_tokens", "file_id", "ordinal")
