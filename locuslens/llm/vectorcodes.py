"""Vector code compression: a codebook per part of a vector, searched in order of component sums.

Components become the integers ``floor(4096 x)``, so every sum, mean and distance is exact and no result
depends on the order of rows. Vectors are cut into equal consecutive parts; each part position has a
codebook that starts as that part of the vectors of the smallest keys and is refined by rounds of
assignment and componentwise floor means.

The nearest entry is found by equal-average search: the entries are sorted by the sum of their
components, a part looks at the entries outward from its own sum, and stops when the squared gap of the
sums, divided by the dimension, strictly exceeds its best distance (by Cauchy-Schwarz no further entry can
be as near; at equality a tie could still go to a lower index). All parts of a batch walk together.

A round reads the integers once and sends one row per task, part and entry: its count and component
sums. Only the codebooks (``parts`` x ``entries`` x part length integers) pass through the driver.

Defined results: rows whose vector is null or holds null or non-finite components are left out; an
integer beyond 64 bits is the nearest one within; shorter vectors, and lengths that ``parts`` does not
divide, are filled up with zeros to the longest kept length, rounded up; fewer vectors than entries give
smaller codebooks; null keys come last among the smallest keys, equal keys go by their vector; repeated
rows count each; null labels are one label; an error beyond 64 bits is the greatest 64-bit integer; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import with_fields
from locuslens.session import cut

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers below this size have exact distances in 64 bits, for parts of up to 2,048 components.
SAFE = 1 << 25
MOST = (1 << 63) - 1

#: A codebook: entries by components, for one part position.
Book = np.ndarray


def integer_vectors(vectors: DataFrame, key: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """``key, label, ints`` of the rows with a whole finite vector."""
    sound = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return vectors.where(sound).select(F.col(key), F.col(label), ints.alias("ints"))


def part_matrix(column: pa.Array, length: int) -> np.ndarray:
    """A batch of integer lists as rows of ``length`` components, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == length).all():
        return flat.reshape(len(sizes), length)
    whole = np.zeros((len(sizes), length), np.int64)
    whole[np.arange(length) < sizes[:, None]] = flat
    return whole


def nearest(rows: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each row's nearest entry, ties to the lower index, by equal-average search.

    Rows and entries are 64-bit integers; large ones are computed with unbounded integers.
    """
    n, size = rows.shape
    if max((int(np.abs(x.astype(object)).max()) if len(x) and size and np.iinfo(np.int64).min in x else int(np.abs(x).max(initial=0)) for x in (rows, book))) >= SAFE:
        rows, book = rows.astype(object), book.astype(object)
    sums = book.sum(1) if size else np.zeros(len(book), np.int64)
    order = np.argsort(sums, kind="stable")
    sorted_sums, own = sums[order], rows.sum(1) if size else np.zeros(n, np.int64)
    best = np.full(n, -1, rows.dtype)  # -1: none yet
    index = np.full(n, len(book), np.int64)
    high = np.searchsorted(sorted_sums, own)  # next entry at or above the row's sum
    low = high - 1  # next entry below
    live = np.arange(n)
    while len(live):
        up, down = high[live], low[live]
        can_up, can_down = up < len(book), down >= 0
        gap_up = np.where(can_up, sorted_sums[np.minimum(up, len(book) - 1)] - own[live], 0)
        gap_down = np.where(can_down, own[live] - sorted_sums[np.maximum(down, 0)], 0)
        rise = can_up & (~can_down | (gap_up <= gap_down))
        gap = np.where(rise, gap_up, gap_down)
        open_ = (can_up | can_down) & ((best[live] < 0) | (gap * gap <= max(size, 1) * best[live]))
        live, rise, up, down = live[open_], rise[open_], up[open_], down[open_]
        if not len(live):
            break
        at = order[np.where(rise, up, down)]
        high[live] += rise
        low[live] -= ~rise
        apart = rows[live] - book[at]
        distance = (apart * apart).sum(1) if size else np.zeros(len(live), rows.dtype)
        better = (best[live] < 0) | (distance < best[live]) | ((distance == best[live]) & (at < index[live]))
        best[live[better]], index[live[better]] = distance[better], at[better]
    return index, best


def long_columns(books: list[Book], size: int) -> np.ndarray:
    return np.array([0, *(size * (i + 1) for i in range(len(books)))])


def part_sums(ints: DataFrame, books: list[Book], length: int) -> DataFrame:
    """``part, entry, n, at, total``: how many parts each entry is nearest to, and their component sums, over all rows."""
    size = length // len(books)
    half = 1 << 32  # sums of the low and of the high halves, so that no 64-bit total overflows within a batch

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros((len(b), size), object) for b in books]
        for batch in batches:
            rows = part_matrix(batch.column(0), length)
            for i, book in enumerate(books):
                part = rows[:, i * size : (i + 1) * size]
                index, _ = nearest(part, book)
                for e in np.unique(index):
                    mine = part[index == e]
                    count[i][e] += len(mine)
                    total[i][e] += (mine >> 32).sum(0).astype(object) * half + (mine & (half - 1)).sum(0).astype(object)
        found = [(i, int(e), int(count[i][e]), at, Decimal(int(total[i][e, at]))) for i in range(len(books)) for e in np.flatnonzero(count[i]) for at in range(size)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.decimal128(38, 0)), strict=True)], names=["part", "entry", "n", "at", "total"])

    sums = ints.select("ints").mapInArrow(work, "part int, entry int, n bigint, at int, total decimal(38,0)")
    return sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def fit_codebooks(ints: DataFrame, key: str, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Book]:
    """Codebooks of all part positions after ``rounds`` of assignment and floor means."""
    first = ints.orderBy(F.col(key).asc_nulls_last(), "ints").limit(entries).select("ints").collect()  # at most ``entries`` rows
    start = np.zeros((len(first), length), np.int64)
    for row, r in zip(start, first, strict=True):
        row[: len(r.ints)] = r.ints
    books = [part.copy() for part in np.split(start, parts, axis=1)]
    for _ in range(rounds):
        for r in part_sums(ints, books, length).collect():  # one row per entry component
            books[r.part][r.entry, r["at"]] = int(r.total) // r.n
    return books


def assign_codes(ints: DataFrame, key: str, label: str, books: list[Book], length: int) -> DataFrame:
    """``key, label, code, error`` of every row: hexadecimal entry indexes in part order, and the summed squared distance."""
    size, parts = length // len(books), len(books)
    schema = with_fields(ints.select(key, label).schema, "code string, error bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = part_matrix(batch.column(2), length)
            found = [nearest(rows[:, i * size : (i + 1) * size], book) for i, book in enumerate(books)]
            digits = np.stack([index for index, _ in found], 1).astype(np.uint8).tobytes().hex()
            error = [min(int(e), MOST) for e in sum(d.astype(object) for _, d in found)]
            codes = [digits[i * 2 * parts : (i + 1) * 2 * parts] for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=schema.fieldNames())

    return ints.select(key, label, "ints").mapInArrow(work, schema)


def books_digest(books: list[Book]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.flat).encode()).hexdigest()


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256, label`` per kept row; ``entries`` up to 256."""
    ints = cut(integer_vectors(vectors, key, vector, label), "integer-vectors")
    longest = ints.agg(F.max(F.size("ints")).alias("n")).head().n or 0
    length = -(-longest // parts) * parts
    books = fit_codebooks(ints, key, length, parts, entries, rounds)
    coded = cut(assign_codes(ints, key, label, books, length), "codes")
    # one row per label; a frequent label is summed before it travels, and its join partition is split
    greatest = F.lit(MOST).cast("decimal(38,0)")
    sums = cut(coded.groupBy(F.col(label).alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), greatest).cast("bigint").alias("label_error")), "label-errors")
    joined = coded.join(sums, F.col(label).eqNullSafe(F.col("_label")))
    return joined.select(key, "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"), label)
