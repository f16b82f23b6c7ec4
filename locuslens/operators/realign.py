"""Global affine alignment of reads to reference slices, with the path as a CIGAR.

Scores are those of the classifier's aligner: a match, a mismatch (ambiguous bases have their own), a gap's
first and each further base; gaps at the ends cost the same, and a gap of one kind never follows one of the
other without a base between them. Among equally good paths the one that matches earliest, seen from the
end, is taken, so gaps stand as far left as they can.

Pairs of one batch are aligned together, a read base at a time over whole reference slices: gaps along
the reference are a running maximum of scores freed from the extension cost. Each cell keeps where it came
from in four bits; with very long pairs only every so many rows are kept and the rows between them are
computed again on the way back, so memory does not grow with the product of both lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH, MISMATCH, UNKNOWN, BOTH_UNKNOWN, OPEN, EXTEND = 5, -4, -2, -1, -10, -1
NEVER = np.int32(-(10**9))
#: Cells whose origins are held at once, over all pairs of a batch.
CELLS = 1 << 25
#: Bits of a cell's origin: where its match came from (two bits), and whether a gap is opened there.
FROM_INSERTION, FROM_DELETION, OPENS_INSERTION, OPENS_DELETION = 1, 2, 4, 8

Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def codes(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), max(map(len, texts), default=0)), np.uint8)
    for row, text in zip(out, texts, strict=True):
        row[: len(text)] = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    return out


class Batch:
    """Score rows of several pairs: ``match``, ``insertion`` (read base without reference) and ``deletion`` after each read base."""

    def __init__(self, slices: list[str], reads: list[str]) -> None:
        self.t, self.q = codes(slices), codes(reads)
        self.n, self.width = self.t.shape
        self.known = (self.t != ord("N"))
        self.steps = np.arange(self.width + 1, dtype=np.int32) * np.int32(EXTEND)

    def first(self) -> Rows:
        match = np.full((self.n, self.width + 1), NEVER, np.int32)
        match[:, 0] = 0
        deletion = np.full_like(match, NEVER)
        deletion[:, 1:] = OPEN + self.steps[:-1]
        return match, np.full_like(match, NEVER), deletion

    def after(self, rows: Rows, y: int, origin: np.ndarray | None = None) -> Rows:
        """Rows after read base ``y``; ``origin`` receives where each cell came from."""
        match, insertion, deletion = rows
        base = self.q[:, y : y + 1]
        score = np.where(self.t == base, np.int32(MATCH), np.int32(MISMATCH))
        unknown = base == ord("N")
        score = np.where(unknown | ~self.known, np.where(unknown & ~self.known, np.int32(BOTH_UNKNOWN), np.int32(UNKNOWN)), score)
        came = np.maximum(np.maximum(match, insertion), deletion)[:, :-1]
        new = np.full_like(match, NEVER)
        new[:, 1:] = came + score
        opened, longer = match + OPEN, insertion + EXTEND
        if origin is not None:
            origin[:, 1:] = np.where(match[:, :-1] == came, 0, np.where(insertion[:, :-1] == came, FROM_INSERTION, FROM_DELETION))
            origin |= np.where(opened >= longer, OPENS_INSERTION, 0).astype(np.uint8)
        insertion = np.maximum(opened, longer)
        free = np.maximum.accumulate(new[:, :-1] - self.steps[:-1], axis=1)
        deletion = np.full_like(match, NEVER)
        deletion[:, 1:] = free + self.steps[:-1] + OPEN
        if origin is not None:
            origin[:, 1:] |= np.where(new[:, :-1] + OPEN >= deletion[:, 1:], OPENS_DELETION, 0).astype(np.uint8)
        return new, np.maximum(insertion, NEVER), np.maximum(deletion, NEVER)


def path(origin_row: Iterator[np.ndarray], state: str, x: int) -> list[tuple[str, int]]:
    """Operations from the end to the start; ``origin_row`` gives the rows of cell origins from the last one back."""
    ops: list[tuple[str, int]] = []
    for row in origin_row:
        while state == "D":
            # back along the reference to where the gap was opened, at once
            start = x - int(np.argmax((row[x:0:-1] & OPENS_DELETION) > 0))
            ops.append(("D", x - start + 1))
            x, state = start - 1, "M"
        if state == "I":
            ops.append(("I", 1))
            state = "M" if row[x] & OPENS_INSERTION else "I"
        else:
            ops.append(("M", 1))
            state = "MID"[row[x] & 3]
            x -= 1
    return ops + ([("D", x)] if x else [])


def align_globally(slices: list[str], reads: list[str], cells: int = CELLS) -> list[str]:
    """The CIGAR of each read on its slice, without the reference bases that only stand before or behind it."""
    batch = Batch(slices, reads)
    height = batch.q.shape[1]
    step = max(1, min(height, cells // max(1, batch.n * (batch.width + 1))))
    kept, ends, rows = {0: batch.first()}, {}, batch.first()
    sizes = [len(r) for r in reads]
    for y in range(height):
        rows = batch.after(rows, y)
        if (y + 1) % step == 0:
            kept[y + 1] = rows
        for i in (i for i, size in enumerate(sizes) if size == y + 1):
            ends[i] = [int(r[i, len(slices[i])]) for r in rows]
    held: dict[int, np.ndarray] = {}

    def origins(y: int) -> np.ndarray:
        """Origins of row ``y``, from the kept row before it."""
        block = y // step
        if block not in held:
            held.clear()
            held[block] = np.zeros((min(step, height - block * step), batch.n, batch.width + 1), np.uint8)
            again = kept[block * step]
            for at, origin in enumerate(held[block]):
                again = batch.after(again, block * step + at, origin)
        return held[block][y - block * step]

    out = []
    for i, size in enumerate(sizes):
        if not size:
            out.append("")
            continue
        state = "MID"[int(np.argmax(ends[i]))]
        ops = path((origins(y)[i] for y in range(size - 1, -1, -1)), state, len(slices[i]))[::-1]
        runs = [(op, sum(n for _, n in run)) for op, run in groupby(ops, key=lambda o: o[0])]
        runs = runs[runs[0][0] == "D" :]
        runs = runs[: len(runs) - (runs[-1][0] == "D")]
        out.append("".join(f"{n}{op}" for op, n in runs))
    return out


def realigned(wanted: DataFrame, slice_: str = "slice", seq: str = "seq", out: str = "realigned", batch: int = 64) -> DataFrame:
    """Distinct ``slice, seq`` of ``wanted`` with ``out``, the read's CIGAR on the slice."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # like lengths together; a batch holds many short pairs or few long ones
            order = frame.iloc[np.argsort(frame[slice_].str.len().to_numpy(), kind="stable")]
            at = 0
            while at < len(order):
                longest, size = 0, 0
                while at + size < len(order) and size < batch and (not size or (size + 1) * max(longest, len(order[slice_].iat[at + size])) <= 1 << 20):
                    longest, size = max(longest, len(order[slice_].iat[at + size])), size + 1
                part = order.iloc[at : at + size]
                yield part.assign(**{out: align_globally(list(part[slice_]), list(part[seq]))})
                at += size

    # few bytes but much work: adaptive execution would put them in one task
    # (dealt by the columns of the distinct rows, the exchange would be dropped where both have as many partitions)
    distinct = wanted.select(slice_, seq).distinct().repartition(4 * wanted.sparkSession.sparkContext.defaultParallelism, F.xxhash64(slice_, seq))
    return distinct.mapInPandas(work, f"{slice_} string, {seq} string, {out} string")
