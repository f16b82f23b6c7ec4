"""Byte columns as MPEG transport streams: written with program tables, read back by demultiplexing.

A payload becomes 188-byte packets: a program association table, a program map table and packetised
elementary stream units with presentation times; every ``KEY_EVERY``-th unit starts with the random
access flag and a clock reference. Reading trusts nothing but the bytes: it checks sync bytes and
table checksums, follows the tables to the elementary stream, checks continuity counters, reassembles
the units and lists their times and random-access points.

Defined results: null payload counts as empty; an empty payload gives a stream with tables and no unit;
a lost or repeated packet shows in ``continuity_errors`` and its unit is left out as damaged; equal
payloads give equal streams; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import small_batches, with_fields

PACKET, SYNC, PAT_PID, PMT_PID, DATA_PID = 188, 0x47, 0x0000, 0x0100, 0x0101
PRIVATE_STREAM, PRIVATE_TYPE, CLOCK, FRAME = 0xBD, 0x06, 90_000, 3003
UNIT, KEY_EVERY = 2880, 4
UNITS = "array<struct<pts:bigint,packet:int,random_access:boolean,n_bytes:int,intact:boolean>>"


@lru_cache(maxsize=64)
def mpeg_crc(data: bytes) -> int:
    """The checksum of program tables: polynomial 0x04C11DB7, most significant bit first."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


@lru_cache(maxsize=64)
def table_packet(pid: int, table: int, number: int, body: bytes) -> bytes:
    """One packet that holds a whole program table section."""
    section = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    section += mpeg_crc(section).to_bytes(4, "big")
    head = bytes([SYNC]) + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00"
    return (head + section).ljust(PACKET, b"\xff")


def time_stamp(pts: int) -> bytes:
    """33-bit presentation time with its marker bits."""
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 1 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 1 | pts << 1 & 0xFE])


def tables() -> bytes:
    """The packets of the program association table and of the program map table."""
    programs = table_packet(PAT_PID, 0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
    return programs + table_packet(PMT_PID, 2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")


def write_stream(payload: bytes) -> bytes:
    """The transport stream of one payload."""
    out = [tables()]
    counter = 0
    first, later = (bytes([SYNC]) + (flag | DATA_PID).to_bytes(2, "big") for flag in (0x4000, 0))
    for n, at in enumerate(range(0, len(payload), UNIT)):
        data, pts = payload[at : at + UNIT], n * FRAME % 2**33
        pes = b"\x00\x00\x01" + bytes([PRIVATE_STREAM]) + (len(data) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + time_stamp(pts) + data
        extra = b""
        if n % KEY_EVERY == 0:
            extra = b"\x50" + ((pts << 15) | 0x7E00).to_bytes(6, "big")
        i, start = 0, True
        while i < len(pes):
            room = 184 - (1 + len(extra) if extra else 0)
            part = pes[i : i + room]
            i += len(part)
            field = extra
            if len(part) < room:  # the last packet of a unit is filled up inside the adaptation field
                gap = room - len(part)
                field = extra + b"\xff" * gap if extra else (b"\x00" + b"\xff" * (gap - 2) if gap > 1 else b"")
                body = bytes([len(field)]) + field + part
                control = 0x30
            else:
                body, control = (bytes([len(field)]) + field + part, 0x30) if field else (part, 0x10)
            out.append((first if start else later) + bytes([control | counter]) + body)
            counter, start, extra = (counter + 1) & 15, False, b""
    return b"".join(out)


def read_stream(stream: bytes) -> dict:
    """Payload, unit list and checks of one transport stream."""
    found = {"payload": b"", "units": [], "packets": len(stream) // PACKET, "continuity_errors": 0, "sync_errors": 0, "table_errors": 0, "data_pid": None}
    grid = np.frombuffer(stream, np.uint8, found["packets"] * PACKET).reshape(-1, PACKET)
    good = grid[:, 0] == SYNC
    found["sync_errors"] = int((~good).sum())
    pids = (grid[:, 1].astype(np.int32) & 0x1F) << 8 | grid[:, 2]

    def section(pid: int, table: int) -> bytes:
        for i in np.flatnonzero(good & (pids == pid) & (grid[:, 1] & 0x40 > 0)):
            body = grid[i, 5 + grid[i, 4] :].tobytes()
            size = (int.from_bytes(body[1:3], "big") & 0xFFF) + 3
            if body[0] == table and size <= len(body) and mpeg_crc(body[: size - 4]) == int.from_bytes(body[size - 4 : size], "big"):
                return body[8 : size - 4]
            found["table_errors"] += 1
        return b""

    programs = section(PAT_PID, 0)
    entries = [(int.from_bytes(programs[i : i + 2], "big"), int.from_bytes(programs[i + 2 : i + 4], "big") & 0x1FFF) for i in range(0, len(programs) - 3, 4)]
    streams = next((section(pid, 2) for number, pid in entries if number), b"")
    i = 4 + (int.from_bytes(streams[2:4], "big") & 0xFFF) if streams else 0
    while i + 5 <= len(streams):
        if streams[i] == PRIVATE_TYPE:
            found["data_pid"] = int.from_bytes(streams[i + 1 : i + 3], "big") & 0x1FFF
            break
        i += 5 + (int.from_bytes(streams[i + 3 : i + 5], "big") & 0xFFF)
    if found["data_pid"] is None:
        return found
    own = np.flatnonzero(good & (pids == found["data_pid"]) & (grid[:, 3] & 0x10 > 0))
    if not len(own):
        return found
    counters = grid[own, 3] & 15
    jump = np.concatenate([[False], (counters[1:] - counters[:-1]) & 15 != 1])
    found["continuity_errors"] = int(jump.sum())
    fields = grid[own, 3] & 0x20 > 0
    begin = np.where(fields, 5 + grid[own, 4].astype(np.int32), 4)
    access = fields & (grid[own, 4] > 0) & (grid[own, 5] & 0x40 > 0)
    starts = np.flatnonzero(grid[own, 1] & 0x40 > 0)
    parts = []
    for a, b in zip(starts, [*starts[1:], len(own)], strict=True):
        pes = b"".join(stream[p * PACKET + s : (p + 1) * PACKET] for p, s in zip(own[a:b].tolist(), begin[a:b].tolist(), strict=True))
        if len(pes) < 14 or pes[:3] != b"\x00\x00\x01":
            continue
        t, size = pes[9:14], int.from_bytes(pes[4:6], "big")
        pts = (t[0] & 0x0E) << 29 | t[1] << 22 | (t[2] & 0xFE) << 14 | t[3] << 7 | t[4] >> 1
        data = pes[9 + pes[8] : 6 + size]
        intact = len(pes) == 6 + size and not jump[a + 1 : b].any()
        found["units"].append({"pts": pts, "packet": int(own[a]), "random_access": bool(access[a]), "n_bytes": len(data), "intact": bool(intact)})
        if intact:
            parts.append(data)
    found["payload"] = b"".join(parts)
    return found


def store_media(df: DataFrame, payload: str = "payload", media: str = "media") -> DataFrame:
    """``df`` with the payload column replaced by its transport stream."""
    keep = [c for c in df.columns if c != payload]
    schema = with_fields(df.select(*keep).schema, f"`{media}` binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            streams = pa.array([write_stream(x or b"") for x in batch.column(len(keep)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], streams], names=[*keep, media])

    return df.select(*keep, payload).mapInArrow(work, schema)


def read_media(df: DataFrame, media: str = "media") -> DataFrame:
    """``df`` with ``payload``, ``units``, ``packets`` and the three error counts read from its streams."""
    schema = with_fields(df.schema, f"payload binary, units {UNITS}, packets int, continuity_errors int, sync_errors int, table_errors int")
    names = schema.fieldNames()
    at = df.columns.index(media)
    unit_type = pa.list_(pa.struct([("pts", pa.int64()), ("packet", pa.int32()), ("random_access", pa.bool_()), ("n_bytes", pa.int32()), ("intact", pa.bool_())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            got = [read_stream(x or b"") for x in batch.column(at).to_pylist()]
            columns = [pa.array([g["payload"] for g in got], pa.binary()), pa.array([g["units"] for g in got], unit_type)]
            columns += [pa.array([g[n] for g in got], pa.int32()) for n in names[-4:]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=names)

    return df.mapInArrow(work, schema)


def access_points(read: DataFrame, key: str) -> DataFrame:
    """One row per random-access point of ``read_media`` rows: key, packet number, seconds."""
    points = read.select(key, F.explode(F.filter("units", lambda u: u.random_access)).alias("u"))
    return points.select(key, F.col("u.packet").alias("packet"), (F.col("u.pts") / CLOCK).alias("seconds"))


def text_payload(text: str = "text", block: int = 192):
    """UTF-8 bytes of a text column, filled with blanks to a positive multiple of ``block`` bytes."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = F.octet_length(data)
    want = F.greatest(F.lit(block), F.ceil(size / block) * block)
    return F.concat(data, F.repeat(F.lit(" "), (want - size).cast("int")).cast("binary"))
