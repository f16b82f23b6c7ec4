"""What CIGAR strings say, read once per distinct string of a batch.

The patterns are those of ``dna``; there each is a column expression, which costs microseconds a row where a dozen of them
meet in one plan. Reads share few CIGARs, so here a batch's distinct ones are parsed and the rows take their results.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER, FLAG, TEXT = pa.int64(), pa.bool_(), pa.string()
SPARK_TYPES = {NUMBER: T.LongType(), FLAG: T.BooleanType(), TEXT: T.StringType()}


def per_value(parse: Callable[[str | None], dict], **fields: pa.DataType) -> Callable:
    """A column function that gives the struct ``fields`` of each string, null included."""
    kind = pa.struct(list(fields.items()))

    def rows(values: pa.Array) -> pa.Array:
        found = values.dictionary_encode(null_encoding="encode")
        return pa.array([parse(v) for v in found.dictionary.to_pylist()], kind).take(found.indices)

    rows.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(rows, T.StructType([T.StructField(name, SPARK_TYPES[t]) for name, t in fields.items()]))


def total(cigar: str | None, ops: str) -> int | None:
    return None if cigar is None else sum(map(int, re.findall(f"([0-9]+)[{ops}]", cigar)))


def first(cigar: str | None, pattern: str) -> int:
    found = re.search(pattern, cigar or "")
    return int(found[1]) if found else 0


def count(cigar: str) -> int:
    return len(re.sub("[0-9]", "", cigar))


CLIP = "SHP=X"


def _clips(cigar: str | None) -> dict:
    return {"left_clip": first(cigar, "^([0-9]+)S"), "right_clip": first(cigar, "([0-9]+)S$")}


def _part(cigar: str | None) -> dict:
    ends = {"s_left": first(cigar, f"^([0-9]+)[{CLIP}]"), "s_right": first(cigar, f"([0-9]+)[{CLIP}]$"), "s_lead": first(cigar, "^([0-9]+)M"), "s_tail": first(cigar, "([0-9]+)M$")}
    return {"s_span": total(cigar, "MDN"), "s_query": total(cigar, "MI"), **ends}


def _event(joined: str | None) -> dict:
    out = {"span": total(joined, "MDN"), "q_from": first(joined, f"^([0-9]+)[{CLIP}]")}
    if joined is None:
        return out | {"lead": 0}
    # without outer clips, then without the outer matches: what is left is the event
    core = re.sub(f"[0-9]+[{CLIP}]$", "", re.sub(f"^[0-9]+[{CLIP}]", "", joined))
    event = re.sub("[0-9]+M$", "", re.sub("^[0-9]+M", "", core))
    is_event, single = count(core) > 1, count(event) == 1
    kind = ("I" if single and event.endswith("I") else "D" if single and event.endswith(("D", "N")) else "C") if is_event else None
    return out | {"p_query": total(core, "MI"), "lead": first(core, "^([0-9]+)M"), "is_event": is_event, "kind": kind, "e_all": total(event, "MIDNSHP=X"), "e_query_total": total(event, "MI")}


#: ``left_clip``, ``right_clip`` of a read's own CIGAR.
clips = per_value(_clips, left_clip=NUMBER, right_clip=NUMBER)
#: Spans and ends of a supplementary CIGAR.
part = per_value(_part, s_span=NUMBER, s_left=NUMBER, s_right=NUMBER, s_query=NUMBER, s_lead=NUMBER, s_tail=NUMBER)
#: The event between the outer matches of a joined CIGAR: its kind (``I``, ``D``, ``C``, null for none), place and size.
event = per_value(_event, span=NUMBER, q_from=NUMBER, p_query=NUMBER, lead=NUMBER, is_event=FLAG, kind=TEXT, e_all=NUMBER, e_query_total=NUMBER)
