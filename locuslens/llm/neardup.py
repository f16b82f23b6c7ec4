"""MinHash near-duplicate detection: one-permutation hashing, optimal densification, star candidates.

Every document's distinct word shingles are hashed once; the hash names a bin and a value, and each bin
keeps its minimum. Empty bins copy the first full bin of their own fixed probe order (optimal
densification), so two documents agree in a bin with probability equal to their Jaccard similarity. Runs
of ``rows`` bins form ``bands`` bucket keys. Documents with identical shingle sets are one vertex from the
start. A bucket proposes a star, its most central member against the others, so pairs stay linear in
bucket entries; stars are confirmed on the full shingle sets, confirmed links are contracted to
components, and buckets that still hold several components propose further stars (``passes``) from a
member outside the first hub's component. Stars only contract cheaply what is linked closely; a last
step tests every pair that they left: members of buckets that still hold several components are joined
on the rarest shingles of their sets (prefix filter and parity sketch, both exact), and every pair of different
components that can reach the threshold is confirmed or refused on the full sets. Hot buckets and hot hubs only make join
partitions large, which adaptive execution splits; nothing collects a bucket.

Defined results: null and blank texts have 0 shingles and are linked with nothing; fewer words than a
shingle form one shingle; equal sets of any number are one component; null keys get a null component
unless their set occurs under a key; repeated rows share a component; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import connected, joined_components, small_batches, with_fields
from locuslens.session import cut

MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
#: 64-bit words of a parity sketch.
SKETCH = 16


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(w) for w in words], np.uint64)
    count = max(1, len(own) - width + 1)
    mixed = np.full(count, np.uint64(min(width, len(own))))
    for i in range(min(width, len(own))):
        mixed = (mixed ^ (own[i : i + count] * MIX[i % len(MIX)])) * MIX[(i + 3) % len(MIX)]
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed * MIX[0] ^ (mixed >> np.uint64(29)))


def set_digest(hashes: np.ndarray) -> bytes | None:
    """The name of a shingle set; null for an empty one."""
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


@lru_cache(maxsize=4)
def probes(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a full one: a fixed random permutation."""
    r = np.random.default_rng(20)
    return np.array([r.permutation(bins) for _ in range(bins)])


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima, densified."""
    h = (hashes ^ (hashes >> np.uint64(32))) * MIX[4]
    place = ((h >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64)
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, place, h * MIX[5])
    full = np.zeros(bins, bool)
    full[place] = True
    empty = np.flatnonzero(~full)
    if len(empty):
        order = probes(bins)[empty]
        least[empty] = least[order[np.arange(len(empty)), full[order].argmax(1)]]
    return least


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key per band."""
    grid = least.reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64) * MIX[6]
    for i in range(rows):
        key = (key ^ grid[:, i]) * MIX[i % 3]
        key ^= key >> np.uint64(30)
    return key.view(np.int64)


def sketches(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """``key, n_shingles, set_key, bands`` of every row; one pass, no shuffle."""
    schema = with_fields(docs.select(key).schema, "n_shingles bigint, set_key binary, bands array<bigint>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            keys = [set_digest(x) for x in sets]
            bucket = [band_keys(signature(s, bands * rows), bands, rows) if len(s) else np.zeros(0, np.int64) for s in sets]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bucket, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.fieldNames())

    return docs.select(key, text).mapInArrow(work, schema)


def parity_sketch(hashes: np.ndarray) -> np.ndarray:
    """Every shingle toggles one of ``64 * SKETCH`` bits: two sketches differ in no more bits than their sets in shingles."""
    odd = np.bincount((hashes % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def full_sets(wanted: DataFrame, width: int) -> DataFrame:
    """``id, grams, parity``: the whole shingle set of each vertex of ``wanted (id, want, text)`` and its sketch, from rows whose text has that set.

    A task gives each vertex once, however often its row is repeated there.
    """
    schema = with_fields(wanted.select("id").schema, "grams array<bigint>, parity array<bigint>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in small_batches(batches):
            ids, sets = [], []
            for i, want, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i not in given and set_digest(found := shingle_set(text, width)) == want:
                    given.add(i)
                    ids.append(i)
                    sets.append(found.view(np.int64))
            sketch = [parity_sketch(x.view(np.uint64)) for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(sets, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))], names=["id", "grams", "parity"])

    return wanted.mapInArrow(work, schema)


def remaining_pairs(grams: DataFrame, percent: int) -> DataFrame:
    """``a, b``: all pairs of different ``own`` among ``grams (id, own, grams, parity)`` that can reach the threshold.

    With the shingles in one global order, rarest first, two sets of Jaccard similarity ``percent`` / 100
    share one of the first ``n - ceil(n percent / 100) + 1`` of each, and their first common one leaves
    enough places behind it for the overlap they need. Such sets differ in at most ``(n_a + n_b) (100 - percent)
    / (100 + percent)`` shingles, so in no more bits of their sketches: the join itself refuses other pairs, and a
    family of copies that are all just too far apart gives no rows.
    """
    gram = grams.select("id", "own", F.explode("grams").alias("gram"))
    rarity = gram.groupBy("gram").agg(F.count("*").alias("holders"), (F.min("own") != F.max("own")).alias("shared"))
    order = gram.join(rarity, "gram").groupBy("id", "own").agg(F.sort_array(F.collect_set(F.struct("holders", "gram", "shared"))).alias("o"))
    order = order.select("id", "own", F.size("o").alias("n"), F.slice("o", 1, F.expr(f"int(size(o) - ceil(size(o) * {percent} / 100.0) + 1)")).alias("o"))
    prefix = order.select("id", "own", "n", F.posexplode("o").alias("at", "x")).where("x.shared").select(F.col("x.gram").alias("gram"), "id", "own", "n", "at")
    prefix = cut(prefix.join(grams.select("id", "parity"), "id"), "prefixes")
    left, right = (prefix.select("gram", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "own", "n", "at", "parity"))) for side in "ab")
    room = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    met = left.join(right, "gram").where("own_a < own_b").where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    met = met.where((100 + percent) * room >= percent * (F.col("n_a") + F.col("n_b")))
    apart = sum((F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(SKETCH)), F.lit(0))
    met = met.where((100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b")))
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def confirm(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full shingle sets reach the threshold."""
    both = pairs.join(grams.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(grams.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    joint = F.size(F.array_intersect("ga", "gb"))
    return cut(both.where(100 * joint >= percent * (F.size("ga") + F.size("gb") - joint)).select("a", "b"), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, bands: int = 32, rows: int = 5, passes: int = 3, broadcast_ids: int = 1_000_000) -> DataFrame:
    """``key, n_shingles, component_id, kept`` per row of ``docs``: links have Jaccard >= ``percent`` / 100.

    At 32 bands of 5 rows a pair at 0.85 shares no bucket with probability 7e-9.
    """
    sketch = cut(sketches(docs, key, text, width, bands, rows), "sketches")
    # a vertex is a distinct set; its number is fixed once written
    sets = sketch.where("set_key is not null").groupBy("set_key").agg(F.min(key).alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    reps = cut(sets.withColumn("rep", F.monotonically_increasing_id()), "set-representatives")
    entries = reps.where("least is not null").select("rep", "n", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    member = cut(entries.join(shared, "bucket"), "bucket-members")
    central = member.groupBy("rep").agg(F.sum("members").alias("central"))
    member = cut(member.select("bucket", "rep", "n").join(central, "rep"), "bucket-ranks")
    vertices = cut(reps.select("rep", "least", "set_key").join(member.select("rep").distinct(), "rep"), "vertices")
    # a vertex is three numbers: few enough of them to be sent to every task, or else joined by a shuffle of the texts
    sought = vertices.select(F.col("rep").alias("id"), F.col("set_key").alias("want"), F.col("least").alias("_least"))
    sought = F.broadcast(sought) if vertices.count() <= broadcast_ids else sought
    wanted = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(sought, F.col("_key") == F.col("_least")).select("id", "want", "_text")
    grams = cut(full_sets(wanted, width), "shingle-sets")

    tested = labels = None
    for turn in range(passes):
        if labels is None:
            hub = member.groupBy("bucket").agg(F.max(F.struct("central", -F.col("rep"), "n")).alias("h")).select("bucket", (-F.col("h.col2")).alias("hub"), F.col("h.n").alias("hub_n"))
            pairs = member.join(hub, "bucket").where("rep != hub")
        else:
            placed = member.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("own", F.coalesce("component", "rep")).drop("component")
            first = placed.groupBy("bucket").agg(F.max(F.struct("central", -F.col("rep"), "own")).alias("h"), F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo != hi").select("bucket", F.col("h.own").alias("first_own"))
            open_ = placed.join(first, "bucket")
            # another hub: the most central member outside the first hub's component, in a new order each pass
            salt = F.xxhash64("rep", F.lit(turn)) if turn > 1 else F.col("central")
            hub = open_.where("own != first_own").groupBy("bucket").agg(F.max(F.struct(salt.alias("s"), -F.col("rep"), "n", "own")).alias("h"))
            hub = hub.select("bucket", (-F.col("h.col2")).alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.own").alias("hub_own"))
            pairs = open_.join(hub, "bucket").where("own != hub_own")
        sized = pairs.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
        pairs = sized.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        confirmed = confirm(pairs, grams, percent)
        if turn and confirmed.isEmpty():
            continue
        labels = connected(confirmed, "near") if labels is None else joined_components(labels, confirmed, "near")
    # what the stars left: every untested pair of different components inside a bucket
    owned = member.select("bucket", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("own"))
    mixed = owned.groupBy("bucket").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo != hi").select("bucket")
    open_ = owned.join(mixed, "bucket").select(F.col("rep").alias("id"), "own").distinct()
    pairs = cut(remaining_pairs(cut(grams.join(open_, "id").select("id", "own", "grams", "parity"), "open-sets"), percent).join(tested, ["a", "b"], "left_anti"), "remaining-pairs")
    confirmed = confirm(pairs, grams, percent)
    if not confirmed.isEmpty():
        labels = joined_components(labels, confirmed, "near")
    # components are named by the smallest key of their sets
    named = labels.withColumnRenamed("id", "rep").join(vertices.select("rep", "least"), "rep")
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
    joined = named.join(smallest, "component").select("rep", "smallest")
    names = reps.select("set_key", "rep", "least").join(joined, "rep", "left").select("set_key", F.coalesce("smallest", "least").alias("name"))
    placed = sketch.drop("bands").join(names, "set_key", "left")
    component = F.coalesce("name", key)
    return placed.select(key, "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col(key)).alias("kept"))
