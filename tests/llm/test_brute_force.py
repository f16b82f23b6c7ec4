"""Sharding, language decoding and empty tables against plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuslens.llm import common, langid, licenses, media, mix, shard, tokencount


def test_slots_by_plain_placement(make):
    """Rows are placed again in plain Python from their hashes; one key holds most of them."""
    docs = make([(i if i % 3 == 0 else 7, f"text {i % 50}") for i in range(3000)])
    rows = shard.shuffle_into_shards(docs, shards=7, partitions=16).collect()
    sizes = [sum(r.shard == s for r in rows) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and len(rows) == 3000
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    unique = make([(i, f"text {i % 50}") for i in range(500)])
    hashes = [F.xxhash64(F.col("doc_id").cast("string"), F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long"), F.lit(29 + n)).alias(f"h{n}") for n in (1, 2)]
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(0).cast("long"), F.lit(29)), F.lit(16)).cast("int").alias("part")
    plain = unique.select("doc_id", part, *hashes).collect()
    counts = [sum(r.part == p for r in plain) for p in range(16)]
    ends = shard.communication_matrix(counts, 7, 29).cumsum(1)
    order = lambda h: h % 2**64
    placed = {}
    for p in range(16):
        for at, r in enumerate(sorted((r for r in plain if r.part == p), key=lambda r: (order(r.h1) >> 52, r.h1))):
            placed[r.doc_id] = int((ends[p] <= at).sum())
    want = {}
    for s in range(7):
        for slot, r in enumerate(sorted((r for r in plain if placed[r.doc_id] == s), key=lambda r: (order(r.h2) >> 52, r.h2))):
            want[r.doc_id] = (s, slot)
    got = {r.doc_id: (r.shard, r.slot) for r in shard.shuffle_into_shards(unique, shards=7, partitions=16).collect()}
    assert got == want


def test_frequent_keys_are_told_apart_by_content(make):
    """Rows of a frequent key are numbered among equal rows, the same way in every layout."""
    docs = make([(i if i % 3 else None, f"x {i % 2}") for i in range(4000)]).select("doc_id", "text")
    found = [[tuple(r) for r in common.salted(layout, "doc_id").collect()] for layout in (docs.coalesce(1), docs.repartition(13, "text"), docs.orderBy(F.desc("text")).repartition(5))]
    assert len(found[0]) == 4000 and all(sorted(x, key=str) == sorted(found[0], key=str) for x in found)
    assert all(copy is None for k, _, copy in found[0] if k is not None)
    for text in ("x 0", "x 1"):
        own = sorted(copy for k, t, copy in found[0] if k is None and t == text)
        assert own == list(range(667))


def test_reruns_agree_in_every_layout(make):
    """Mix and shards of rows of which more than half share a key, and some are repeated whole, in two layouts."""
    docs = make([(i if i % 8 < 3 else 7, " ".join(["w"] * (i % 40 if i % 5 else 11)), "en", f"s{i % 3}") for i in range(4000)])
    again = docs.orderBy(F.desc("text"), "source").repartition(11)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(mix.mix_documents(docs, shard_words=4000)) == rows(mix.mix_documents(again, shard_words=4000))
    assert rows(shard.shuffle_into_shards(docs, shards=5, partitions=16)) == rows(shard.shuffle_into_shards(again, shards=5, partitions=16))


def test_sources_without_words_have_many_shards(make):
    docs = make([(i, "  " if i % 2 else "one two", "en", "blank" if i % 2 else "words") for i in range(2000)])
    rows = mix.mix_documents(docs, shard_rows=100).collect()
    assert len({r.shard for r in rows if r.source == "blank"}) == 10 and all(r.taken == 0 for r in rows if r.source == "blank")


def naive_features(text):
    data = b" " + text.lower().encode() + b" "
    counts = [0.0] * langid.DIMENSIONS
    for n in range(1, langid.GRAMS + 1):
        for i in range(len(data) - n + 1):
            gram = int.from_bytes(data[i : i + n], "big")
            counts[((gram + n) * langid.MULTIPLIERS[n - 1] & 0xFFFFFFFF) >> 19] += 1
    roots = [math.sqrt(c) for c in counts]
    norm = math.sqrt(sum(x * x for x in roots))
    return [x / norm for x in roots]


@pytest.mark.parametrize("text", ["a", "Straße und Öl", "the cat sat on the mat " * 5])
def test_features_by_loop(text):
    assert np.allclose(langid.features(text), naive_features(text))


def test_decoding_by_loop():
    r = np.random.default_rng(2)
    model = langid.Model(list("abcd"), langid.codewords(4), np.zeros((1, 7)), np.zeros(7), np.full(7, 1 / 7))
    margins = r.normal(0, 3, (30, 7))
    best, score, gap = langid.decode(margins, model)
    for m, b, s, g in zip(margins, best, score, gap, strict=True):
        losses = [sum(math.log1p(math.exp(-x * c)) for x, c in zip(m, code, strict=True)) for code in model.codes]
        ranked = sorted(losses)
        assert losses[b] == pytest.approx(ranked[0]) and g == pytest.approx(ranked[1] - ranked[0])
        assert s == pytest.approx(math.exp(-losses[b]) / sum(math.exp(-x) for x in losses))


def test_training_rows_are_bounded(make):
    docs = make([(i if i % 2 else 5, f"word number {i % 700} of many", "en" if i % 3 else "de") for i in range(3000)])
    rows = langid.training_rows(docs, F.lit(True), per_language=50)
    assert {lang for *_, lang in rows} == {"en", "de"} and all(sum(x[2] == lang for x in rows) == 50 for lang in ("en", "de"))
    again = langid.training_rows(docs.repartition(7), F.lit(True), per_language=50)
    assert all(np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) and a[2] == b[2] for a, b in zip(rows, again, strict=True))


def test_empty_tables(make):
    none = make([(1, "a")]).limit(0)
    assert tokencount.count_tokens(none).count() == 0
    assert licenses.scan_licenses(none).count() == 0
    assert langid.identify_documents(none).count() == 0
    assert media.read_media(media.store_media(none.select("doc_id", media.text_payload("text").alias("payload")))).count() == 0
