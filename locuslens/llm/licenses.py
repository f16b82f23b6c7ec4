"""Licence scans: MinHash bands over overlapping text windows retrieve templates, containment verifies.

Words are lower-cased runs of letters and digits; five words make a shingle, hashed to 64 bits. Two kinds
of windows overlap over the whole text. Windows of one shingle at every word serve templates of at most
four shingles, whose containment of 0.8 needs every shingle: equal shingles share the only band key, so
retrieval is certain. Windows of ``SPAN`` shingles at every ``STEP``-th word serve longer templates: a
band key is the minimum of the window's shingles under one of ``BANDS`` exclusive-or orders, and template
windows at all offsets carry the same keys, so a passage that is contained whole misses with probability
below 1e-6. Retrieved templates are verified by the exact share of their shingles that the text contains.

Everything is map-side over the documents; only matches are shuffled. The template collection is a
parameter of bounded size (a list of short texts), whose keys are literals of the plan.

Defined results: null, empty and shorter texts match nothing; a template of fewer than five words is one
shingle of all its words and matches only texts that are just that; repeated rows match alike; a text may
match several templates; further columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslens.llm.common import let

WIDTH, SPAN, STEP, BANDS, LEAST = 5, 8, 4, 12, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Short notices of public licences (fixed texts).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)


def window_keys(hashes: Column, orders: list[int], step: int) -> Column:
    """Band keys of the ``SPAN``-shingle windows that start at every ``step``-th shingle, flat."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hashes) - (SPAN - step)), F.lit(step))
    least = lambda window, o: F.array_min(F.transform(window, lambda x: x.bitwiseXOR(F.lit(o))))
    keys = lambda window: F.array(*(F.xxhash64(least(window, o), F.lit(b)) for b, o in enumerate(orders)))
    return F.flatten(F.transform(starts, lambda i: let(F.slice(hashes, i, SPAN), keys)))


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles of a text in order; fewer words: one hash of all; none: empty."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit("([a-z0-9]+)"), F.lit(1))
    grams = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(WIDTH))))
    none = F.array().cast("array<bigint>")
    return let(words, lambda w: F.when(F.size(w) == 0, none).when(F.size(w) < WIDTH, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(grams(w)))


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``license, grams (distinct), long, keys`` of each template."""
    orders = band_orders()
    raw = spark.createDataFrame(list(templates), "license string, notice string").select("license", shingles(F.col("notice")).alias("h")).where("size(h) > 0")
    long = F.size(F.array_distinct("h")) > 4
    keys = F.when(long, let(F.col("h"), lambda h: window_keys(h, orders, 1))).otherwise(F.col("h"))
    return raw.select("license", F.array_distinct("h").alias("grams"), long.alias("long"), F.array_distinct(keys).alias("keys"))


def band_orders(count: int = BANDS, seed: int = 31) -> list[int]:
    r = random.Random(seed)
    return [r.getrandbits(63) for _ in range(count)]


def longs(values: list[int]) -> Column:
    return F.array(*(F.lit(v) for v in values)).cast("array<bigint>")


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``key, license, hits, containment, row`` of every match in ``docs``, at least ``least`` contained."""
    spark = docs.sparkSession
    library = template_table(spark, templates)
    known = library.collect()  # the parameter's own rows
    short = longs(sorted({k for t in known if not t["long"] for k in t["keys"]}))
    wide = longs(sorted({k for t in known if t["long"] for k in t["keys"]}))
    every = longs(sorted({g for t in known for g in t["grams"]}))
    # one pass: shingles are bound once, then retrieved by both kinds of windows, then cut to template shingles
    met = lambda h: F.concat(F.array_intersect(h, short), F.array_intersect(window_keys(h, band_orders(), STEP), wide))
    look = let(shingles(F.col(text)), lambda h: F.struct(met(h).alias("met"), F.array_intersect(h, every).alias("own")))
    found = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.explode(F.array(look)).alias("look"))
    found = found.where(F.size("look.met") > 0).select("row", "id", "look.met", "look.own")
    index = library.select("license", "grams", F.explode("keys").alias("met_key"))
    retrieved = found.select("row", "id", "own", F.explode("met").alias("met_key")).join(F.broadcast(index), "met_key")  # template keys only
    hits = F.size(F.array_intersect("grams", "own"))
    judged = retrieved.select("row", "id", "license", hits.alias("hits"), (hits / F.size("grams")).alias("containment")).where(F.col("containment") >= least)
    return judged.dropDuplicates(["row", "id", "license"]).select(F.col("id").alias(key), "license", F.col("hits").cast("bigint").alias("hits"), "containment", "row")
