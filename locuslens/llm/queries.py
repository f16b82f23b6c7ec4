"""Registered queries of the corpus operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslens.llm import exactdup, html, langid, licenses, media, merkle, mix, neardup, packing, pieces, shard, tokencount, vectorcodes
from locuslens.session import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents")).drop("copy")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.shuffle_into_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "license", "hits", F.round("containment", 6).alias("containment"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.octet_length(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("bigint")
    read = media.read_media(media.store_media(docs.select("doc_id", size.alias("n_bytes"), media.text_payload("text").alias("payload"))))
    points = F.size(F.filter("units", lambda u: u.random_access))
    last = F.coalesce(F.element_at("units.pts", -1), F.lit(0))
    feature = F.format_string("packets=%d units=%d access=%d last_pts=%d lost=%d", "packets", F.size("units"), points, last, F.col("continuity_errors") + F.col("sync_errors") + F.col("table_errors"))
    tail = F.expr("substring(payload, greatest(1, length(payload) - 15), 16)")
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"),
        F.octet_length("media").cast("bigint").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings")).drop("label")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(table(spark, sf_dir, "documents"), tampered=merkle.without_newlines())


def segmentations(docs: DataFrame) -> DataFrame:
    """Two distinct sampled segmentations per document, checked by decoding them."""
    drawn = pieces.encode_samples(docs.select("doc_id", "text"), k=2)
    return drawn.select("doc_id", "sample", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion", "round_trip")


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_minhash_neardup, op3_exact_dedup, op4_mix_sources, op5_token_counts, op6_sharding, op7_license_scan, op8_media_columns, op9_language_id, op10_sentencepiece, op11_vector_codes, op12_packing, op13_merkle_manifest)}

UPPER_LOWER = f"'{licenses.UPPER}', '{licenses.LOWER}'"

NEARDUP_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\x20\x09-\x0D]+') AS words FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i+2], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (
  SELECT a AS doc_id, b AS other FROM both_ways UNION SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id, least(d.doc_id, coalesce(m.m, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY 1) m ON m.doc_id = d.doc_id
"""

EXACT_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""


def apportion_sql(source: str, group: str, order: str, value: str, seats: str) -> str:
    """DuckDB form of ``mix.apportion``: bounds from the divisor's range, then the contested quotients."""
    by = f"PARTITION BY {group}" if group else ""
    keys = f"{group}, {order}" if group else order
    share = lambda n: f"coalesce(floor({value} * ({n}) / nullif(sum({value}) OVER ({by}), 0) + 0.5), 0)::BIGINT"
    return f"""
    (WITH b AS (SELECT *, greatest(0, {share(f"{seats} - (count(*) OVER ({by})) / 2.0::DOUBLE")}) AS low, CASE WHEN {value} > 0 THEN {share(f"{seats} + (count(*) OVER ({by})) / 2.0::DOUBLE")} + 1 ELSE 0 END AS high FROM {source}),
    o AS (SELECT *, {seats} - sum(low) OVER ({by}) AS open FROM b),
    c AS (SELECT {keys}, open, row_number() OVER ({by} ORDER BY {value} / (2 * s - 1) DESC, {order}) AS r FROM (SELECT *, unnest(range(low + 1, high + 1)) AS s FROM o)),
    won AS (SELECT {keys}, count(*) AS won FROM c WHERE r <= open GROUP BY ALL)
    SELECT o.* EXCLUDE (low, high, open), low + coalesce(won, 0) AS given FROM o LEFT JOIN won USING ({keys}))"""


MIX_SQL = rf"""
WITH d0 AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), d1 AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id) > greatest(1000, count(*) OVER () / 1000) AS frequent, row_number() OVER (PARTITION BY doc_id, source, size) - 1 AS copy FROM d0
), d AS (
  SELECT doc_id, source, size, md5('mix:' || coalesce(doc_id::VARCHAR, '') || CASE WHEN frequent THEN ':' || coalesce(source, '') || ':' || size || ':' || copy ELSE '' END) AS mark FROM d1
), s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows FROM d GROUP BY 1),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s0),
s2 AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s1),
s3 AS (SELECT *, cap / weight AS per FROM s2),
s4 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY per, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY per, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY per, rank) AS place FROM s3),
s5 AS (SELECT *, min(CASE WHEN level <= per THEN place END) OVER () AS first FROM s4),
s6 AS (SELECT *, max(CASE WHEN place = first THEN level END) OVER () AS lam FROM s5),
s7 AS (SELECT source, rank, source_size, n_rows, total, coalesce(least(cap, weight * lam), cap) AS target, greatest(1, least(64, floor(total / (1000 * count(*) OVER ()))))::BIGINT AS tokens FROM s6),
s8 AS (SELECT *, floor(total / tokens + 0.5)::BIGINT AS blocks FROM s7),
s9 AS (SELECT * EXCLUDE (given), given AS quota, greatest(1, ceil(source_size / 262144.0::DOUBLE), ceil(n_rows / 65536.0::DOUBLE))::BIGINT AS shards FROM {apportion_sql("s8", "", "rank", "target", "blocks")}),
p AS (SELECT doc_id, d.source, size, mark, rank, source_size, target, quota, tokens, ('0x' || substr(mark, 1, 8))::BIGINT % shards AS shard FROM d JOIN s9 ON d.source IS NOT DISTINCT FROM s9.source),
c0 AS (SELECT rank, shard, sum(size)::BIGINT AS length, sum(size)::DOUBLE AS votes, any_value(quota) AS quota, any_value(tokens) AS tokens FROM p GROUP BY 1, 2),
c1 AS (SELECT *, greatest(1, floor(length / tokens::DOUBLE + 0.5))::BIGINT AS m FROM {apportion_sql("c0", "rank", "shard", "votes", "quota")}),
c2 AS (SELECT rank, shard, length, m, least(given, 2 * m)::BIGINT AS q, ('0x' || substr(md5('mix-shift:' || rank || ':' || shard), 1, 8))::BIGINT AS shift FROM c1),
e AS (SELECT p.*, length, m, q, shift, coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY mark, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM p JOIN c2 USING (rank, shard))
SELECT doc_id, size, source, source_size, target,
  CASE WHEN size > 0 THEN (q // m) * size + coalesce(list_sum(list_transform(range(((start + 1) * m - 1) // length, ((start + size) * m - 1) // length + 1),
    lambda j: CASE WHEN (j * {mix.STRIDE} + shift) % m < q % m THEN least(start + size, ((j + 1) * length) // m) - greatest(start, (j * length) // m) ELSE 0 END)), 0) ELSE 0 END::BIGINT AS taken
FROM e
"""

QUOTED = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in licenses.TEMPLATES)
LICENSE_SQL = rf"""
WITH lib(license, notice) AS (VALUES {QUOTED}),
lw AS (SELECT license, regexp_extract_all(translate(notice, {UPPER_LOWER}), '[a-z0-9]+') AS w FROM lib),
lg AS (SELECT DISTINCT license, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT license, w, unnest(range(1, len(w) - 3)) AS i FROM lw)),
ln AS (SELECT license, count(*) AS n FROM lg GROUP BY 1),
dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[a-z0-9]+') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) >= 5))
SELECT doc_id, license, count(*) AS hits, round(count(*) / any_value(n)::DOUBLE, 6) AS containment FROM dg JOIN lg USING (g) JOIN ln USING (license)
GROUP BY doc_id, license HAVING count(*) / any_value(n)::DOUBLE >= 0.8
"""

MEDIA_SQL = rf"""
WITH p AS (
  SELECT doc_id, strlen(t) AS n_bytes, t || repeat(' ', (greatest(192, (strlen(t) + 191) // 192 * 192) - strlen(t))::BIGINT) AS body FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), h AS (SELECT doc_id, n_bytes, body, strlen(body) AS size, hex(encode(body)) AS digits, (strlen(body) + {media.UNIT - 1}) // {media.UNIT} AS units FROM p),
u AS (SELECT doc_id, unnest(range(0, units)) AS n, digits FROM h),
e AS (
  SELECT doc_id, n, n * {media.FRAME} AS pts, substr(digits, n * {2 * media.UNIT} + 1, {2 * media.UNIT}) AS data FROM u
), f AS (
  SELECT doc_id, n, pts, CASE WHEN n % {media.KEY_EVERY} = 0 THEN 176 ELSE 184 END AS head,
    '000001BD' || printf('%04X', length(data) // 2 + 8) || '808005' || printf('%02X%02X%02X%02X%02X', 33 | ((pts >> 29) & 14), (pts >> 22) & 255, 1 | ((pts >> 14) & 254), (pts >> 7) & 255, 1 | ((pts << 1) & 254)) || data AS pes FROM e
), g AS (
  SELECT doc_id, n, pts, head, pes, list_transform(range(0, 1 + greatest(0, (length(pes) // 2 - head + 183) // 184)), lambda i: struct_pack(i := i,
    part := CASE WHEN i = 0 THEN substr(pes, 1, 2 * head) ELSE substr(pes, 2 * (head + (i - 1) * 184) + 1, 368) END)) AS cells FROM f
), k AS (
  SELECT doc_id, n, len(cells) AS cells, array_to_string(list_transform(cells, lambda c: CASE
    WHEN c.i = 0 AND head = 176 THEN '474101300750' || printf('%012X', (pts << 15) | 32256) || c.part
    WHEN c.i = 0 THEN '47410110' || c.part
    WHEN length(c.part) = 368 THEN '470101' || printf('%02X', 16 | c.i) || c.part
    WHEN length(c.part) = 366 THEN '470101' || printf('%02X', 48 | c.i) || '00' || c.part
    ELSE '470101' || printf('%02X', 48 | c.i) || printf('%02X', 183 - length(c.part) // 2) || '00' || repeat('FF', 182 - length(c.part) // 2) || c.part END), '') AS packets FROM g
), m AS (SELECT doc_id, sum(cells)::BIGINT + 2 AS packets, unhex('{media.tables().hex()}' || string_agg(packets, '' ORDER BY n)) AS media FROM k GROUP BY doc_id)
SELECT h.doc_id, n_bytes, size AS payload_bytes, sha256(body) AS payload_sha256,
  xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, 16), lambda i: ('0x' || substr(digits, length(digits) - 31 + 2 * i, 2))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(0, 8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) AS tail_crc32,
  octet_length(media)::BIGINT AS media_bytes, sha256(media) AS media_sha256,
  printf('packets=%d units=%d access=%d last_pts=%d lost=0', packets, units, (units + {media.KEY_EVERY - 1}) // {media.KEY_EVERY}, (units - 1) * {media.FRAME}) AS feature
FROM h JOIN m USING (doc_id)
"""


def codes_round(n: int, update: bool) -> str:
    """Nearest entries of book ``n``, and the book after it."""
    assigned = f"""a{n} AS MATERIALIZED (SELECT r, part, min(struct_pack(d := d, e := entry)) AS best FROM (
  SELECT r, p.part, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{n} b ON b.part = p.part) GROUP BY ALL)"""
    if not update:
        return assigned
    return f"""{assigned}, m{n} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
  SELECT a.part, best.e AS entry, i, sum(x[i]) AS s, count(*) AS n FROM a{n} a JOIN p USING (r, part), width w, unnest(range(1, w.w + 1)) t(i) GROUP BY ALL) GROUP BY ALL),
b{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{n} b LEFT JOIN m{n} m USING (part, entry))"""


CODES_SQL = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, ints) AS r, vec_id, label, ints FROM (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {vectorcodes.SCALE})::BIGINT) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
width AS (SELECT max(len(ints)) // {vectorcodes.PARTS} AS w FROM v),
p AS MATERIALIZED (SELECT r, q AS part, ints[q * w + 1:(q + 1) * w] AS x FROM v, width, unnest(range(0, {vectorcodes.PARTS})) t(q)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {vectorcodes.ENTRIES}),
{", ".join(codes_round(n, n < vectorcodes.ROUNDS) for n in range(vectorcodes.ROUNDS + 1))},
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{vectorcodes.ROUNDS} GROUP BY r),
books AS (SELECT sha256(array_to_string(flatten(list(c ORDER BY part, entry)), ',')) AS codebooks_sha256 FROM b{vectorcodes.ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN coded USING (r), books
"""


def merkle_levels(name: str, leaves: str, group: str, levels: int) -> str:
    """Runs and rows with their path so far, level by level, for trees of up to ``3 ** levels`` leaves."""
    steps = [f"{name}n0 AS MATERIALIZED (SELECT {group}, i, h FROM {leaves}), {name}p0 AS MATERIALIZED (SELECT * FROM {leaves})"]
    for n in range(levels):
        steps.append(f"""{name}r{n} AS MATERIALIZED (SELECT {group}, i // 3 AS run, list(h ORDER BY i) AS hs, any_value(c) AS c FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS c FROM {name}n{n}) GROUP BY {group}, i // 3),
{name}n{n + 1} AS MATERIALIZED (SELECT {group}, run AS i, CASE WHEN c > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{n}),
{name}p{n + 1} AS MATERIALIZED (SELECT p.* REPLACE (i // 3 AS i,
  path || CASE WHEN c > 1 THEN [struct_pack(a := array_to_string(hs[:i % 3], ''), b := array_to_string(hs[i % 3 + 2:], ''))] ELSE [] END AS path)
  FROM {name}p{n} p JOIN {name}r{n} r ON r.{group} IS NOT DISTINCT FROM p.{group} AND r.run = p.i // 3)""")
    return ",\n".join(steps)


def leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def fold_sql(start: str) -> str:
    return f"list_reduce(list_concat([struct_pack(a := {start}, b := '')], path), lambda h, s: struct_pack(a := sha256(s.a || h.a || s.b), b := '')).a"


NO_PATH = "[]::STRUCT(a VARCHAR, b VARCHAR)[]"
#: Trees of up to 3 ** 12 documents of a source and 3 ** 8 sources, far above the tables that SQL runs on.
MERKLE_SQL = f"""
WITH d AS (SELECT *, CASE WHEN xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(0, 8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered FROM documents),
lf AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {leaf_sql("text")} AS leaf, {leaf_sql("altered")} AS changed FROM d),
l0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, {NO_PATH} AS path FROM lf),
{merkle_levels("s", "l0", "tree", 12)},
t0 AS MATERIALIZED (SELECT 1 AS every, tree, row_number() OVER (ORDER BY tree) - 1 AS i, h, h AS subroot, {NO_PATH} AS path FROM sn12),
{merkle_levels("t", "t0", "every", 8)},
whole AS (SELECT doc_id, leaf, changed, subroot, tn8.h AS root, p.path || q.path AS path FROM sp12 p JOIN tp8 q USING (tree), tn8),
checked AS (SELECT *, {fold_sql("changed")} AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.a || s.b), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM checked
"""

ORACLE_SQL = {"op2_minhash_neardup": NEARDUP_SQL, "op3_exact_dedup": EXACT_SQL, "op4_mix_sources": MIX_SQL, "op7_license_scan": LICENSE_SQL, "op8_media_columns": MEDIA_SQL, "op11_vector_codes": CODES_SQL, "op13_merkle_manifest": MERKLE_SQL}
