import hashlib
import random
import zlib

from pyspark.sql import functions as F

from locuslens.llm import media, queries


def test_round_trip_and_units():
    r = random.Random(5)
    for n in (0, 1, 169, 170, 176, 177, 192, media.UNIT - 1, media.UNIT, media.UNIT + 1, 50_000, 184 * 7 - 22, 184 * 7 - 23):
        data = r.randbytes(n)
        stream = media.write_stream(data)
        got = media.read_stream(stream)
        assert got["payload"] == data and len(stream) % 188 == 0
        assert got["continuity_errors"] == got["sync_errors"] == got["table_errors"] == 0
        units = got["units"]
        assert len(units) == -(-n // media.UNIT) and [u["pts"] for u in units] == [i * media.FRAME for i in range(len(units))]
        assert [u["random_access"] for u in units] == [i % media.KEY_EVERY == 0 for i in range(len(units))]


def test_damage_is_seen():
    data = bytes(range(256)) * 40
    packets = [media.write_stream(data)[i : i + 188] for i in range(0, len(media.write_stream(data)), 188)]
    lost = media.read_stream(b"".join(packets[:5] + packets[6:]))
    assert lost["continuity_errors"] == 1 and [u["intact"] for u in lost["units"]].count(False) == 1
    assert media.read_stream(b"".join([packets[0][:20] + b"\0" + packets[0][21:], *packets[1:]]))["table_errors"] + media.read_stream(b"".join([packets[0][:10] + b"\0\0\0" + packets[0][13:], *packets[1:]]))["table_errors"] >= 1
    assert media.read_stream(b"\0" + packets[0][1:])["sync_errors"] == 1
    assert media.read_stream(b"")["units"] == []


def test_media_query(odd, tmp_path):
    odd.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.n_bytes): r for r in queries.op8_media_columns(odd.sparkSession, str(tmp_path)).collect()}
    for row in odd.collect():
        data = (row.text or "").encode()
        padded = data.ljust(max(192, -(-len(data) // 192) * 192))
        r = got[(row.doc_id, len(data))]
        assert r.payload_bytes == len(padded) and r.payload_sha256 == hashlib.sha256(padded).hexdigest()
        assert r.tail_crc32 == zlib.crc32(padded[-16:]) and r.media_sha256 == hashlib.sha256(media.write_stream(padded)).hexdigest()


def test_access_points(spark):
    df = spark.createDataFrame([(1, bytes(media.UNIT * 9))], "doc_id long, payload binary")
    points = media.access_points(media.read_media(media.store_media(df)), "doc_id").orderBy("packet").collect()
    assert [round(p.seconds * media.CLOCK) for p in points] == [0, 4 * media.FRAME, 8 * media.FRAME]


def test_pipeline(make, odd):
    import corpus_pipeline

    spark = odd.sparkSession
    r = random.Random(8)
    texts = [" ".join(r.choice(["ein", "und", "schung", "keit"]) + r.choice(["er", "en", ""]) for _ in range(60)) for _ in range(40)]
    copies = [(100 + i, texts[i % 40] + (" " if i >= 40 else ""), "de", f"s{i % 3}") for i in range(60)]
    docs = odd.unionByName(make(copies)).drop("score")
    columns = docs.columns
    language, exact, near, mixed, last = (f for _, f in corpus_pipeline.STAGES)
    a = language(spark, docs, "")
    assert a.columns == columns and {x.doc_id for x in a.collect()} == {x.doc_id for x in docs.collect()} - {1, 2, 3, 10}
    b = exact(spark, a, "")
    kept = b.collect()
    assert b.columns == columns and len(kept) == len({(x.text or "").replace(" ", "").replace("\n", "").replace("\r", "") for x in a.collect()})
    c = near(spark, b, "")
    assert c.columns == columns and {7, 4} <= {x.doc_id for x in c.collect()} and 8 not in {x.doc_id for x in c.collect()}
    d = mixed(spark, c, "")
    assert d.columns == columns and {x.doc_id for x in d.collect()} <= {x.doc_id for x in c.collect()}
    e = last(spark, d, "")
    assert e.where(~F.col("round_trip")).count() == 0 and e.count() >= d.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0
