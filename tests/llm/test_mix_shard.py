import numpy as np
from pyspark.sql import functions as F

from locuslens.llm import mix, shard


def sainte_lague(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def water(sizes, weights, share=1.5, cap=2.0):
    total, out, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = (total - sum(out[i] for i in range(len(sizes)) if i not in open_)) / sum(weights[i] for i in open_)
        over = [i for i in open_ if level * weights[i] > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in over:
            out[i] = cap * sizes[i]
            open_.discard(i)
    return out


def test_apportion_is_sainte_lague(spark):
    votes = [317.5, 12.0, 12.0, 0.0, 990.25, 0.5]
    frame = spark.createDataFrame([(i, v, 40) for i, v in enumerate(votes)], "rank int, target double, blocks long")
    got = [r.quota for r in mix.apportion(frame, [], "rank", "target", "blocks", "quota").orderBy("rank").collect()]
    assert got == sainte_lague(votes, 40)


def test_targets_and_taken(make):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 400)), "en", "big" if i % 3 else f"s{i % 12}") for i in range(400)]
    got = mix.mix_documents(make(rows)).collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    names = sorted(sizes)
    want = dict(zip(names, water([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))]), strict=True))
    for s in names:
        own = [r for r in got if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 0.01 * want[s] + 64
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    again = {r.doc_id: r.taken for r in mix.mix_documents(make(rows).repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in got}


def test_mix_odd_rows(odd, make):
    got = mix.mix_documents(odd).collect()
    assert len(got) == 12 and all(r.taken <= 2 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mix.mix_documents(make([(1, "a")]).limit(0)).count() == 0
    assert [r.taken for r in mix.mix_documents(make([(1, None), (2, "")])).collect()] == [0, 0]


def check_shards(df, shards=40):
    got = shard.shuffle_into_shards(df, shards=shards).collect()
    assert len(got) == df.count()
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(shards)]
    assert all(s == list(range(len(s))) for s in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    return got


def test_shards(make, odd):
    got = check_shards(make([(i, f"text {i}") for i in range(1003)]))
    assert got and {r.doc_id for r in got} == set(range(1003))
    check_shards(odd, 5)
    assert shard.shuffle_into_shards(make([(1, "a")]).limit(0)).count() == 0


def test_shuffle_is_uniform(make):
    """Neighbouring documents meet in a shard as often as chance has it, and shards do not follow the key."""
    got = sorted(check_shards(make([(i, "t") for i in range(4000)]), 4), key=lambda r: r.doc_id)
    meet = np.mean([a.shard == b.shard for a, b in zip(got, got[1:], strict=False)])
    assert abs(meet - 0.25) < 0.04
    assert abs(np.corrcoef([r.doc_id for r in got], [r.slot for r in got])[0, 1]) < 0.08


def test_matrix_margins_and_mean():
    counts = [5, 0, 17, 100, 3]
    draws = np.array([shard.communication_matrix(counts, 6, s) for s in range(400)])
    assert (draws.sum(2) == counts).all() and (draws.sum(1) == [21, 21, 21, 21, 21, 20]).all()
    assert np.allclose(draws.mean(0)[3], 100 * np.array([21, 21, 21, 21, 21, 20]) / 125, atol=0.5)


def test_huge_draws_follow_the_law():
    r = np.random.default_rng(1)
    got = [shard.hypergeometric(r, 3 * 10**9, 10**9, 10**6) for _ in range(400)]
    assert abs(np.mean(got) - 750_000) < 100 and abs(np.std(got) - 433) < 60


def test_sizes_and_checksums(odd):
    rows = shard.shuffle_into_shards(odd).join(odd.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("n")), "doc_id")
    assert all(r.size == r.n + 16 for r in rows.collect())
