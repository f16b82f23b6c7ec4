import random

import numpy as np
from test_dedup import near_brute

from locuslens.llm import neardup


def family(seed, copies, edits):
    """Copies of one 100-word text, each with some words substituted: most links have no common hub."""
    r = random.Random(seed)
    words = [f"w{r.randrange(4000)}" for _ in range(100)]
    rows = []
    for i in range(copies):
        own = words[:]
        for at in r.sample(range(100), r.choice(edits)):
            own[at] = f"new{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


def wrong(make, rows):
    want = near_brute(rows, 3, 85)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(make(rows), width=3, percent=85).collect()}
    return sum(got[i] != want[i] for i in want)


def test_near_links_without_a_hub(make):
    assert wrong(make, family(11, 300, (2,))) == 0


def test_near_links_without_a_hub_more_edits(make):
    assert wrong(make, family(12, 600, (2, 3))) == 0


def test_one_key_with_two_texts(make):
    """Both sets of a key are vertices of their own and link with their own partners."""
    r = random.Random(12)
    a, b = (" ".join(f"w{r.randrange(10**6)}" for _ in range(80)) for _ in range(2))
    rows = [(5, a), (5, b), (7, a + " end"), (9, b + " end"), (11, "alone with other words here")]
    found = {(x.doc_id, x.n_shingles, x.component_id) for x in neardup.near_duplicates(make(rows), width=3, percent=85).collect()}
    assert found == {(5, 78, 5), (7, 79, 5), (9, 79, 5), (11, 3, 11)}


def test_parity_sketch_never_exceeds_the_difference():
    r = random.Random(40)
    for _ in range(300):
        a = {r.getrandbits(64) for _ in range(r.randint(0, 900))}
        b = {x for x in a if r.random() < 0.8} | {r.getrandbits(64) for _ in range(r.randint(0, 200))}
        x, y = (neardup.parity_sketch(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(a ^ b)


def test_last_step_refuses_distant_pairs_in_the_join(spark):
    """Sets that share rare shingles but lie below the threshold give no candidate; those above all do."""
    r = random.Random(41)
    base = [r.getrandbits(62) for _ in range(100)]
    sets = [base[n:] + [r.getrandbits(62) for _ in range(n)] for n in [3] * 40 + [20] * 60]
    rows = [(i, i, [int(x) for x in s], [int(x) for x in neardup.parity_sketch(np.array(sorted(s), np.uint64))]) for i, s in enumerate(sets)]
    got = {(p.a, p.b) for p in neardup.remaining_pairs(spark.createDataFrame(rows, "id long, own long, grams array<bigint>, parity array<bigint>"), 85).collect()}
    want = {(i, j) for i in range(100) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= 85 * len(set(sets[i]) | set(sets[j]))}
    assert {(b, a) for a, b in got} >= want and len(got) <= len(want) + 40
