import itertools
import random

from locuslens.llm import exactdup, neardup

BLANKS = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def exact_brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(BLANKS), []).append((-len(text or ""), key is None, key or 0, key))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def check_exact(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want, got = exact_brute(rows), exactdup.exact_duplicates(df, **options).collect()
    assert len(got) == len(rows)
    texts = {}
    for key, text in rows:
        texts.setdefault(key, set()).add((text or "").translate(BLANKS))
    for r in got:
        assert any(want[t] == (r.keep_id, r.group_size) for t in texts[r.doc_id])
    assert sum(r.kept for r in got) == len(want)


def test_exact_odd_rows(odd):
    check_exact(odd)


def test_exact_blocks_and_clashing_hashes(make):
    r = random.Random(1)
    base = ["".join(r.choice("ab ") for _ in range(r.randint(0, 40))) for _ in range(30)]
    rows = [(i, r.choice(base) + r.choice(["", " ", "a"])) for i in range(120)]
    for hash_range in (None, 3):
        check_exact(make(rows), block=4, hash_range=hash_range)


def test_exact_longest_then_smallest_stays(make):
    got = {r.doc_id: r for r in exactdup.exact_duplicates(make([(3, "a b"), (1, "ab"), (2, "a b"), (4, "a  b")])).collect()}
    assert {r.keep_id for r in got.values()} == {4}
    assert [k for k, r in got.items() if r.kept] == [4]


def test_exact_empty_table(make):
    assert exactdup.exact_duplicates(make([(1, "a")]).limit(0)).count() == 0


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def near_brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {(rows[i][0]): (len(sets[i]), min(groups[find(i)])) for i in range(len(rows))}


def edited(r, words, count):
    out = words[:]
    for _ in range(count):
        out[r.randrange(len(out))] = f"new{r.randrange(10**6)}"
    return " ".join(out)


def test_near_families_match_brute_force(make):
    r = random.Random(2)
    rows = []
    for family in range(6):
        words = [f"w{r.randrange(4000)}" for _ in range(r.choice([12, 60, 300]))]
        rows += [(len(rows) + i + 1000 * family, edited(r, words, r.randint(0, max(1, len(words) // 25)))) for i in range(25)]
    want = near_brute(rows, 3, 85)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(make(rows), width=3, percent=85).collect()}
    assert got == want


def test_near_chain_of_copies(make):
    words = [f"w{i}" for i in range(200)]
    chain = []
    for i in range(12):
        chain.append((i, " ".join(words)))
        for j in range(4):
            words[i * 16 + j] = f"x{i}.{j}"
    want = near_brute(chain, 3, 85)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in neardup.near_duplicates(make(chain), width=3, percent=85).collect()}
    assert got == want and len({c for _, c in got.values()}) == 1


def test_near_odd_rows(odd):
    got = neardup.near_duplicates(odd).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 12
    assert by[1].n_shingles == 0 and by[1].kept and by[2].kept and by[3].kept
    assert by[5].component_id == 4 and not by[5].kept
    assert by[8].component_id == 7
    assert by[None].component_id is None and by[None].kept


def test_near_empty_table(make):
    assert neardup.near_duplicates(make([(1, "a")]).limit(0)).count() == 0
