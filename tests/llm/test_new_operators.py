"""Vector codes, packing and the Merkle manifest against plain Python."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from locuslens.llm import merkle, packing, vectorcodes

VECTORS = "vec_id long, embedding array<float>, label int, code string, error string, ints string"


def naive_codes(rows, parts=8, entries=16, rounds=6):
    """Full search over all entries with unbounded integers."""
    kept = [(k, [math.floor(4096 * float(x)) for x in v], label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in kept), default=0)
    size = -(-longest // parts)
    kept = [(k, v + [0] * (size * parts - len(v)), label) for k, v, label in kept]
    cells = lambda v: [v[i * size : (i + 1) * size] for i in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cells(v)[i] for _, v, _ in first] for i in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda i, x: min((far(x, c), e) for e, c in enumerate(books[i]))
    for _ in range(rounds):
        sums = [defaultdict(lambda: [0] * size) for _ in range(parts)]
        counts = [Counter() for _ in range(parts)]
        for _, v, _ in kept:
            for i, x in enumerate(cells(v)):
                _, e = nearest(i, x)
                counts[i][e] += 1
                sums[i][e] = [a + b for a, b in zip(sums[i][e], x, strict=True)]
        for i in range(parts):
            for e, n in counts[i].items():
                books[i][e] = [s // n for s in sums[i][e]]
    out, by_label = [], Counter()
    for k, v, label in kept:
        best = [nearest(i, x) for i, x in enumerate(cells(v))]
        error = sum(d for d, _ in best)
        by_label[label] += error
        out.append((k, "".join(f"{e:02x}" for _, e in best), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted([(k, c, min(e, 2**63 - 1), min(by_label[label], 2**63 - 1), digest) for k, c, e, label in out], key=str)


def coded(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)
    return sorted([(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vectorcodes.compress(df, **how).collect()], key=str)


def vectors(r, n, dim, scale=1.0):
    grid = lambda: [float(np.float32(r.gauss(0, scale))) for _ in range(dim)]
    return [(i, grid(), r.choice([None, 0, 1])) for i in range(n)]


def test_codes_equal_full_search(spark):
    r = random.Random(1)
    rows = vectors(r, 150, 24)
    rows += rows[:9] + [(None, rows[3][1], 5), (900, [0.5] * 24, None), (901, None, 1), (902, [float("nan")] + [0.0] * 23, 1), (903, [float("inf")] + [0.0] * 23, 1), (904, [None] + [0.0] * 23, 2), (905, [-1e-9] * 24, 2)]
    assert coded(spark, rows) == naive_codes(rows)
    shuffled = rows[:]
    r.shuffle(shuffled)
    assert coded(spark, shuffled) == naive_codes(rows), "ties of equal keys go by their vectors"


def test_codes_of_odd_lengths_few_and_huge(spark):
    r = random.Random(2)
    assert coded(spark, []) == []
    few = vectors(r, 5, 16)
    assert coded(spark, few) == naive_codes(few)
    mixed = [(i, v[: r.choice([0, 3, 8, 13])], label) for i, v, label in vectors(r, 40, 16)]
    assert coded(spark, mixed) == naive_codes(mixed)
    empty = [(1, [], None), (2, [], 3)]
    assert coded(spark, empty) == naive_codes(empty)
    huge = [(i, [float(np.float32(x * 1e7)) for x in v], label) for i, v, label in vectors(r, 40, 8)]
    assert coded(spark, huge) == naive_codes(huge)
    assert len(coded(spark, [(1, [3e38, -3e38] * 4, None), (2, [1.0] * 8, None)])) == 2


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_equal_average_search_is_exact(data):
    size = data.draw(st.integers(1, 4))
    value = st.integers(-6, 6) | st.integers(-(2**62), 2**62)
    grid = lambda n: np.array(data.draw(st.lists(st.lists(value, min_size=size, max_size=size), min_size=n, max_size=n)), np.int64).reshape(n, size)
    rows, book = grid(5), grid(data.draw(st.integers(1, 9)))
    index, distance = vectorcodes.nearest(rows, book)
    for x, i, d in zip(rows.tolist(), index, distance, strict=True):
        assert (int(d), int(i)) == min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book.tolist()))


def test_search_stops_early():
    """Distances of far entries are never computed."""
    book = np.array([[10**6 * i, 10**6 * i] for i in range(16)], np.int64)
    rows = np.array([[5 * 10**6 + 3, 5 * 10**6 - 3]], np.int64)
    index, distance = vectorcodes.nearest(rows, book)
    assert (index[0], distance[0]) == (5, 18)


# ---- packing ------------------------------------------------------------------------------------------
def check_packing(docs, capacity=packing.CAPACITY):
    rows = packing.pack(docs, capacity=capacity).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in docs.collect():
        ids = [*tokens.encode(r.text or "", add_special_tokens=False).ids, packing.END]
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            want[(r.doc_id, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return rows, sequences


def test_packing_by_the_tokenizer(odd, make):
    check_packing(odd)
    rows, _ = check_packing(odd, capacity=64)
    assert len({r.sequence_id for r in rows}) < len(rows)
    assert packing.pack(make([])).collect() == []
    tricky = make([(1, "<|endoftext|> a<|endoftext|>"), (2, " \n \t  x  "), (3, "\u200b\u00a0\u3000 \U0001f600\u0301"), (4, " " * 5000 + "a"), (5, "a" * 20000), (5, "can't we'll I'M \u2019s 12345 \u0661\u0662")])
    check_packing(tricky)


def test_padding_is_small(make):
    r = random.Random(6)
    docs = make([(i, " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(r.randint(1, 700)))) for i in range(600)])
    rows, sequences = check_packing(docs)
    total = sum(r.length for r in rows)
    pad = sum(packing.CAPACITY - n for n in (sum(length for _, length in parts) for parts in sequences.values()) if n & (n - 1))
    assert pad < 0.02 * total
    assert pad == packing.padding(Counter(r.length for r in rows))[0]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 10**12), max_size=40))
def test_patterns_hold_every_piece(counts):
    """Trillions of pieces take no more steps than a few, and every length has exactly its places."""
    patterns = packing.pack_histogram(counts, 40)
    assert len(patterns) <= 2 * 40
    held = Counter()
    for n, lengths in patterns:
        assert sum(length * times for length, times in lengths) <= 40
        for length, times in lengths:
            held[length] += n * times
    assert held == Counter(counts)
    places = Counter()
    for length, first, n, _, _, _ in packing.slots(patterns):
        assert first == places[length]
        places[length] += n
    assert places == Counter(counts)


def test_shortest_pack_first():
    assert packing.pack_histogram({7: 1, 5: 1, 3: 1, 2: 1}, 10) == [(1, [(7, 1), (2, 1)]), (1, [(5, 1), (3, 1)])]


# ---- Merkle manifest ----------------------------------------------------------------------------------
def naive_manifest(rows, arity=3):
    """Trees as nested lists, folded level by level."""
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    text = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r, body: h(*map(text, (r.doc_id, r.source, r.lang, r.n_chars, body)))
    trees = defaultdict(list)
    for r in rows:
        altered = r.text
        if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            altered = r.text.replace("\n", "")
        trees[r.source].append((r.doc_id, leaf(r, r.text), leaf(r, altered)))

    def climb(leaves):
        paths, level, places = [[] for _ in leaves], leaves, list(range(len(leaves)))
        while len(level) > 1:
            runs = [level[i : i + arity] for i in range(0, len(level), arity)]
            for p, i in zip(paths, places, strict=True):
                run = runs[i // arity]
                p.append(("".join(run[: i % arity]), "".join(run[i % arity + 1 :])))
            level, places = [h(*run) for run in runs], [i // arity for i in places]
        return level[0], paths

    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        built[name] = climb([x for _, x, _ in trees[name]])
    root, tops = climb([built[n][0] for n in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        sub, paths = built[name]
        for (key, own, altered), path in zip(trees[name], paths, strict=True):
            whole, folded = path + top, altered
            for a, b in whole:
                folded = h(a, folded, b)
            out.append((key, own, sub, root, h(*(x for p in whole for x in p)), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("span", [1, 2, 6])
def test_manifest_equals_nested_trees(spark, make, odd, span):
    r = random.Random(span)
    counts = [1, 2, 3, 4, 9, 10, 28, 82]
    rows = [(i, "line\n" * r.randint(0, 3) + str(i), "en", f"s{n}") for n in counts for i in range(n * 100, n * 101)]
    rows += [(7, "same\n", "en", "copies")] * 12 + [(None, "none\n", None, None), (5, None, None, None), (5, None, None, "\u00e9"), (5, "", "de", "")]
    for docs in (make(rows), odd, make(rows[:1]), make([])):
        found = merkle.prove(docs, tampered=merkle.without_newlines(), span=span)
        got = sorted([(x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256, x.folded_root, x.verified) for x in found.collect()], key=str)
        assert got == naive_manifest(docs.collect())


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(2, 4))
def test_positions_are_the_order_of_completion(n, arity):
    """A plain append log that completes a node as soon as its last child is there."""
    shape = merkle.Shape(n, arity)
    log = []
    for i in range(n):
        log.append((0, i))
        level, index = 0, i
        while level < shape.height() and index + 1 == shape.run(level, index).stop:
            level, index = level + 1, index // arity
            log.append((level, index))
    assert [shape.position(*node) for node in log] == list(range(len(log)))
    assert log[-1] == (shape.height(), 0) and len(log) == sum(shape.width(level) for level in range(shape.height() + 1))


def test_logs_hold_every_node_once(make):
    docs = make([(i, str(i), "en", "big" if i % 5 else "small") for i in range(200)])
    _, sources, logs = merkle.manifest(docs, span=2)
    nodes = [(x.tree, x.pos, x.level, x.idx) for log in logs for x in log.collect()]
    for tree, n in [(x.tree, x.n) for x in sources.collect()]:
        shape = merkle.Shape(n)
        own = sorted(node for node in nodes if node[0] == tree)
        assert [pos for _, pos, _, _ in own] == list(range(sum(shape.width(level) for level in range(shape.height() + 1))))
        assert all(shape.position(level, idx) == pos for _, pos, level, idx in own)


def test_a_changed_row_fails_its_proof(make):
    rows = [(i, f"a\nb {i}", "en", f"s{i % 4}") for i in range(60)]
    found = {x.doc_id: x.verified for x in merkle.prove(make(rows), tampered=merkle.without_newlines()).collect()}
    assert {k for k, v in found.items() if not v} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 2 == 0}
    assert len(list(itertools.chain(found))) == 60
