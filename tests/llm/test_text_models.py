import itertools
import math
import random

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from locuslens.llm import html, langid, licenses, pieces, tokencount


def brute_marginals(page, unary, edge):
    n = len(page.parent)
    total, content = 0.0, np.zeros(n)
    for states in itertools.product((0, 1), repeat=n):
        score = sum(unary[f] for i in range(n) if states[i] for f in page.features[i])
        score += sum(edge[page.relation[i]][2 * states[page.parent[i]] + states[i]] for i in range(1, n))
        total += math.exp(score)
        content += np.array(states) * math.exp(score)
    return content / total, math.log(total)


def test_sum_product_is_exact():
    page = html.Page("<body><nav><a href=x>a</a></nav><article><h1>t</h1><p>one two.<p class='ad'>x</article><footer>f</footer></body>")
    model = html.fit()
    want, log_z = brute_marginals(page, *model)
    got, _, own_z = html.marginals(page, *model)
    assert np.allclose(got, want) and abs(own_z - log_z) < 1e-9


def test_held_out_pages():
    model, wrong, nodes = html.fit(), 0, 0
    for source in html.labelled_pages(60, 12345):
        page = html.Page(source)
        content = html.marginals(page, *model)[0]
        for c, y, f in zip(content, page.label, page.features, strict=True):
            if html.INDEX["no text"] not in f:
                nodes, wrong = nodes + 1, wrong + ((c >= 0.5) != bool(y))
    assert wrong / nodes < 0.03


def test_extraction_rows(spark):
    rows = [
        (1, "u", "<html><head><title>no</title><style>p{}</style></head><body><nav><ul><li><a href=/>menu</a></ul></nav><div class=ad>buy</div><article><h1>A  title</h1><p><b>One&amp;two &eacute;<br>three<p>f<i>ou</i>r</article><script>var t='</p>';</script><footer>&copy; x</footer>"),
        (2, "u", None), (3, "u", ""), (4, "u", "<<<>><p"), (5, None, "<article><p>" + "long text here. " * 20_000 + "</article>"), (1, "u", "<article><p>again and again it says.</p></article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [(r.page_id, r.text, r.n_chars) for r in html.extract_main_text(pages).collect()]
    assert len(got) == 6
    assert got[0][1] == "A title One&two é three four"
    assert got[1][1:] == ("", 0) and got[2][1:] == ("", 0)
    assert got[4][2] == 20_000 * 16 - 1
    assert html.extract_main_text(pages.limit(0)).count() == 0


def test_languages(spark, make, odd):
    r = random.Random(3)
    stems = {"en": ["the", "ing", "tion"], "de": ["sch", "ung", "keit"], "fr": ["eau", "oir", "ment"], "es": ["cion", "ado", "que"], "it": ["gli", "zione", "etto"], "nl": ["ij", "oe", "aar"]}
    for count in (6, 3, 2, 1):
        langs = list(stems)[:count]
        docs = make([(i, " ".join("".join(r.choice(stems[lang]) for _ in range(3)) for _ in range(30)), lang) for i, lang in ((i, langs[i % count]) for i in range(300))])
        got = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
        held = [x for x in got if x.held_out]
        assert len(got) == 300 and held
        assert np.mean([x.lang_pred == x.lang for x in held]) > 0.97
        assert all(0 <= x.score <= 1 for x in got)
    got = {x.doc_id: x for x in langid.identify_documents(odd).collect()}
    assert len(got) == 11
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 10))
    assert langid.identify_documents(make([(1, "abc", None)])).collect()[0].lang_pred == "und"


def test_codewords_are_apart():
    for n in (3, 4, 5, 9, 30):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2)]
        assert min(apart) >= 2 and (np.abs(code.sum(0)) < n).all()


@pytest.mark.parametrize("attributes", ['title="The hidden truth"', 'data-state="hidden"', 'data-class="ad"', "data-url='/hidden-gems'", 'title="hidden', "aria-hidden=false", 'data-hidden="true"'])
def test_words_inside_attributes_hide_nothing(attributes):
    page = f"<html><head><title>t</title><body><nav><a href='/'>Home</a></nav><article><h1>Head line</h1><p {attributes}\">First long sentence of the article that a reader wants.</p><p>Second long sentence of it.</p></article></body></html>"
    page = page if attributes.endswith("hidden") else page.replace('\">First', ">First")
    text = html.main_text(page, html.fit())
    assert text == "Head line First long sentence of the article that a reader wants. Second long sentence of it."


def test_hidden_blocks_go():
    page = "<html><head></head><body><article><h1>Head</h1><p hidden>gone one.</p><p style='display: none'>gone two.</p><p aria-hidden='true'>gone three.</p><p>Kept sentence of the article.</p></article></body></html>"
    assert html.main_text(page, html.fit()) == "Head Kept sentence of the article."


@pytest.fixture(scope="module")
def lattices():
    return pieces.worker_lattices(pieces.MODEL, 1.0)


def all_segmentations(v, unit):
    if not unit:
        return [((), 0.0)]
    out = []
    for j in range(1, len(unit) + 1):
        if unit[:j] in v.weight:
            out += [((v.ids[unit[:j]], *rest), v.weight[unit[:j]] + w) for rest, w in all_segmentations(v, unit[j:])]
    if unit[0] not in v.weight:
        data = unit[0].encode()
        out += [((*(v.byte_id[b] for b in data), *rest), v.byte_weight * len(data) + w) for rest, w in all_segmentations(v, unit[1:])]
    return out


@pytest.mark.parametrize("steps", [1, 48])
def test_samples_without_replacement(lattices, monkeypatch, steps):
    monkeypatch.setattr(pieces, "STEPS", steps)
    text, n = "an ice\t▁z", 6000
    product = [((), 0.0)]
    for unit in pieces.UNIT.findall(" " + text):
        product = [(a + b, x + y) for a, x in product for b, y in all_segmentations(lattices.vocabulary, unit)]
    norm = math.log(sum(math.exp(w) for _, w in product))
    chance = {ids: math.exp(w - norm) for ids, w in product}
    assert len(chance) == len(product)
    first, pairs, mass = {}, {}, 0.0
    for a, b, c in pieces.sample_texts([text] * n, [xxhash.xxh3_64_intdigest(str(i)) for i in range(n)], 3, lattices):
        ids = [tuple(x[0].tolist()) for x in (a, b, c)]
        assert len(set(ids)) == 3 and a[2] > b[2] > c[2]
        for x, own in zip((a, b, c), ids, strict=True):
            assert abs(math.exp(x[1]) - chance[own]) < 1e-9
            mass += math.exp(x[1] - x[3]) / n
        first[ids[0]] = first.get(ids[0], 0) + 1
        pairs[ids[1]] = pairs.get(ids[1], 0) + 1
    for own, p in chance.items():
        assert abs(first.get(own, 0) / n - p) < 5 * math.sqrt(p / n) + 2e-3
        second = sum(q * p / (1 - q) for other, q in chance.items() if other != own)
        assert abs(pairs.get(own, 0) / n - second) < 5 * math.sqrt(second / n) + 2e-3
    assert abs(mass - 1) < 0.05  # inclusion scores weigh the sample without bias


def test_lattice_cache(lattices, monkeypatch):
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("abcdeé\n") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 60))) for _ in range(40)]
    same = lambda xs, ys: all(np.array_equal(a[0], b[0]) and a[1:] == b[1:] for x, y in zip(xs, ys, strict=True) for a, b in zip(x, y, strict=True))
    want = pieces.sample_texts(texts, list(range(40)), 2, lattices)
    monkeypatch.setattr(pieces, "CACHE_NODES", 300)
    monkeypatch.setattr(pieces, "PART", 50)
    small = pieces.Lattices(lattices.vocabulary)  # thinned out again and again, a few characters at a time
    for _ in range(3):
        assert same(want, [pieces.sample_texts([t], [i], 2, small)[0] for i, t in enumerate(texts)])
    clash = pieces.Lattices(lattices.vocabulary)
    clash.power = np.zeros(100, np.uint64)  # all units of one length share a hash
    assert same(want, pieces.sample_texts(texts, list(range(40)), 2, clash))


def test_pieces_round_trip(odd, make):
    drawn = pieces.decode_ids(pieces.encode_samples(odd, k=3, carry=("text",))).collect()
    assert {r.doc_id for r in drawn} == {r.doc_id for r in odd.collect()}
    assert all((r.decoded or "") == (r.text or "") for r in drawn)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(model.decode(list(r.ids)) == r.text for r in drawn if r.text and "▁" not in r.text)
    again = {(r.doc_id, r["sample"]): r.perturbed for r in pieces.encode_samples(odd.repartition(5), k=3).collect()}
    assert again == {(r.doc_id, r["sample"]): r.perturbed for r in drawn}
    assert pieces.encode_samples(make([(1, "a")]).limit(0)).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 16])
def test_token_counts(odd, block_bytes):
    blocks, manifest = tokencount.write_flat(odd.repartition(3), block_bytes=block_bytes) if block_bytes > 60 else tokencount.write_flat(odd.where("doc_id < 7 or doc_id > 8").repartition(2), block_bytes=block_bytes)
    found = manifest.join(tokencount.separator_scan(blocks), ["file_id", "ordinal"])
    encode = tokencount.encoder(tokencount.VOCABULARY).encode_ordinary
    want = sorted((str(r.doc_id), len(encode(r.text or ""))) for r in odd.collect() if block_bytes > 60 or (r.doc_id is not None and r.doc_id not in (7, 8)))
    assert sorted((str(r.doc_id), r.n_tokens) for r in found.collect()) == want


def test_unfinished_tail(spark):
    flat = np.array([5, 6, tokencount.SEPARATOR, tokencount.SEPARATOR, 7], "<u2").tobytes()
    blocks = spark.createDataFrame([(0, i, flat[i * 4 : i * 4 + 4]) for i in range(3)], "file_id int, block_no long, payload binary")
    got = sorted((r.ordinal, r.n_tokens, r.complete) for r in tokencount.separator_scan(blocks).collect())
    assert got == [(0, 2, True), (1, 0, True), (2, 1, False)]


def test_licenses(make, odd):
    import re

    r = random.Random(9)
    filler = lambda n: " ".join(f"word{r.randrange(999)}" for _ in range(n))
    rows = []
    for i, (_, notice) in enumerate(licenses.TEMPLATES * 12):
        words = notice.split()
        if i % 3 == 1 and len(words) > 25:
            words[-1] = "changed"
        rows.append((i, f"{filler(r.randint(0, 40))}\n{' '.join(words)} {filler(r.randint(0, 40))}"))
    rows += [(1000, None), (1001, "MIT"), (1002, "Released under the MIT"), (1000, "Released under the MIT License. Released under the MIT License.")]
    grams = lambda t: [tuple(w[i : i + 5]) for w in [re.findall("[a-z0-9]+", (t or "").lower())] for i in range(max(0, len(w) - 4))]
    want = set()
    for key, text in rows:
        own = set(grams(text))
        for name, notice in licenses.TEMPLATES:
            t = set(grams(notice))
            if len(t & own) / len(t) >= 0.8:
                want.add((key, name, len(t & own)))
    got = [(x.doc_id, x.license, x.hits) for x in licenses.scan_licenses(make(rows)).collect()]
    assert len(got) == len(want) and set(got) == want
    assert licenses.scan_licenses(odd).count() == 0
