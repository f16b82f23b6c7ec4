"""Stages of the pipeline go by row, not by doc_id alone; short readable texts stay."""

import random

import corpus_pipeline
from locuslens.llm import langid


def words(r, n):
    return " ".join(f"w{r.randrange(500)}" for _ in range(n))


def test_two_texts_of_one_doc_id_are_two_documents(spark, make):
    r = random.Random(50)
    one, two, other = words(r, 120), words(r, 120), words(r, 120)
    near = two.rsplit(" ", 1)[0] + " end"
    docs = make([(1, near), (5, one), (5, two), (7, other), (None, other + " x"), (None, words(r, 50))]).select("doc_id", "text", "lang", "source", "n_chars")
    exact = corpus_pipeline.exact_stage(spark, docs, "")
    assert exact.count() == 6
    kept = sorted((str(x.doc_id), x.text) for x in corpus_pipeline.near_stage(spark, exact, "").collect())
    want = sorted([("1", near), ("5", one), ("7", other), ("None", [x.text for x in docs.collect()][5])])
    assert kept == want, "the copy of a smaller doc_id stays, the other text of the shared doc_id too"
    mixed = corpus_pipeline.mix_stage(spark, exact.where("doc_id = 5"), "").collect()
    assert {x.text for x in mixed} <= {one, two} and len(mixed) == 3, "150 % of two texts of one length are three copies"


def test_short_readable_texts_stay(spark, make):
    r = random.Random(51)
    english, french = ["the", "and", "house", "with", "over"], ["le", "avec", "maison", "pour", "dans"]
    rows = [(i, " ".join(r.choice(w) for _ in range(60)), lang) for i in range(60) for w, lang in ((english, "en"), (french, "fr"))]
    rows += [(900, "Avec.", None), (901, "A. All rights reserved.", None), (902, "Привет, как дела сегодня у вас всех? " * 6, None), (903, "zqxj vbkw pfgh " * 30, None), (904, "1234", None)]
    docs = make([(i, t, lang) for i, (_, t, lang) in enumerate(rows)]).select("doc_id", "text", "lang", "source", "n_chars")
    kept = {x.text for x in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert {t for _, t, lang in rows if lang} | {"Avec.", "A. All rights reserved."} <= kept
    assert not any(t in kept for _, t, lang in rows[-3:])
    assert langid.UNKNOWN == "und"
