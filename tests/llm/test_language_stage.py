import random

import corpus_pipeline

WORDS = {
    "en": "the of and to in is that for with was have this from they which there house water people morning".split(),
    "de": "der die und nicht mit sich auch eine werden haben nach durch wasser zwischen schon gegen heute abend".split(),
    "fr": "le les des dans que pour une sur avec sont cette mais nous vous leur être eau maison toujours matin".split(),
    "es": "el los del que para una con por como más pero sus este todo también agua casa siempre mañana entre".split(),
}
STRANGE = [(9001, "Это простой русский текст о погоде и природе в нашем городе сегодня вечером"), (9002, "今天天气很好我们一起去公园散步吧然后回家吃饭"), (9003, "qzx wvk jjjq xxzp kkwv qqqz zzxk vvwp"), (9004, "Το γρήγορο καφέ αλεπού πηδά πάνω από το σκυλί")]


def test_language_stage_rejects_what_was_not_learned(make):
    r = random.Random(6)
    clean = [(i, " ".join(r.choices(WORDS[lang], k=30)), lang) for i, lang in enumerate(list(WORDS) * 50)]
    docs = make(clean + [(i, text, None) for i, text in STRANGE])
    assert {x.doc_id for x in corpus_pipeline.language_stage(docs.sparkSession, docs, "").collect()} == set(range(200))
