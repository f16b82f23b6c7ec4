import random

import corpus_pipeline
from locuslens.llm import mix


def deviation(make):
    """Largest share by which the words of a source miss its target after whole copies."""
    r = random.Random(3)
    docs = make([(i, " ".join(["w"] * r.randint(100, 900)), "en", f"s{i % 7}") for i in range(1400)])
    targets = {x.source: x.target for x in mix.mix_documents(docs).select("source", "target").distinct().collect()}
    words = dict.fromkeys(targets, 0)
    for x in corpus_pipeline.mix_stage(docs.sparkSession, docs.drop("size"), "").collect():
        words[x.source] += len(x.text.split())
    return max(abs(words[s] - t) / t for s, t in targets.items())


def test_whole_copies_meet_the_targets(make):
    assert deviation(make) < 0.01
