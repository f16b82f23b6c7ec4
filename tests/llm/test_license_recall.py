"""Licence scans near the threshold, against brute force over all templates."""

import random
import re

from locuslens.llm import licenses


def grams(text):
    words = re.findall("[a-z0-9]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_recall_with_spread_edits(make):
    """Passages with words replaced, dropped or added anywhere, of which at least four fifths of the shingles are left."""
    r = random.Random(21)
    long = " ".join(f"clause{r.randrange(400)}" for _ in range(160))
    templates = (*licenses.TEMPLATES, ("long-one", long), ("long-two", " ".join(f"term{r.randrange(300)}" for _ in range(60))))
    own = {name: grams(notice) for name, notice in templates}
    rows, want = [], set()
    while len(rows) < 600:
        name, notice = r.choice([t for t in templates if len(own[t[0]]) > 4])
        words = notice.split()
        for _ in range(r.randint(1, 1 + len(words) // 25)):
            at = r.randrange(len(words))
            words[at : at + 1] = r.choice([[f"other{r.randrange(99)}"], [], [words[at], "added"]])
        before, after = (" ".join(f"filler{r.randrange(999)}" for _ in range(r.randint(0, 60))) for _ in range(2))
        text = f"{before} {' '.join(words)} {after}"
        share = {n: len(g & grams(text)) / len(g) for n, g in own.items() if g}
        if 0.8 <= share[name] < 1:
            want |= {(len(rows), n) for n, x in share.items() if x >= 0.8}
            rows.append((len(rows), text))
    got = {(x.doc_id, x.license) for x in licenses.scan_licenses(make(rows), templates=templates).collect()}
    assert got <= want
    assert len(got) >= 0.99 * len(want), (len(got), len(want))
