"""Alignment of whole reads and allele tables against plain dynamic programs, cell by cell."""

import random
import re

import numpy as np
import pytest

from locuslens.operators import classify, control, realign
from locuslens.operators.alleletables import bounds

BASES = "ACGT"


def mutated(r, text, most):
    out = list(text)
    for _ in range(r.randint(0, most)):
        i, k = r.randint(0, len(out)), r.randint(1, 8)
        if r.random() < 0.5:
            out[i:i] = [r.choice(BASES) for _ in range(k)]
        else:
            del out[i : i + k]
    return "".join(out) or "A"


def plain_cigar(t, q):
    """Three tables over all cells, walked back with a match first."""
    never = -(10**9)
    width, height = len(t), len(q)
    m, i, d = ([[never] * (height + 1) for _ in range(width + 1)] for _ in range(3))
    m[0][0] = 0
    for x in range(width + 1):
        for y in range(height + 1):
            if x and y:
                unknown = (t[x - 1] == "N") + (q[y - 1] == "N")
                score = (5 if t[x - 1] == q[y - 1] else -4) if not unknown else -2 if unknown == 1 else -1
                m[x][y] = max(m[x - 1][y - 1], i[x - 1][y - 1], d[x - 1][y - 1]) + score
            if y:
                i[x][y] = max(m[x][y - 1] - 10, i[x][y - 1] - 1)
            if x:
                d[x][y] = max(m[x - 1][y] - 10, d[x - 1][y] - 1)
    x, y, ops = width, height, []
    state = max("MID", key=lambda s: {"M": m, "I": i, "D": d}[s][x][y])
    while x or y:
        ops.append(state)
        if state == "M":
            x, y = x - 1, y - 1
            state = max("MID", key=lambda s: {"M": m, "I": i, "D": d}[s][x][y])
        elif state == "I":
            y -= 1
            state = "M" if m[x][y] - 10 >= i[x][y] - 1 else "I"
        else:
            x -= 1
            state = "M" if m[x][y] - 10 >= d[x][y] - 1 else "D"
    text = "".join(reversed(ops)).strip("D")
    return "".join(f"{len(run)}{run[0]}" for run in re.findall(r"M+|I+|D+", text))


def test_global_alignment_equals_the_plain_program():
    r = random.Random(3)
    slices = ["".join(r.choice("ACGTN" if r.random() < 0.1 else BASES) for _ in range(r.randint(1, 50))) for _ in range(150)]
    reads = [mutated(r, t, 4) for t in slices]
    want = [plain_cigar(t, q) for t, q in zip(slices, reads, strict=True)]
    assert realign.align_globally(slices, reads) == want
    assert realign.align_globally(slices, reads, cells=2000) == want, "rows between kept ones are computed again"
    assert realign.align_globally(slices, reads, cells=1) == want


def test_empty_and_long_pairs():
    assert realign.align_globally(["ACGT"], [""]) == [""]
    r = random.Random(5)
    genome = "".join(r.choice(BASES) for _ in range(60_000))
    read = genome[100:180] + genome[50_000:50_070]
    assert realign.align_globally([genome[100:50_070]], [read]) == ["80M49820D70M"]


GENOME = "".join(random.Random(21).choices(BASES, k=4000))


@pytest.fixture(scope="module")
def tiles(spark):
    from locuslens.operators import intervals

    return intervals.reference_tiles(spark.createDataFrame([("chr1", i, GENOME[i * 32 : i * 32 + 32]) for i in range(125)], "chrom string, chunk long, bases string"))


def test_reads_of_unspliced_parts_are_realigned(spark, tiles):
    """Both sides; the supplementary part claims fewer or more bases than the clip, so the parts cannot be spliced."""
    columns = "sample string, qname string, flag int, chrom string, pos long, end long, mapq int, cigar string, mate_chrom string, mate_pos long, seq string, nm long, sa string, ordinal long"
    row = lambda name, cigar, pos, end, seq, sa: ("edited", name, 3, "chr1", pos, end, 60, cigar, "chr1", 2000, seq, 0, sa, 0)
    left = GENOME[950:980] + GENOME[1030:1100]
    right = GENOME[950:1020] + GENOME[1070:1100]
    reads = [
        row("left", "30S70M", 1030, 1100, left, "chr1,951,+,28M72S,60,0;"),
        row("right", "70M30S", 950, 1020, right, "chr1,1073,+,72S28M,60,0;"),
        row("spliced", "30S70M", 1030, 1100, left, "chr1,951,+,30M70S,60,0;"),
        row("uncovered", "30S70M", 1030, 1100, left, "chr1,951,+,28M72S,60,0;")[:3] + ("chr2", *row("uncovered", "30S70M", 1030, 1100, left, "chr2,951,+,28M72S,60,0;")[4:]),
    ]
    locus = spark.createDataFrame([("L", "chr1", 1000, 1060), ("M", "chr2", 1000, 1060)], "locus string, locus_chrom string, locus_start long, locus_end long")
    pairs = classify.reads_in_loci(spark.createDataFrame(reads, columns), locus, 100)
    got = {r.qname: r for r in classify.classify(pairs, tiles).collect()}
    for name, seq, slice_, start in (("left", left, GENOME[950:1100], 951), ("right", right, GENOME[950:1100], 951)):
        cigar = plain_cigar(slice_, seq)
        lead, gone = (int(n) for n in re.match(r"(\d+)M(\d+)D", cigar).groups())
        assert gone == 50 and (got[name].type, got[name].pos) == ("INDEL", start + lead)
        assert got[name].ref == GENOME[start + lead - 1 : start + lead + gone]
    assert got["spliced"].type == "INDEL" and len(got["spliced"].ref) == 51
    own = {r.qname: r.type for r in classify.classify(pairs, tiles, realigns=False).collect()}
    assert own["left"] != "INDEL" and own["spliced"] == "INDEL"
    assert got.get("uncovered") is None or got["uncovered"].type != "INDEL"


def test_tables_bound_the_scores():
    """The bound across an allele is never below its score if that beats the reference, the other never above; most pairs are decided by them."""
    r = random.Random(30)
    alleles = []
    for _ in range(25):
        at, gone = r.randint(400, 460), r.choice((0, 0, 1, 2, 5, 30, 200))
        new = "".join(r.choice(BASES) for _ in range(r.choice((0, 1, 3, 20)))) if gone % 2 == 0 else ""
        alleles.append((at, at + 1 + gone, GENOME[at] + new, GENOME[at - 150 : at + 1 + gone + 150]))
    reads = []
    for _ in range(40):
        at, _, bases, hap = r.choice(alleles)
        edited = hap[:150] + bases + hap[-150:]
        a = r.randint(60, 140)
        reads.append(mutated(r, (edited if r.random() < 0.5 else hap)[a : a + r.randint(40, 150)], 2))
    reads += ["".join(r.choice(BASES) for _ in range(n)) for n in (1, 30, 96, 150)] + [GENOME[250:640]]
    seen, passed, truth = 0, 0, 0
    for own, (over, under) in bounds(reads, alleles, 150):
        for j, i in enumerate(own):
            for k, (_, _, bases, hap) in enumerate(alleles):
                to_ref = control.best_scores([reads[i]], [hap])[0]
                to_alt = control.best_scores([reads[i]], [hap[:150] + bases + hap[-150:]])[0]
                assert under[k, j] <= to_ref
                assert over[k, j] >= to_alt or to_alt <= to_ref
                seen += 1
                passed += over[k, j] - 5 > under[k, j]
                truth += to_alt - 5 > to_ref
    assert seen == 45 * 25 and truth > 20 and passed < seen / 5
    assert np.array_equal(control.best_scores(["ACGT"], ["ACGT"]), [20])
