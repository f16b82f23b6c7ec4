"""Late links are followed between whole components, not along the links found before."""

import random

from locuslens.llm import common


def brute(edges):
    """The smallest reachable vertex of every vertex."""
    out = {v: v for e in edges for v in e}
    for _ in out:
        for a, b in edges:
            out[a] = out[b] = min(out[a], out[b])
    return out


def test_late_links_join_components(spark):
    r = random.Random(51)
    pair = lambda: tuple(r.sample(range(60), 2))
    first, late = [pair() for _ in range(25)], [pair() for _ in range(15)]
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    labels = common.joined_components(common.connected(frame(first), "first"), frame(late), "late")
    assert {x.id: x.component for x in labels.collect()} == brute(first + late) and labels.count() == len(brute(first + late))


def test_late_links_do_not_walk_the_early_ones(spark, monkeypatch):
    followed, walk = [], common.connected
    labels = walk(spark.createDataFrame([(0, i) for i in range(1, 500)] + [(600, i) for i in range(601, 700)], "a long, b long"), "stars")
    monkeypatch.setattr(common, "connected", lambda edges, name: followed.append(edges.count()) or walk(edges, name))
    joined = common.joined_components(labels, spark.createDataFrame([(7, 650), (650, 9), (3, 4), (900, 901)], "a long, b long"), "late")
    assert followed == [2]
    assert joined.where("component = 0").count() == 600 and joined.where("component = 900").count() == 2
