import random

from plumage.llm.components import components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60, 90)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(200, i) for i in range(201, 230)] + [(7, 7)]
    parent = {}

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v
    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {v: find(v) for v in parent}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
