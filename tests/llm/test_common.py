import random

from inspectra.llm.common import Workspace, components


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(0, 120)]
    star = [(500, i) for i in range(501, 560)] + [(560, 560)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(110)]
    edges = path + star + star + loose
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in components(spark, Workspace(spark, "t"), df).collect()}
    want = {k: v for k, v in brute(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert got == want
    assert components(spark, Workspace(spark, "t"), df.where("false")).count() == 0
