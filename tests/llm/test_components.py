import random

from fareweave.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {a: find(a) for a in parent}


def test_against_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, 1000 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(60)] + [(7, 7), (-5, 3), (3, -5)]
    rows = edges + [(None, 4), (4, None)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {n: c for n, c in brute([e for e in edges if e[0] != e[1]]).items()}


def test_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
