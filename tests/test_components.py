"""Connected components: exact labels in a number of rounds that is
logarithmic in the length of a path, with no cap."""

import math
import random

import pytest

from locus.operators.components import connected_components, contract


def path_edges(labels):
    return list(zip(labels, labels[1:]))


def orders(n):
    rng = random.Random(7)
    shuffled = list(range(n))
    rng.shuffle(shuffled)
    return {
        "least at the far end": list(range(n - 1, -1, -1)),
        "zigzag": [i // 2 if i % 2 else n - 1 - i // 2 for i in range(n)],
        "shuffled": shuffled,
    }


@pytest.mark.parametrize("kind", sorted(orders(4)))
def test_path_takes_logarithmic_rounds(spark, kind):
    n = 2000
    edges = spark.createDataFrame(path_edges(orders(n)[kind]), "src long, dst long")
    stars, rounds = contract(edges)
    assert stars.filter("b != 0").count() == 0
    assert stars.count() == n - 1
    assert rounds <= 2 * math.log2(n)


def test_random_graph_matches_union_find(spark):
    rng = random.Random(3)
    n, pairs = 400, [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = connected_components(spark.range(n).toDF("node"),
                               spark.createDataFrame(pairs, "src long, dst long"))
    assert {r["node"]: r["label"] for r in got.collect()} == {i: find(i) for i in range(n)}


def test_no_edges(spark):
    got = connected_components(spark.range(3).toDF("node"),
                               spark.createDataFrame([], "src long, dst long"))
    assert sorted(map(tuple, got.collect())) == [(0, 0), (1, 1), (2, 2)]
