import random

import numpy as np
import pytest

from terrane.llm import components


def _brute(pairs):
    parent = {}

    def root(v):
        parent.setdefault(v, v)
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {v: root(v) for v in parent}


RND = random.Random(2)
GRAPHS = {
    "empty": [], "nulls": [(None, 1), (2, None), (None, None)], "loop": [(5, 5), (5, 6), (8, 8)], "repeats": [(1, 2), (2, 1), (1, 2)],
    "chain": [(i, i + 1) for i in range(30)], "star": [(10_000, i) for i in range(3000)] + [(9_999, 10_000)],
    "random": [(RND.randrange(400), RND.randrange(400)) for _ in range(260)], "negative": [(-5, 3), (3, -9), (2**40, 2**41)],
}


@pytest.mark.parametrize(
    "name,small,few",
    [(n, components.SMALL_EDGES, 0) for n in GRAPHS] + [("star", 0, 10**6), ("random", 0, 10**6), ("chain", 0, 0), ("chain", 0, 12)],
)
def test_against_union_find(spark, monkeypatch, name, small, few):
    """Every level by joins, with rounds that rewrite all labels or only the changed ones, and small levels within one task."""
    monkeypatch.setattr(components, "BROADCAST_ROWS", few)
    df = spark.createDataFrame(GRAPHS[name], "u long, w long")
    got = [tuple(r) for r in components.components(spark, df, small).collect()]
    assert len(got) == len(dict(got)) and dict(got) == _brute(GRAPHS[name])


def test_hot_lookup_is_whole(spark):
    big = spark.createDataFrame([(1, i) for i in range(5000)] + [(2, 1), (3, 1)], "k long, x long")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k long, y string")
    assert components._hot(big.groupBy("k").count(), "k", "count") == [1]
    assert components.lookup(big, small, "k", [1]).count() == 5001 and components.lookup(big, small, "k", [1], "left").count() == 5002


def test_low_diameter():
    """Shares of edges that outlive a level, rounds of growth and levels, on a long path and a star."""
    n = 50_000
    names, roots, told = components.decompose(np.arange(n - 1), np.arange(1, n))
    assert len(names) == n and len(set(roots)) == 1
    assert told[0][0] < 1 - np.exp(-components.BETA) and told[0][1] < 4 * np.log(n) / components.BETA and len(told) <= 12
    _, roots, told = components.decompose(np.zeros(n - 1, dtype=np.int64), np.arange(1, n))
    assert len(set(roots)) == 1 and len(told) <= 3


def test_growth_reaches_the_first(spark):
    """Each vertex is in the cluster whose start plus distance is least."""
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 150), rng.integers(0, 60, 150)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    start = components.shifts(60, rng, 0.3)
    dist = np.full((60, 60), np.inf)
    dist[np.arange(60), np.arange(60)] = 0
    dist[a, b] = np.minimum(dist[a, b], (a != b).astype(float))
    for k in range(60):
        dist = np.minimum(dist, dist[:, [k]] + dist[[k], :])
    center, _ = components.grow_once(60, a, b, start)
    assert (center == (start[:, None] + dist).argmin(axis=0)).all()
