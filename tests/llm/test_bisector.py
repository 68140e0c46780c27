from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import bisector

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, vec string"


def rows(n: int = 400, dims: int = 4, seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    middle = [[rng.uniform(-3, 3) for _ in range(dims)] for _ in range(5)]
    out = [(i, [m + rng.gauss(0, 0.5) for m in middle[i % 7 % 5]], 1, 2, "x") for i in range(n)]
    out += [(n, None, 1, 2, "x"), (n + 1, [], 1, 2, "x"), (n + 2, [1.0] * (dims + 1), 1, 2, "x")]
    out += [(n + 3, [1.0, None] + [0.0] * (dims - 2), 1, 2, "x"), (n + 4, [math.nan] * dims, 1, 2, "x")]
    out += [(n + 5, [math.inf] + [0.0] * (dims - 1), 1, 2, "x"), (None, [0.5] * dims, None, None, None)]
    return out + [out[3], out[3]] + [(n + 10 + i, [1.0] * dims, 1, 2, "x") for i in range(2 * n)]


def brute(data: list[tuple], dims: int, k: int, rounds: int, scale: int) -> list[str]:
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, *_ in data
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (key(r), r[1]))[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c))
    for _ in range(rounds):
        groups: dict = {}
        for _, v in kept:
            groups.setdefault(near(v), []).append(v)
        centroids = [[sum(x) // len(groups[c]) for x in zip(*groups[c])] if c in groups else u for c, u in enumerate(centroids)]
    found = [(i, near(v), apart(v, centroids[near(v)])) for i, v in kept]
    total = {c: sum(d for _, x, d in found if x == c) for c in range(len(centroids))}
    return sorted(str((i, c, d, total[c], sum(total.values()), centroids[c])) for i, c, d in found)


@pytest.mark.parametrize("n, k", [(400, 6), (400, 16), (0, 3)])
def test_equals_brute_force(spark, n, k):
    data = rows(n)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = bisector.cluster(df, dims=4, k=k, rounds=3, scale=64).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(data, 4, k, 3, 64)


def test_empty_table_and_fewer_vectors_than_centroids(spark):
    assert bisector.cluster(spark.createDataFrame([], SCHEMA), dims=4).collect() == []
    two = [(1, [0.0] * 4, 1, 1, "x"), (2, [1.0] * 4, 1, 1, "x")]
    found = bisector.cluster(spark.createDataFrame(two, SCHEMA), dims=4, k=16).collect()
    assert sorted(r.vec_id for r in found) == [1, 2] and {r.distance for r in found} == {0}


def test_a_component_too_large_for_exact_distances_fails(spark):
    df = spark.createDataFrame([(1, [1e30] * 4, 1, 1, "x")], SCHEMA)
    with pytest.raises(Exception, match="a component is larger"):
        bisector.cluster(df, dims=4).collect()


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=9), st.data())
def test_tournament_ends_with_the_nearest_and_smallest(centroids, data):
    points = np.array(data.draw(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=20)))
    planes = bisector.Bisectors(np.array(centroids, dtype=np.int64))
    apart = ((points[:, None, :] - np.array(centroids)[None, :, :]) ** 2).sum(axis=2)
    best = planes.nearest(points)
    assert best.tolist() == apart.argmin(axis=1).tolist()
    assert planes.distances(points, best).tolist() == apart.min(axis=1).tolist()
