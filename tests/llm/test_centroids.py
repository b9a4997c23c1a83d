"""Centroids against plain integers."""

import hashlib
import math
import random

import pytest

from changeflow.llm.centroids import clustered

SCHEMA = "vec_id long, embedding array<float>, v string, cluster string, distance int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 3) for i, v in rows], SCHEMA)


def brute(rows, width, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[j]) for x in zip(*members[j])] if j in members else c for j, c in enumerate(centroids)]
    placed = [(i, *near(v)) for i, v in kept]
    each = lambda j: sum(d for _, d, c in placed if c == j)
    total, sha = sum(d for _, d, _ in placed), [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, each(c), total, sha[c]) for i, d, c in placed]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_integers(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-1.5, -0.25, 0.0, 0.51, 2.0, r.gauss(0, 1)]) for _ in range(4)]) for i in range(60)]
    rows = [(i, [struct_float(x) for x in v]) for i, v in rows]
    # a hot vector, ties, repeated ids, no id, and everything that is left out
    rows += [(100, [0.5] * 4)] * 40 + [(7, rows[7][1]), (None, [3.0] * 4), (None, [3.0] * 4)]
    rows += [(200, None), (201, [1.0] * 3), (202, [1.0] * 5), (203, [1.0, None, 1.0, 1.0]), (204, [math.nan] * 4), (205, [math.inf] * 4), (206, [])]
    got, _ = clustered(frame(spark, rows), components=4, clusters=5)
    assert order(tuple(x) for x in got.collect()) == order(brute(rows, 4, 5, 3))


def struct_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_few_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [-4.0, 0.0])]
    got, centroids = clustered(frame(spark, rows), components=2)
    assert order(tuple(x) for x in got.collect()) == order(brute(rows, 2, 16, 3)) and len(centroids) == 2
    got, centroids = clustered(frame(spark, [(1, None)]), components=2)
    assert got.collect() == [] and centroids == []
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_empty_clusters_stay(spark):
    # two starting centroids at one place: the second gets nothing
    rows = [(i, [1.0]) for i in range(5)] + [(9, [8.0])]
    got, _ = clustered(frame(spark, rows), components=1, clusters=6)
    assert order(tuple(x) for x in got.collect()) == order(brute(rows, 1, 6, 3))


def test_too_large_a_component_fails_with_a_message(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        clustered(frame(spark, [(1, [1e30])]), components=1)[0].collect()
