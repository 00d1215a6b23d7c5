import hashlib
import random

import numpy as np
import pytest

from tidematch.llm import centroids

ROWS = "vec_id long, embedding array<double>, cluster string, id string, distance string"


def by_hand(rows, clusters, rounds, dimensions):
    """rows of (id, vector): (id, cluster, distance) of each and the centroids."""
    given = [
        (k, [int(np.floor(256 * float(x))) for x in v])
        for k, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(given, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [p for _, p in order[:clusters]]
    for k in range(rounds + 1):
        near = []
        for _, p in given:
            near.append(min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centers)))
        if k < rounds:
            for n in range(len(centers)):
                own = [p for (_, p), (_, m) in zip(given, near) if m == n]
                if own:
                    centers[n] = [sum(col) // len(own) for col in zip(*own)]
    return [(k, n, d) for (k, _), (d, n) in zip(given, near)], centers


def check(spark, rows, clusters, rounds, dimensions):
    table = spark.createDataFrame([(k, v, "own", "own", "own") for k, v in rows], ROWS)
    got = centroids.cluster(table, clusters=clusters, rounds=rounds, dimensions=dimensions)
    wanted, centers = by_hand(rows, clusters, rounds, dimensions)
    found = got.collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found) == sorted(wanted)
    for r in found:
        own = [d for _, n, d in wanted if n == r["cluster"]]
        assert r["cluster_inertia"] == sum(own) and r["inertia"] == sum(d for *_, d in wanted)
        text = ",".join(map(str, centers[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_rounds(spark, seed):
    """Few values and few dimensions, so that many distances are equal."""
    rng = random.Random(seed)
    rows = [(k, [rng.randint(-3, 3) / 256 for _ in range(3)]) for k in range(300)]
    check(spark, rows, clusters=25, rounds=4, dimensions=3)


def test_large_components(spark):
    """Distances that doubles cannot hold."""
    rng = random.Random(3)
    rows = [(k, [rng.choice([-1, 1]) * (2.0**20 + rng.randint(0, 5)), float(rng.randint(0, 9))]) for k in range(80)]
    check(spark, rows, clusters=12, rounds=2, dimensions=2)
    huge = spark.createDataFrame([(0, [1e300, 0.0], "", "", ""), (1, [-1e300, 0.0], "", "", "")], ROWS)
    far = centroids.cluster(huge, clusters=1, rounds=1, dimensions=2).collect()
    assert {r["distance"] for r in far} == {centroids.LONGEST}
    assert {r["inertia"] for r in far} == {centroids.LONGEST}


def test_odd_vectors_take_no_part(spark):
    bad = [None, [], [1.0], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    good = [(10, [0.5, -0.001]), (10, [0.5, -0.001]), (11, [0.0, 0.0]), (12, [0.5, -0.001])]
    check(spark, [*enumerate(bad), *good], clusters=40, rounds=3, dimensions=2)
    none = spark.createDataFrame([(k, v, "", "", "") for k, v in enumerate(bad)], ROWS)
    assert centroids.cluster(none, dimensions=2).collect() == []
    null_key = spark.createDataFrame([(None, [1.0, 2.0], "", "", "")], ROWS)
    assert [r["vec_id"] for r in centroids.cluster(null_key, dimensions=2).collect()] == [None]


@pytest.mark.parametrize("count", [1, 3, 40, 200])
def test_the_tree_finds_the_nearest(count):
    rng = np.random.default_rng(count)
    points = rng.integers(-50, 50, (count, 5))
    points[count // 2 :] = points[: count - count // 2]  # equal centroids
    vectors = rng.integers(-60, 60, (3000, 5))
    best, least = centroids.Nearest(points.tolist()).of(vectors)
    away = ((vectors[:, None] - points[None]) ** 2).sum(axis=2)
    assert (best == away.argmin(axis=1)).all() and (least == away.min(axis=1)).all()


def test_the_tree_prunes():
    """Far groups of centroids are not visited."""
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(0, 9, (30, 2)) + 1000 * k for k in range(10)])
    tries = []
    plain = centroids.squared

    def counted(a, b):
        tries.append(len(a) * len(b))
        return plain(a, b)

    nearest = centroids.Nearest(points.tolist())
    nearest._tree(False)
    centroids.squared = counted
    try:
        nearest.of(points + 1)
    finally:
        centroids.squared = plain
    assert sum(tries) < len(points) ** 2 / 4
