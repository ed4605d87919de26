import hashlib
import math

import numpy as np
import pytest

from surge.llm import clusters


def brute(rows, k, rounds, dim, seed=2, scale=256):
    """Plain Lloyd rounds over Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = {i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept}
    packed = [np.array(v, dtype=np.int32).tobytes() for _, v in kept]
    order = sorted(range(len(kept)), key=lambda j: (name[kept[j][0]], packed[j]))
    centroids = [list(kept[j][1]) for j in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assign())], centroids


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def points(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dim))
    found = middles[rng.integers(6, size=n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(found)]


@pytest.mark.parametrize("seed,spread,scale", [(1, 0.3, 256), (2, 1.0, 4), (3, 0.05, 256)])
def test_equals_plain_lloyd(spark, seed, spread, scale):
    rows = points(seed, 300, 5, spread)
    rows += rows[:20] + [(None, rows[3][1]), (400, None), (401, [1.0]), (402, [None] * 5), (403, [math.nan] * 5),
                         (404, [math.inf] * 5), (405, [0.5, -0.5, 0.0, -0.0, 1e-30])]
    found, centroids = clusters.ns_kmeans(table(spark, rows).repartition(3), k=9, rounds=6, dim=5, scale=scale)
    expected, last = brute(rows, 9, 6, 5, scale=scale)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in found.collect()), key=key) == sorted(expected, key=key)
    assert centroids.tolist() == last


def test_bounds_save_distances_and_hold(spark):
    """On separated groups most distances are ruled out; every stored bound is a bound."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(12, 8))[rng.integers(12, size=2000)] * 4 + 0.2 * rng.normal(size=(2000, 8)))).astype(np.int64)
    history = x[rng.choice(2000, 12, replace=False)][None]
    b = clusters.Bounds.first(x, history[0])
    for _ in range(6):
        c = np.stack([x[b.cluster == j].sum(0) // max((b.cluster == j).sum(), 1) if (b.cluster == j).any() else history[-1][j] for j in range(12)])
        history = np.concatenate([history, c[None]])
        b.evaluated[:] = 0
        b.next(x, history)
        d = clusters.squared(x, history[-1])
        assert (b.cluster == d.argmin(1)).all()
        then = history[b.lower_round, np.arange(12)[None, :]]
        assert (b.lower.astype(float) <= np.sqrt(((x[:, None, :] - then).astype(float) ** 2).sum(2))).all()
    assert b.evaluated.sum() < 0.2 * d.size


def test_exact_beyond_doubles():
    big = np.array([[1 << 26, -(1 << 26)], [(1 << 26) - 1, 3]], dtype=np.int64)
    assert clusters.squared(big, big).tolist() == [[0, 1 + (3 + (1 << 26)) ** 2], [1 + (3 + (1 << 26)) ** 2, 0]]


def test_report_on_few_vectors_and_none(spark):
    one = points(9, 3, 64, 1.0)
    got = clusters.cluster_report(table(spark, one)).collect()
    expected, last = brute(one, 40, 5, 64)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(expected)
    assert {r["inertia"] for r in got} == {0} and {r["cluster_inertia"] for r in got} == {0}
    assert {(r["cluster"], r["centroid_sha256"]) for r in got} == {
        (j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(last)}
    empty = clusters.cluster_report(table(spark, []))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_clashing_names_and_too_large(spark):
    rows = table(spark, points(4, 30, 64, 1.0)).selectExpr("*", "1 AS cluster", "2 AS distance", "3 AS x", "4 AS id")
    assert clusters.cluster_report(rows).count() == 30
    with pytest.raises(Exception, match="64 bits"):
        clusters.ns_kmeans(table(spark, [(1, [1e12] * 64)]))
