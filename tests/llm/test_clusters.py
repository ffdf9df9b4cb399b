"""Centroid clustering against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerline.llm import clusters

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, distance int, c int, seed string"


def plain(rows, centroids=16, rounds=3, dim=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((x for x in kept if x[0] is not None), key=lambda x: hashlib.sha256(f"1:{x[0]}".encode()).hexdigest())
    points = [v for _, v in order[:centroids]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v: min((far(v, p), k) for k, p in enumerate(points))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for k, g in groups.items():
            points[k] = [sum(c) // len(g) for c in zip(*g)]
    placed = [(i, *best(v)) for i, v in kept]
    own = {}
    for _, d, k in placed:
        own[k] = own.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(((i, k, d, own[k], sum(own.values()), digest[k]) for i, d, k in placed), key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, "x", 1, 2, "y") for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in clusters.cluster(docs, **options).collect()), key=repr)


def vectors(seed, n, dim=64, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(dim)]) for i in range(n)]


def test_transform_orders_by_sign_changes_and_inverts():
    for size in (1, 2, 16, 64):
        rows = clusters.transform(np.eye(size, dtype=np.int64))
        changes = [(np.diff(np.sign(rows[:, j])) != 0).sum() for j in range(size)]
        assert changes == list(range(size))
        x = np.random.default_rng(size).integers(-900, 900, size)
        assert clusters.inverse(list(map(int, clusters.transform(x)))) == x.tolist()
    a, b = np.random.default_rng(5).integers(-900, 900, (2, 64))
    assert ((clusters.transform(a) - clusters.transform(b)) ** 2).sum() == 64 * ((a - b) ** 2).sum()


@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_keeps_ties_and_finishes_all_coefficients(kind):
    r = np.random.default_rng(1)
    rows, points = r.integers(-3, 4, (500, 16)), r.integers(-3, 4, (9, 16))
    points[7] = points[2]  # a tie for every row
    number, far = clusters.nearest(clusters.transform(rows).astype(kind), clusters.transform(points).astype(kind))
    d = ((rows[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert number.tolist() == d.argmin(axis=1).tolist()
    assert [int(x) // 16 for x in far] == d.min(axis=1).tolist()


def test_centroids_are_dropped_before_the_last_coefficient():
    r = np.random.default_rng(2)
    points = r.integers(-200, 200, (16, 64))
    rows = np.repeat(points, 20, axis=0) + r.integers(-5, 6, (320, 64))
    c, p = clusters.transform(rows), clusters.transform(points)
    head = ((c[:, None, :8] - p[None, :, :8]) ** 2).sum(axis=2)
    full = ((c[:, None] - p[None]) ** 2).sum(axis=2).min(axis=1)
    assert (head <= full[:, None]).mean() < 0.2  # what coarse coefficients leave of all pairs


def test_clusters_equal_plain_python(spark):
    rows = vectors(3, 400)
    rows += [(i, rows[7][1]) for i in range(1000, 1150)]  # a vector that many rows share
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2000, None), (2001, [1.0] * 63), (2002, [1.0] * 65),
             (2003, [float("nan")] * 64), (2004, [float("inf")] + [0.0] * 63), (2005, [None] + [0.0] * 63), (2006, [])]
    assert run(spark, rows) == plain(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [x * 2 ** 19 for x in v]) for i, v in vectors(4, 60)]
    assert run(spark, rows, centroids=5) == plain(rows, 5)


def test_fewer_vectors_than_centroids_and_other_dimensions(spark):
    rows = vectors(6, 3)
    assert run(spark, rows) == plain(rows)
    rows = vectors(7, 50, dim=10)
    assert run(spark, rows, centroids=4, dim=10) == plain(rows, 4, dim=10)


def test_no_usable_vector_gives_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [0.5])]) == []
    docs = spark.createDataFrame([(1, [1e9] * 64, "x", 1, 2, "y")], SCHEMA)
    with pytest.raises(Exception, match="would not fit"):
        clusters.cluster(docs).collect()
