"""Many centroids by cell, and k-means with bounds, against plain Python and the plain loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.vectors import nearest_center
from tessera.operators import center_index as X
from tessera.operators import kmeans as M


def nearest(x, y, centers):
    return min((float(x - a) * (x - a) + float(y - b) * (y - b), i) for i, (a, b) in enumerate(centers))[1]


def frame(spark, points):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, x long, y long")


def shapes(kind, n, r):
    if kind == "square":
        return [(r.randrange(1000), r.randrange(1000)) for _ in range(n)]
    if kind == "lines":
        return [(r.randrange(5) * 50_000, r.randrange(60)) for _ in range(n)]
    if kind == "diagonal":
        return [(i, i + r.randrange(-2, 3)) for i in (r.randrange(-5000, 5000) for _ in range(n))]
    return [(7, 7)] * n  # one place


@pytest.mark.parametrize("kind", ["square", "lines", "diagonal", "place"])
def test_cells_find_the_nearest(spark, kind):
    r = random.Random(kind)
    centers = shapes(kind, 400, r)
    points = [*shapes(kind, 150, r), *shapes("square", 40, r), (10**7, -(10**7)), (0, 0)]
    found = X.CenterCells(frame(spark, points), centers).assign(centers)
    assert {q.id: q.cluster for q in found.collect()} == {i: nearest(x, y, centers) for i, (x, y) in enumerate(points)}


@pytest.mark.parametrize("k", [1500, 20_000])
def test_many_centroids_equal_the_fold(spark, k):
    r = random.Random(k)
    centers = shapes("square", k // 2, r) + [(1000 * a, 1000 * b) for a, b in shapes("square", k - k // 2, r)]
    v = frame(spark, shapes("square", 40, r) + [(900 * a, 900 * b) for a, b in shapes("square", 40, r)])
    cells = X.CenterCells(v, centers)
    fold = v.select("id", nearest_center(centers).alias("cluster"))
    assert sorted(map(tuple, cells.assign(centers).select("id", "cluster").collect())) == sorted(map(tuple, fold.collect()))


def test_lists_do_not_grow_with_the_centroids(spark):
    """Points all over the centroids' square: a row's list stays as long when there are sixteen times as many."""
    r = random.Random(5)
    v = frame(spark, shapes("square", 4000, r))
    long = []
    for k in (1000, 16_000):
        centers = [(r.randrange(1000), r.randrange(1000)) for _ in range(k)]
        lists = X.CenterCells(v, centers).lists(centers)
        long.append(sum(map(len, lists)) / len(lists))
    assert long[1] < 1.5 * long[0] < 120


def test_cells_where_lists_are_left_out(spark, monkeypatch):
    r = random.Random(6)
    centers, points = shapes("square", 300, r), shapes("square", 100, r)
    monkeypatch.setattr(X, "LIST_ENTRIES", 200)
    found = X.CenterCells(frame(spark, points), centers).assign(centers)
    assert {q.id: q.cluster for q in found.collect()} == {i: nearest(x, y, centers) for i, (x, y) in enumerate(points)}


def test_cells_of_nulls_and_of_nothing(spark):
    centers = shapes("square", 300, random.Random(7))
    v = spark.createDataFrame([(0, None, 5), (1, 5, None), (2, 3, 4)], "id long, x long, y long")
    expected = sorted(map(tuple, v.select("id", nearest_center(centers)).collect()))
    assert sorted(map(tuple, M.assign(v, centers).select("id", "cluster").collect())) == expected
    assert M.assign(v.limit(0), centers).collect() == []


@pytest.mark.parametrize("k", [1, 2, 16, 17, 60, 300])
def test_two_nearest(spark, k):
    r = random.Random(k)
    centers = [(r.randrange(50), r.randrange(50)) for _ in range(k)]  # with ties and copies
    points = shapes("square", 60, r) + [(r.randrange(50), r.randrange(50)) for _ in range(60)]
    v = frame(spark, points)
    expected = {}
    for i, (x, y) in enumerate(points):
        d = sorted((float((x - a) ** 2 + (y - b) ** 2), j) for j, (a, b) in enumerate(centers))
        expected[i] = (d[0][1], d[0][0], d[1][0] if k > 1 else None)
    assert {q.id: (q.cluster, q.d1, q.d2) for q in M.two_nearest(v, centers).collect()} == expected
    assert {q.id: q.cluster for q in M.assign(v, centers).collect()} == {i: e[0] for i, e in expected.items()}


@pytest.mark.parametrize("k", [1, 5, 20, 280])
def test_bounds_change_nothing(spark, k):
    r = random.Random(k)
    points = [(int(r.gauss(300 * (i % 6), 60)), int(r.gauss(200 * (i % 4), 40))) for i in range(900)]
    centers = [(r.randrange(1800), r.randrange(800)) for _ in range(k)]
    v = frame(spark, points)
    limit = 4 if k > 256 else 14
    plain = M.kmeans(v, centers, 0.5, limit)
    bounded = M.kmeans(v, centers, 0.5, limit, bounds=True)
    assert (bounded.centers, bounded.trace, bounded.iterations) == (plain.centers, plain.trace, plain.iterations)
    assert len(bounded.compared) == bounded.iterations and plain.compared == [1.0] * plain.iterations
    if k == 20:
        assert min(bounded.compared) < 0.5  # some steps compare few
    raw = M.kmeans(v, centers, 0.5, limit, weighted=False, bounds=True)
    assert raw.trace == plain.trace


def test_nearest_of_many_written_centroids_is_not_fused(spark):
    from tests.conftest import plan_text

    plan = plan_text(M.assign(spark.range(5).selectExpr("id AS x", "id AS y"), shapes("square", 40, random.Random(1))))
    assert "+- Project" in plan and "*(1) Project [x" not in plan.split("array(")[0]
