"""The nearest of many centroids as one expression: a row meets the few of its cell."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.functions.vectors import nearest_center, nearest_distance
from tessera.plans.catalog import MANY_CENTERS


def _nearest(p, centers):
    if p[0] is None or p[1] is None:
        return 0, None
    d, i = min((float(p[0] - x) * (p[0] - x) + float(p[1] - y) * (p[1] - y), i) for i, (x, y) in enumerate(centers))
    return i, d


@pytest.mark.parametrize("kind", ["lattice", "spread", "line", "one place"])
def test_as_among_all(spark, kind):
    rnd = random.Random(kind)
    centers = {
        "lattice": MANY_CENTERS,
        "spread": [(rnd.randint(-1000, 1000), rnd.randint(0, 10**6)) for _ in range(600)],
        "line": [(i * i, 3) for i in range(400)],
        "one place": [(7, 7)] * 300,
    }[kind]
    xs, ys, _ = V._grid(centers)
    points = [(None, 1), (1, None), (xs[0] - 10**9, 5), (xs[-1] + 1, ys[-1] + 10**9)]
    points += [(rnd.choice(xs) + rnd.randint(-1, 1), rnd.choice(ys) + rnd.randint(-1, 1)) for _ in range(200)]
    points += [(rnd.randint(xs[0], xs[-1]), rnd.randint(ys[0], ys[-1])) for _ in range(200)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x long, y long")
    got = frame.select("id", nearest_center(centers).alias("i"), nearest_distance(centers).alias("d")).orderBy("id").collect()
    assert [(r.i, r.d) for r in got] == [_nearest(p, centers) for p in points]


def test_a_row_is_compared_with_few(spark):
    for times in (1, 4):
        centers = [(50_000 * (i % 5), i // 5 * 7) for i in range(1500 * times)]
        assert max(map(len, V._grid(centers)[2])) <= 12
    # the array that a row folds over is its cell's, wherever it lies among the centroids
    folded = spark.range(1).select((F.col("id") * 3).alias("x"), F.col("id").alias("y")).select(nearest_center(MANY_CENTERS))
    assert "coalesce" in folded._jdf.queryExecution().optimizedPlan().toString()
