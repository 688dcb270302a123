"""Property check: Spark k-means (raw and weighted) equals a brute force
of the rules - nearest centroid with ties to the lowest index, means with
integer division truncating toward zero, empty clusters kept, stop when
the summed squared shift is below eta or after max iterations."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import kmeans as M

COORD = st.integers(-30, 30)
POINT = st.tuples(COORD, COORD)


def trunc_div(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def brute(points, centers, eta, max_iter):
    means = list(centers)
    for it in range(1, max_iter + 1):
        members = {i: [] for i in range(len(means))}
        for p in points:
            d = [float(p[0] - c[0]) * (p[0] - c[0]) + float(p[1] - c[1]) * (p[1] - c[1]) for c in means]
            members[d.index(min(d))].append(p)
        new = [
            (trunc_div(sum(x for x, _ in ms), len(ms)), trunc_div(sum(y for _, y in ms), len(ms))) if ms else means[i]
            for i, ms in members.items()
        ]
        shift = sum(float(a[0] - b[0]) ** 2 + float(a[1] - b[1]) ** 2 for a, b in zip(means, new))
        if shift < eta or it == max_iter:
            return new, it
        means = new


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    points=st.lists(POINT, min_size=1, max_size=12),
    centers=st.lists(POINT, min_size=1, max_size=4),
    eta=st.sampled_from([0.5, 20.0]),
)
def test_kmeans_equals_brute_force(spark, points, centers, eta):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, x long, y long")
    want, iters = brute(points, centers, eta, 6)
    for weighted in (False, True):
        r = M.kmeans(df, centers, eta=eta, max_iterations=6, weighted=weighted)
        assert (r.centers, r.iterations) == (want, iters)
