"""Property checks: cluster descriptions and md5-keyed samples against
brute-force Python."""

from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import clusters as K
from tessera.operators import kmeans as M
from tessera.operators import sampling as P

LANGS = ["L0", "L1", "L2", "L3"]
SPREAD = 100
VEC = st.tuples(st.integers(0, 3).map(lambda i: i * SPREAD), st.integers(-9, 9))


def brute_results(points, centers, rule):
    groups = {}
    for p in points:
        d = [float(p[0] - c[0]) ** 2 + float(p[1] - c[1]) ** 2 for c in centers]
        groups.setdefault(d.index(min(d)), []).append(p)
    out = []
    for c, ps in groups.items():
        xs = [x for x, _ in ps]
        if rule == "lowest":
            lx = min(xs)
        else:
            lx = min(set(xs), key=lambda x: (-xs.count(x), x))
        ys = sorted(y for _, y in ps)
        m = len(ys) // 2
        med = ys[m] if len(ys) % 2 else int((ys[m] + ys[m - 1]) / 2)
        out.append((c, LANGS[lx // SPREAD], (xs.count(lx) * 100) / len(ps), len(ps), med))
    return sorted(out)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    points=st.lists(VEC, min_size=1, max_size=15),
    centers=st.lists(VEC, min_size=1, max_size=3),
    rule=st.sampled_from(["lowest", "mode"]),
)
def test_cluster_results_equal_brute_force(spark, points, centers, rule):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, x long, y long")
    want = brute_results(points, centers, rule)
    for data in (df, M.weighted_vectors(df)):
        got = sorted(tuple(r) for r in K.cluster_results(centers, data, LANGS, SPREAD, rule).collect())
        assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    groups=st.lists(st.integers(0, 3), min_size=1, max_size=40),
    k=st.integers(1, 4),
    seed=st.integers(0, 99),
)
def test_md5_sample_is_k_smallest_keys(spark, groups, k, seed):
    rows = [(i, g) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "id long, x long")
    got = sorted((r.x, r.id) for r in P.sample_per_group(df, "x", k, seed, hashing="md5").collect())
    key = lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)
    want = []
    for g in set(groups):
        ids = sorted((i for i, x in rows if x == g), key=key)[:k]
        want += [(g, i) for i in ids]
    assert got == sorted(want)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    points=st.dictionaries(
        st.tuples(st.integers(0, 2), st.integers(0, 5)), st.integers(1, 6), min_size=1, max_size=10
    ),
    k=st.integers(1, 5),
    seed=st.integers(0, 99),
)
def test_weighted_sample_invariants(spark, points, k, seed):
    rows = [(x * SPREAD, y, n) for (x, y), n in points.items()]
    w = spark.createDataFrame(rows, "x long, y long, n long")
    got = [tuple(r) for r in P.sample_weighted(w, "x", k, seed).collect()]
    again = [tuple(r) for r in P.sample_weighted(w.repartition(3), "x", k, seed).collect()]
    assert sorted(got) == sorted(again)
    for x in {r[0] for r in rows}:
        total = sum(n for rx, _, n in rows if rx == x)
        picks = [r for r in got if r[0] == x]
        assert len(picks) == min(k, total)
        assert sorted(r[2] for r in picks) == list(range(1, len(picks) + 1))
        for rx, y, n in rows:
            if rx == x:
                assert sum(1 for r in picks if r[1] == y) <= n
