"""Sampling, k-means and cluster descriptions (fixture A3)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions.vectors import nearest_center
from tessera.operators import clusters as K
from tessera.operators import kmeans as M
from tessera.operators import sampling as P
from tessera.sources.tables import LANGUAGES


def pts(spark, rows):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "id long, x long, y long")


def test_tie_goes_to_lowest_index(spark):
    df = pts(spark, [(2, 0)])
    assert df.select(nearest_center([(0, 0), (4, 0)]).alias("c")).first().c == 0
    assert df.select(nearest_center([(4, 0), (0, 0)]).alias("c")).first().c == 0


def test_average_truncates_toward_zero(spark):
    assert M.kmeans_step(pts(spark, [(0, 1), (0, 2)]), [(0, 0)]).first()[1:] == (0, 1)
    assert M.kmeans_step(pts(spark, [(0, -3), (0, -4)]), [(0, 0)]).first()[1:] == (0, -3)


def test_empty_cluster_keeps_centroid(spark):
    step = sorted(tuple(r) for r in M.kmeans_step(pts(spark, [(1, 1), (3, 3)]), [(0, 0), (0, 0)]).collect())
    assert step == [(0, 2, 2), (1, 0, 0)]


def test_shift_is_squared():
    assert M.centroid_shift([(0, 0)], [(3, 4)]) == 25.0
    assert M.converged(19.9) and not M.converged(20.0)
    with pytest.raises(ValueError):
        M.centroid_shift([(0, 0)], [])


def test_label_rules(spark):
    v = pts(spark, [(50000, 1), (50000, 2), (0, 9)])
    low = K.cluster_results([(0, 0)], v, LANGUAGES).first()
    assert (low.label, round(low.percent, 1), low.size, low.median_score) == ("JavaScript", 33.3, 3, 2)
    mode = K.cluster_results([(0, 0)], v, LANGUAGES, label_rule="mode").first()
    assert (mode.label, round(mode.percent, 1)) == ("Java", 66.7)


def test_median_even_truncates(spark):
    assert K.cluster_results([(0, 0)], pts(spark, [(0, 1), (0, 2)]), LANGUAGES).first().median_score == 1
    assert K.cluster_results([(0, 0)], pts(spark, [(0, -3), (0, -4)]), LANGUAGES).first().median_score == -3


def test_weighted_and_raw_agree(spark):
    raw = pts(spark, [(0, 1), (0, 1), (0, 9), (50000, 3), (50000, 4), (50000, 40), (0, 2)])
    w = M.weighted_vectors(raw)
    centers = [(0, 0), (0, 10), (50000, 0), (50000, 50)]
    a = M.kmeans(raw, centers, weighted=False)
    b = M.kmeans(raw, centers, weighted=True)
    assert a.centers == b.centers and a.iterations == b.iterations
    ra = [tuple(r) for r in K.cluster_results(a.centers, raw, LANGUAGES).collect()]
    rb = [tuple(r) for r in K.cluster_results(b.centers, w, LANGUAGES).collect()]
    assert ra == rb


def test_kmeans_stops_at_max_iterations(spark):
    raw = pts(spark, [(0, 0), (0, 100), (0, 1000)])
    r = M.kmeans(raw, [(0, 0), (0, 1)], eta=0.0, max_iterations=2)
    assert r.iterations == 2
    assert r.trace_frame(spark).where(F.col("iteration") == 2).count() == 2


def test_sample_vectors_validation(spark):
    v = pts(spark, [(0, 1), (0, 2), (0, 3), (50000, 1), (50000, 2)])
    with pytest.raises(ValueError):
        P.sample_vectors(v, 15, 7)  # bad_k
    init = P.sample_vectors(v, 2, 6, 50000)  # too_few: one language has 2 of 3
    with pytest.raises(ValueError):
        P.collect_centroids(init, 6)
    ok = P.collect_centroids(P.sample_vectors(v, 2, 4, 50000), 4)
    assert [x for x, _ in ok] == [0, 0, 50000, 50000]


def test_sampling_is_seeded_and_uses_group_limit(spark):
    from tests.conftest import has_python_node, plan_text

    v = spark.range(1000).select("id", (F.col("id") % 3 * 50000).alias("x"), (F.col("id") % 17).alias("y"))
    a = [tuple(r) for r in P.sample_per_group(v, "x", 4).orderBy("x", "sample_rank").collect()]
    b = [tuple(r) for r in P.sample_per_group(v.repartition(7), "x", 4).orderBy("x", "sample_rank").collect()]
    assert a == b and len(a) == 12
    assert "WindowGroupLimit" in plan_text(P.sample_per_group(v, "x", 4))
    fixed = P.sample_fixed(v, 5)
    assert fixed.count() == 5
    assert "TakeOrderedAndProject" in plan_text(fixed)
    small = P.collect_centroids(P.sample_vectors(v, 3, 6, lang_spread=100), 6)
    assert len(small) == 6


def test_report_layout(spark):
    v = pts(spark, [(50000, 1), (50000, 2), (0, 9)])
    rep = [r.line for r in K.cluster_report(K.cluster_results([(0, 0)], v, LANGUAGES)).collect()]
    assert rep[:3] == K.REPORT_HEADER
    assert rep[3] == "      2  JavaScript        (33.3 %)            3"


def test_assignment_plan_is_codegen_without_join(spark):
    from tests.conftest import has_python_node, plan_text

    p = plan_text(M.average_vectors(pts(spark, [(1, 1)]), [(0, 0), (5, 5)]))
    assert "Join" not in p and not has_python_node(p)


def test_expression_forms_agree(spark):
    from tessera.functions.vectors import nearest_distance

    v = pts(spark, [(3, 4), (-7, 2), (50000, 9), (2, 0)])
    centers = [(0, 0), (4, 0), (50000, 10), (4, 0)]
    a = v.select(nearest_center(centers).alias("c"), nearest_distance(centers).alias("d")).collect()
    b = v.select(nearest_center(centers, F.col("x"), F.col("y")).alias("c"),
                 nearest_distance(centers, F.col("x"), F.col("y")).alias("d")).collect()
    assert a == b
    assert [r.c for r in a] == [1, 0, 2, 0] and [r.d for r in a] == [17.0, 53.0, 1.0, 4.0]
    one = v.select(nearest_distance([(0, 0)]).alias("d")).first().d
    assert one == 25.0


@pytest.mark.parametrize("hashing", ["xxhash64", "md5"])
def test_both_sample_hashes_ignore_partitioning(spark, hashing):
    v = spark.range(500).select("id", (F.col("id") % 5 * 50000).alias("x"), (F.col("id") % 11).alias("y"))
    a = [tuple(r) for r in P.sample_per_group(v, "x", 3, hashing=hashing).orderBy("x", "sample_rank").collect()]
    b = [tuple(r) for r in P.sample_per_group(v.repartition(9), "x", 3, hashing=hashing).orderBy("x", "sample_rank").collect()]
    assert a == b and len(a) == 15
    with pytest.raises(ValueError):
        P.sample_key("id", 42, "crc")


def test_any_number_of_centroids(spark):
    from tessera.functions.vectors import WRITTEN_CENTERS, nearest_distance
    from tests.conftest import plan_text

    centers = [(50000 * (i % 7), 3 * i) for i in range(5 * WRITTEN_CENTERS)] + [(0, 0)]
    v = pts(spark, [(0, 0), (50001, 2000), (-9, 77), (10**6, 10**6), (100000, 6)])
    rows = v.select("x", "y", nearest_center(centers).alias("c"), nearest_distance(centers).alias("d")).collect()
    for r in rows:
        d, i = min(((r.x - cx) ** 2 + (r.y - cy) ** 2, i) for i, (cx, cy) in enumerate(centers))
        assert (r.c, r.d) == (i, float(d))
    plan = plan_text(M.average_vectors(v, centers))  # by cell: the lists of centroids are broadcast
    assert plan.count("Join") == plan.count("BroadcastHashJoin [_cell") == 1
    with pytest.raises(ValueError):
        nearest_center([])


@pytest.mark.parametrize("hashing", ["xxhash64", "md5"])
def test_weighted_sampler_is_uniform_over_copies(spark, hashing):
    """300 groups of 900 copies of y=0 and 100 of y=1; one pick per group."""
    rows = [(g * 50000, y, n) for g in range(300) for y, n in ((0, 900), (1, 100))]
    w = spark.createDataFrame(rows, "x long, y long, n long")
    picks = [r.y for r in P.sample_weighted(w, "x", 1, hashing=hashing).collect()]
    assert len(picks) == 300
    assert 270 - 20 <= picks.count(0) <= 270 + 20  # binomial(300, 0.9): sd 5.2


def test_weighted_sampler_takes_all_copies_when_k_is_large(spark):
    w = spark.createDataFrame([(0, 1, 2), (0, 2, 1), (50000, 3, 1)], "x long, y long, n long")
    got = sorted((r.x, r.y) for r in P.sample_weighted(w, "x", 5).collect())
    assert got == [(0, 1), (0, 1), (0, 2), (50000, 3)]
    again = sorted((r.x, r.y) for r in P.sample_weighted(w.repartition(3), "x", 2).collect())
    assert again == sorted((r.x, r.y) for r in P.sample_weighted(w, "x", 2).collect())
    assert len(P.sample_weighted(w, None, 3).collect()) == 3


def test_sample_vectors_from_weighted_rows(spark):
    raw = pts(spark, [(0, 1), (0, 1), (0, 2), (50000, 3), (50000, 4), (50000, 4)])
    w = M.weighted_vectors(raw)
    c = P.collect_centroids(P.sample_vectors(w, 2, 4, 50000), 4)
    assert [x for x, _ in c] == [0, 0, 50000, 50000]
    assert all(p in [(0, 1), (0, 2), (50000, 3), (50000, 4)] for p in c)
    small = P.collect_centroids(P.sample_vectors(w, 2, 4, lang_spread=100), 4)
    assert len(small) == 4


def test_kmeans_resumes_from_recorded_state(spark, tmp_dir):
    raw = pts(spark, [(0, 0), (0, 100), (0, 1000), (0, 37), (0, 555)])
    centers = [(0, 0), (0, 1)]
    fresh = M.kmeans(raw, centers, eta=0.0, max_iterations=6)
    state = f"{tmp_dir}/kmeans-state"
    first = M.kmeans(raw, centers, eta=0.0, max_iterations=2, state_path=state)
    assert first.iterations == 2
    # a new run (e.g. after the driver was lost) continues at iteration 3
    resumed = M.kmeans(raw, centers, eta=0.0, max_iterations=6, state_path=state)
    assert (resumed.centers, resumed.iterations) == (fresh.centers, fresh.iterations)
    assert resumed.trace == fresh.trace
    # a finished run is returned as recorded
    again = M.kmeans(raw, centers, eta=0.0, max_iterations=6, state_path=state)
    assert again.centers == fresh.centers and again.iterations == fresh.iterations


def test_recorded_state_of_other_input_is_refused(spark, tmp_dir):
    raw = pts(spark, [(0, 0), (0, 100), (0, 1000)])
    state = f"{tmp_dir}/kmeans-other"
    M.kmeans(raw, [(0, 0), (0, 1)], max_iterations=1, state_path=state)
    for vectors, centers, eta in (
        (pts(spark, [(0, 0), (0, 100), (0, 1001)]), [(0, 0), (0, 1)], M.DEFAULT_ETA),
        (raw, [(0, 0), (0, 2)], M.DEFAULT_ETA),
        (raw, [(0, 0), (0, 1)], 1.0),
    ):
        with pytest.raises(ValueError, match="other input or parameters"):
            M.kmeans(vectors, centers, eta, max_iterations=5, state_path=state)


def test_result_says_whether_it_converged(spark):
    raw = pts(spark, [(0, 0), (0, 100), (0, 1000), (0, 37), (0, 555)])
    assert not M.kmeans(raw, [(0, 0), (0, 1)], eta=0.5, max_iterations=1).converged
    assert M.kmeans(raw, [(0, 0), (0, 1)], eta=0.5).converged
