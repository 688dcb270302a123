"""End-to-end jobs and strategy timing."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera.operators import kmeans as M
from tessera.operators import sampling as P
from tessera.operators import survey as U
from tessera.plans import pipelines as PL
from tessera.session import release
from tessera.sources import tables as S
from tessera.sources.survey import read_survey
from tests.conftest import SF_SMALL


def test_pipeline_terms_three_strategies(spark):
    out = PL.pipeline_terms(S.articles(spark, SF_SMALL), S.STANDIN_TERMS)
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault(r.strategy, []).append((r.term, r.n))
    assert len(by["scan"]) == len(S.STANDIN_TERMS)
    assert sorted(by["index"]) == sorted(by["count"]) == sorted(t for t in by["scan"] if t[1] > 0)


def test_compare_strategies_reports_each(spark, capsys):
    t = PL.compare_strategies(S.articles(spark, SF_SMALL), ["the", "of", "zzz"])
    assert set(t) == {"scan", "index", "count"} and all(v >= 0 for v in t.values())
    assert "Processing ranking by index took" in capsys.readouterr().out


def test_pipeline_clusters_matches_operator_steps(spark):
    postings = S.postings(spark, SF_SMALL)
    described, result = PL.pipeline_clusters(postings, S.STANDIN_TAGS, 50000, 15)
    rows = described.collect()
    release(result.inputs)
    assert sum(r.size for r in rows) == postings.where("posting_type = 1").join(
        postings.where("posting_type = 2").select(F.col("parent_id").alias("id")).distinct(), "id").count()
    medians = [r.median_score for r in rows]
    assert medians == sorted(medians)
    # the same centroids step by step
    from tessera.operators import forum as Q

    v = Q.posting_vectors(Q.scored_postings(postings), S.STANDIN_TAGS)
    centers = P.collect_centroids(P.sample_vectors(M.weighted_vectors(v), 5, 15), 15)
    for _ in range(result.iterations):
        nxt = [(r.x, r.y) for r in M.kmeans_step(v, centers).orderBy("cluster").collect()]
        if M.converged(M.centroid_shift(centers, nxt)):
            centers = nxt
            break
        centers = nxt
    assert centers == result.centers
    # sampling questions by id instead gives valid centroids as well
    by_id, r2 = PL.pipeline_clusters(postings, S.STANDIN_TAGS, 50000, 15, sample_from="vectors")
    assert len(by_id.collect()) > 0
    release(r2.inputs)


def test_pipeline_survey_from_csv(spark, tmp_dir):
    d = os.path.join(tmp_dir, "atus")
    os.makedirs(d)
    cols = ["tucaseid", "telfs", "tesex", "teage", "t010101", "t050101", "t020101", "t180501"]
    for part in range(2):
        with open(os.path.join(d, f"p{part}.csv"), "w") as f:
            f.write(",".join(cols) + "\n")
            for i in range(20):
                f.write(f"c{part}{i},{1 + i % 5},{1 + i % 2},{15 + i * 3},{60 * (i % 4)},{30 * (i % 3)},{i},{10}\n")
    names, df = read_survey(spark, d)
    grouped = PL.pipeline_survey(df)
    p, w, o = U.classify_columns(names)
    assert w == ["t050101", "t180501"]
    direct = U.time_usage_grouped(U.time_usage_summary(p, w, o, df))
    assert [tuple(r) for r in grouped.collect()] == [tuple(r) for r in direct.collect()]
    assert all(r.working in ("working", "not working") for r in grouped.collect())


def test_pipeline_rerun_after_lost_driver_skips_the_join(spark, tmp_dir):
    postings = S.postings(spark, SF_SMALL)
    fresh, r0 = PL.pipeline_clusters(postings, S.STANDIN_TAGS, 50000, 15)
    want = sorted(tuple(r) for r in fresh.collect())
    release(r0.inputs)
    state = f"{tmp_dir}/cluster-state"
    _, r1 = PL.pipeline_clusters(postings, S.STANDIN_TAGS, 50000, 15, max_iterations=2, kmeans_state=state)
    assert r1.iterations == 2
    # the rerun must not touch the postings: evaluating them would fail
    poisoned = postings.withColumn("score", F.raise_error(F.lit("postings were read again")).cast("int"))
    again, r2 = PL.pipeline_clusters(poisoned, S.STANDIN_TAGS, 50000, 15, kmeans_state=state)
    assert sorted(tuple(r) for r in again.collect()) == want
    assert (r2.centers, r2.iterations) == (r0.centers, r0.iterations)


def test_pipeline_state_of_other_input_or_parameters_is_refused(spark, tmp_dir):
    import pytest

    state = f"{tmp_dir}/cluster-other"
    postings = S.postings(spark, SF_SMALL)
    PL.pipeline_clusters(postings, S.STANDIN_TAGS, 50000, 15, max_iterations=1, kmeans_state=state)
    for frame, tags, spread in (
        (S.postings(spark, "/root/testdata/sf0.01"), S.STANDIN_TAGS, 50000),
        (postings, S.STANDIN_TAGS[::-1], 50000),
        (postings, S.STANDIN_TAGS, 40000),
    ):
        with pytest.raises(ValueError, match="other input or parameters"):
            PL.pipeline_clusters(frame, tags, spread, 15, kmeans_state=state)


def test_registered_cluster_queries_leave_no_table(spark):
    import os

    from tessera.plans.catalog import QUERIES
    from tessera.session import checkpoint_dir

    base = checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(base))
    QUERIES["pipeline_clusters"](spark, SF_SMALL).collect()
    QUERIES["cluster_results_mode"](spark, SF_SMALL).collect()
    QUERIES["read_survey_files"](spark, SF_SMALL).collect()
    assert set(os.listdir(base)) == before
