"""Plan properties of the registered queries on the shared parquet tables."""

from __future__ import annotations

import re

from tessera.plans import catalog as C
from tests.conftest import SF_SMALL, has_python_node, plan_text


def scans(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_term_ranking_reads_only_text(spark):
    for name in ("rank_terms_count", "rank_terms_scan", "rank_terms_index"):
        assert scans(plan_text(C.QUERIES[name](spark, SF_SMALL))) == ["struct<text:string>"], name


def test_forum_reads_only_needed_columns(spark):
    s = sorted(scans(plan_text(C.QUERIES["posting_vectors"](spark, SF_SMALL))))
    assert s == ["struct<l_orderkey:bigint,l_quantity:double>", "struct<o_orderkey:bigint,o_orderpriority:string>"]


def test_survey_pushes_filter_into_scan(spark):
    p = plan_text(C.QUERIES["time_usage_summary"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in p


def test_no_python_no_nested_loops_anywhere(spark):
    for name, fn in C.QUERIES.items():
        if name.startswith(("kmeans", "cluster", "pipeline_clusters")):
            continue  # these run k-means jobs eagerly; covered in test_kmeans
        p = plan_text(fn(spark, SF_SMALL))
        assert not has_python_node(p) and "NestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_size_ordered_index_scans_text_once(spark):
    from tessera.operators import terms as T
    from tessera.sources import tables as S

    df = T.inverted_index(S.articles(spark, SF_SMALL), S.STANDIN_TERMS, by_size=True)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # let AQE finalise the plan
    final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan parquet") == 1
