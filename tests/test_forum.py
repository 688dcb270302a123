"""Questions, answers, pairs, scoring and vectors (fixture A2)."""

from __future__ import annotations

import pytest

from tessera.operators import forum as Q
from tessera.sources.postings import POSTING_SCHEMA, parse_postings
from tessera.sources.tables import LANGUAGES
from tests.test_sources import POSTING_LINES


@pytest.fixture()
def postings(spark):
    lines = spark.createDataFrame([(x,) for x in POSTING_LINES], "value string")
    return parse_postings(lines)


def test_filters(postings):
    assert sorted(r.id for r in Q.questions(postings).collect()) == [100, 200, 300, 400, 600]
    assert sorted(r.id for r in Q.answers(postings).collect()) == [101, 102, 201, 301, 501]


def test_pairs_drop_unanswered_and_orphans(postings):
    pairs = sorted((r.id, r.answer_id, r.answer_score) for r in Q.question_answer_pairs(postings).collect())
    assert pairs == [(100, 101, 3), (100, 102, 7), (200, 201, -4), (300, 301, 2)]
    grouped = Q.grouped_postings(postings)
    assert sorted((r.id, r.answer_id, r.answer_score, r.n_pairs) for r in grouped.collect()) == [
        (*p, {100: 2, 200: 1, 300: 1}[p[0]]) for p in pairs
    ]
    assert grouped.drop("n_pairs").columns == Q.question_answer_pairs(postings).columns


def test_high_score_floored_at_zero(postings):
    scores = {r.id: r.high_score for r in Q.answer_high_score(postings).collect()}
    assert scores == {100: 7, 200: 0, 300: 2, 999: 8}


def test_scored_postings(postings):
    rows = {r.id: r for r in Q.scored_postings(postings).collect()}
    assert set(rows) == {100, 200, 300}
    assert rows[100].high_score == 7 and rows[100].tag == "Java"
    assert rows[200].high_score == 0


def test_scored_duplicate_question_ids(spark):
    df = spark.createDataFrame(
        [(1, 7, None, None, 3, "Scala"), (1, 7, None, None, 2, "Java"), (2, 8, None, 7, 4, None), (2, 9, None, 7, 6, None)],
        POSTING_SCHEMA,
    )
    rows = Q.scored_postings(df).collect()
    assert len(rows) == 1
    # lowest question struct wins; best score over all answers of the id
    assert rows[0].score == 2 and rows[0].tag == "Java" and rows[0].high_score == 6
    assert Q.scored_postings(df, dedupe=False).count() == 2


def test_first_tag_index(spark):
    df = spark.createDataFrame([("Java",), ("Groovy",), ("Fortran",), (None,), ("java",)], "tag string")
    got = [r.i for r in df.select(Q.first_tag_index("tag", LANGUAGES).alias("i")).collect()]
    assert got == [1, 14, None, None, None]


def test_vectors(postings):
    v = {r.id: (r.x, r.y) for r in Q.posting_vectors(Q.scored_postings(postings), LANGUAGES).collect()}
    assert v == {100: (50000, 7), 200: (500000, 0), 300: (0, 2)}
    dropped = Q.posting_vectors(Q.scored_postings(postings), LANGUAGES, unmatched="drop")
    assert sorted(r.id for r in dropped.collect()) == [100, 200]


def test_vectors_need_positive_spread(postings):
    with pytest.raises(ValueError):
        Q.posting_vectors(Q.scored_postings(postings), LANGUAGES, 0)


def test_scored_plan_aggregates_answers_before_join(spark, postings):
    from tests.conftest import has_python_node, plan_text

    p = plan_text(Q.scored_postings(postings))
    assert not has_python_node(p) and "NestedLoopJoin" not in p


def test_hot_question_and_copies_are_pre_aggregated(spark):
    """A third of the rows are copies of one question, a third answer it."""
    from pyspark.sql import functions as F

    from tests.conftest import has_python_node, plan_text

    n = 3000
    base = spark.range(n)
    copies = base.select(F.lit(1).alias("posting_type"), F.lit(7).cast("long").alias("id"),
                         F.lit(None).cast("long").alias("accepted_answer"), F.lit(None).cast("long").alias("parent_id"),
                         F.lit(1).alias("score"), F.lit("Java").alias("tag"))
    others = base.select(F.lit(1), (F.col("id") + 100).alias("id"), F.lit(None).cast("long"), F.lit(None).cast("long"),
                         F.lit(0), F.lit("Scala"))
    hot = base.select(F.lit(2), (F.col("id") + 10**6).alias("id"), F.lit(None).cast("long"), F.lit(7).cast("long"),
                      (F.col("id") % 50).cast("int"), F.lit(None).cast("string"))
    cold = base.select(F.lit(2), (F.col("id") + 10**7).alias("id"), F.lit(None).cast("long"), (F.col("id") + 100).alias("p"),
                       F.lit(3), F.lit(None).cast("string"))
    postings = copies.union(others).union(hot).union(cold).toDF(*[c.split()[0] for c in POSTING_SCHEMA.split(", ")])
    scored = Q.scored_postings(postings)
    rows = {r.id: r.high_score for r in scored.collect()}
    assert len(rows) == n + 1 and rows[7] == 49 and rows[100] == 3
    p = plan_text(scored)
    assert "partial_min" in p and "partial_max" in p


def test_grouped_counts_multiply_duplicates(spark):
    df = spark.createDataFrame(
        [(1, 7, None, None, 3, "Scala"), (1, 7, None, None, 2, "Java"), (2, 8, None, 7, 4, None),
         (2, 9, None, 7, 6, None), (2, 10, None, 7, 1, None), (1, 11, None, None, 0, None)],
        POSTING_SCHEMA,
    )
    rows = Q.grouped_postings(df).collect()
    assert len(rows) == 6 and all((r.id, r.n_pairs) == (7, 6) for r in rows)
    assert len({(r.score, r.answer_id) for r in rows}) == 6
    assert Q.question_answer_pairs(df).count() == 6
