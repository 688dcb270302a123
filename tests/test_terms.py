"""Term matching and the three ranking strategies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import terms as T
from tessera.plans.pipelines import rankings
from tests.conftest import plan_text


def arts(spark, rows):
    return spark.createDataFrame(rows, "title string, text string")


def ranked(df):
    return [(r["term"], r["n"]) for r in df.collect()]


def test_doc_count_literal_fixture(spark):
    a = arts(spark, [("x", "one ripe plum"), ("y", "plum, ripe-ish plum tart"), ("z", "overripe figs")])
    assert T.term_doc_count(a, "plum").first()["n"] == 2
    assert T.term_doc_count(a, "figs").first()["n"] == 1
    assert T.term_doc_count(a, "ripe").first()["n"] == 1


def test_rank_scan_two_articles(spark):
    a = arts(spark, [("1", "we sold no plums today"), ("2", "plums and figs went early")])
    r = ranked(T.rank_terms_scan(a, ["figs", "plums"]))
    assert r == [("plums", 2), ("figs", 1)]


MARKET3 = [
    ("1", "no quinces this week but many limes again"),
    ("2", "both figs and plums came by boat"),
    ("3", "late figs bruise easily"),
]
MARKET5 = MARKET3 + [
    ("4", "they asked for mangos before plums"),
    ("5", "plums again at noon"),
]


def test_index_has_two_entries(spark):
    idx = T.inverted_index(arts(spark, MARKET3), ["figs", "plums"])
    assert idx.select("term").distinct().count() == 2
    assert sorted((r["term"], r["title"]) for r in idx.collect()) == [("figs", "2"), ("figs", "3"), ("plums", "2")]
    assert ranked(T.rank_terms_index(idx)) == [("figs", 2), ("plums", 1)]


def test_index_by_size_and_text(spark):
    idx = T.inverted_index(arts(spark, MARKET3), ["plums", "figs"], with_text=True, by_size=True)
    assert "orderBy" not in plan_text(idx) and " Sort [n" not in plan_text(idx)  # postings are not sorted
    rows = idx.orderBy(F.desc("n"), "position", "title").collect()
    assert [r["term"] for r in rows] == ["figs", "figs", "plums"]
    assert rows[0]["n"] == 2 and rows[0]["text"] == "both figs and plums came by boat"


def test_rank_count_five_articles(spark):
    names = ["figs", "plums", "quinces", "mangos", "limes"]
    r = ranked(T.rank_terms_count(arts(spark, MARKET5), names))
    assert r == [("plums", 3), ("figs", 2), ("quinces", 1), ("mangos", 1), ("limes", 1)]


def test_zero_counts_differ_by_strategy(spark):
    a = arts(spark, MARKET5)
    terms = ["plums", "okra", "figs"]
    assert ranked(T.rank_terms_scan(a, terms)) == [("plums", 3), ("figs", 2), ("okra", 0)]
    assert ranked(T.rank_terms_count(a, terms)) == [("plums", 3), ("figs", 2)]
    assert ranked(T.rank_terms_index(T.inverted_index(a, terms))) == [("plums", 3), ("figs", 2)]
    assert ranked(T.rank_terms_count(a, terms, include_zero=True)) == [("plums", 3), ("figs", 2), ("okra", 0)]
    tdf = a.sparkSession.createDataFrame(list(enumerate(terms)), "position int, term string")
    assert ranked(T.rank_terms_count(a, tdf, include_zero=True)) == [("plums", 3), ("figs", 2), ("okra", 0)]


def test_term_tables_count_before_they_join(spark, monkeypatch):
    """Whatever the size of the table, one row per word run and task enters its join."""
    a = arts(spark, MARKET5 * 20)
    tdf = spark.createDataFrame([("plums",), ("both figs",), ("plums",), ("okra",)], "term string")
    for limit in (T.BROADCAST_TERMS_LIMIT, 0):
        monkeypatch.setattr(T, "BROADCAST_TERMS_LIMIT", limit)
        count = T.rank_terms_count(a, tdf)
        assert ranked(count) == [("plums", 120), ("both figs", 20)]
        scan = T.rank_terms_scan(a, tdf)
        assert sorted(ranked(scan)) == [("both figs", 20), ("okra", 0), ("plums", 60), ("plums", 60)]
    plan = plan_text(count)
    at = plan.index("Join")  # below the join with the table, the runs are already summed
    assert plan.index("Generate") > plan.index("partial_count(1)", at) > at


@pytest.mark.parametrize(
    "text,term,hit",
    [
        ("Java, Scala", "Java", False),  # punctuation is part of the word
        ("JavaScript rocks", "Java", False),
        ("use\tJava here", "Java", False),  # tabs do not delimit
        ("line one\nJava", "Java", False),  # newlines do not delimit
        ("Java\nline", "Java", False),
        ("we like Objective C a lot", "Objective C", True),  # two-word term
        ("we like Objective  C", "Objective C", False),  # two blanks
        ("", "Java", False),
        (None, "Java", False),
        ("Java", "Java", True),
        (" Java ", "Java", True),
        ("a  b", "", True),  # the empty term matches between two blanks
        ("ab", "", False),
    ],
)
def test_blank_delimited_matching(spark, text, term, hit):
    a = arts(spark, [("t", text)])
    assert T.term_doc_count(a, term).first()["n"] == int(hit)
    hits = T.term_hits(a, [term]).count()
    assert hits == int(hit)
    # the token-join path (long lists / term tables) agrees
    tdf = spark.createDataFrame([(0, term)], "position int, term string")
    assert T.term_hits(a, tdf).count() == int(hit)


def test_title_is_not_searched(spark):
    a = arts(spark, [("Java", "nothing here")])
    assert T.term_doc_count(a, "Java").first()["n"] == 0


def test_repeated_list_entries(spark):
    a = arts(spark, MARKET5)
    terms = ["plums", "figs", "plums"]
    assert ranked(T.rank_terms_scan(a, terms)) == [("plums", 3), ("plums", 3), ("figs", 2)]
    assert ranked(T.rank_terms_count(a, terms)) == [("plums", 6), ("figs", 2)]
    assert ranked(T.rank_terms_index(T.inverted_index(a, terms))) == [("plums", 6), ("figs", 2)]


def test_ties_keep_list_order(spark):
    a = arts(spark, [("1", "x y"), ("2", "y x")])
    assert ranked(T.rank_terms_scan(a, ["y", "x"])) == [("y", 2), ("x", 2)]
    assert ranked(T.rank_terms_count(a, ["x", "y"])) == [("x", 2), ("y", 2)]


def test_long_list_uses_token_join(spark, monkeypatch):
    monkeypatch.setattr(T, "INLINE_TERMS_LIMIT", 2)
    a = arts(spark, MARKET5)
    terms = ["figs", "plums", "quinces", "mangos", "limes", "okra", "by boat"]
    scan = ranked(T.rank_terms_scan(a, terms))
    assert scan == [("plums", 3), ("figs", 2), ("quinces", 1), ("mangos", 1), ("limes", 1), ("by boat", 1), ("okra", 0)]
    assert ranked(T.rank_terms_count(a, terms)) == [t for t in scan if t[1] > 0]


def test_strategies_agree_on_documents(spark):
    from tessera.sources.tables import STANDIN_TERMS, articles

    a = articles(spark, "/root/testdata/sf0.001")
    out = {k: ranked(v) for k, v in rankings(a, STANDIN_TERMS).items()}
    nonzero = [t for t in out["scan"] if t[1] > 0]
    assert out["index"] == nonzero and out["count"] == nonzero
    counts = [n for _, n in out["scan"]]
    assert counts == sorted(counts, reverse=True)


def test_no_nested_loop_join_and_no_python(spark):
    from tests.conftest import has_python_node, plan_text

    a = arts(spark, MARKET5)
    for df in rankings(a, ["plums", "figs"]).values():
        p = plan_text(df)
        assert "NestedLoopJoin" not in p and not has_python_node(p) and "CartesianProduct" not in p


def test_term_table_broadcast_is_gated(spark, monkeypatch):
    from tests.conftest import has_python_node, plan_text

    a = arts(spark, MARKET5)
    tdf = spark.createDataFrame([(0, "plums"), (1, "figs")], "position int, term string")
    assert "BroadcastExchange" in plan_text(T.term_hits(a, tdf)) or "Broadcast" in plan_text(T.term_hits(a, tdf))
    monkeypatch.setattr(T, "BROADCAST_TERMS_LIMIT", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = T.term_hits(a, tdf)
        assert "SortMergeJoin" in plan_text(hits)
        assert sorted((r.term, r.title) for r in hits.collect())[:2] == [("figs", "2"), ("figs", "3")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_term_list(spark):
    a = arts(spark, MARKET5)
    assert T.term_hits(a, []).count() == 0
    assert T.rank_terms_scan(a, []).count() == 0
    assert T.rank_terms_count(a, []).count() == 0
    assert T.rank_terms_index(T.inverted_index(a, [])).count() == 0
