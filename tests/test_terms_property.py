"""Property check: token matching equals the padded-contains predicate.

Random articles and term lists over a tiny alphabet (so matches are
frequent) with blanks, doubled blanks, tabs, newlines, multi-word and empty
terms; both Spark paths (inlined list, term-table join) must produce the
same (article, list entry) hits as the brute-force predicate.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import terms as T

WORD = st.text(alphabet="ab", min_size=0, max_size=2)
SEP = st.sampled_from([" ", " ", " ", "  ", "\t", "\n"])


@st.composite
def texts(draw):
    n = draw(st.integers(0, 6))
    parts = [draw(WORD)]
    for _ in range(n):
        parts += [draw(SEP), draw(WORD)]
    return "".join(parts)


@st.composite
def terms(draw):
    n = draw(st.integers(1, 2))
    return " ".join(draw(WORD) for _ in range(n))


def brute(articles, term_list):
    return sorted(
        (title, t, p)
        for title, text in articles
        for p, t in enumerate(term_list)
        if text is not None and (" " + t + " ") in (" " + text + " ")
    )


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    arts=st.lists(st.one_of(texts(), st.none()), min_size=1, max_size=8),
    term_list=st.lists(terms(), min_size=1, max_size=5),
)
def test_token_matching_equals_padded_contains(spark, arts, term_list):
    articles = [(str(i), t) for i, t in enumerate(arts)]
    df = spark.createDataFrame(articles, "title string, text string")
    want = brute(articles, term_list)
    inline = sorted(tuple(r) for r in T.term_hits(df, term_list).collect())
    tdf = spark.createDataFrame(list(enumerate(term_list)), "position int, term string")
    joined = sorted((r.title, r.term, r.position) for r in T.term_hits(df, tdf).collect())
    assert inline == want
    assert joined == want
