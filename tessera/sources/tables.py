"""Stand-ins for the reference inputs, derived from the shared parquet tables.

The reference ships none of its data files.  Each function here derives
the operator input from the TPC-H-style tables with plain projections, so
work grows with the tables:

* articles  <- documents (title = doc_id, text = text)
* postings  <- orders (questions: id = o_orderkey, tag = o_orderpriority)
               and lineitem (answers: parent = l_orderkey,
               score = integer quantity)
* survey    <- lineitem (status, sex, age and minute columns from keys)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.articles import LEAD_CHARS, TITLE_END, TRAIL_CHARS

# Fixed stand-in parameters.
# Terms ranked over `documents`: fourteen common words and one absent word.
STANDIN_TERMS = [
    "in", "the", "and", "to", "of", "a", "is", "on", "that", "was",
    "as", "be", "it", "for", "zzz",
]
# The reference's language list (none of these occurs in `documents`).
LANGUAGES = [
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
]
# Order priorities play the languages of the forum stand-in.
STANDIN_TAGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Markup around an article record: 14 leading and 16 trailing characters.
ARTICLE_LEAD = "<doc>  <title>"
ARTICLE_TRAIL = "</text>   </doc>"
assert len(ARTICLE_LEAD) == LEAD_CHARS and len(ARTICLE_TRAIL) == TRAIL_CHARS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``title string, text string``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("title"), F.col("text")
    )


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw article record per document, column ``value``."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(
            F.lit(ARTICLE_LEAD),
            F.col("doc_id").cast("string"),
            F.lit(TITLE_END),
            F.col("text"),
            F.lit(ARTICLE_TRAIL),
        ).alias("value")
    )


def _question_cols() -> list:
    return [
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        F.lit(0).alias("score"),
        F.col("o_orderpriority").alias("tag"),
    ]


def _answer_cols() -> list:
    return [
        F.lit(2).alias("posting_type"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.col("l_orderkey").alias("parent_id"),
        F.col("l_quantity").cast("int").alias("score"),
        F.lit(None).cast("string").alias("tag"),
    ]


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed postings: questions from orders, answers from lineitem."""
    q = table(spark, sf_dir, "orders").select(*_question_cols())
    a = table(spark, sf_dir, "lineitem").select(*_answer_cols())
    return q.unionByName(a)


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same postings as raw comma-separated lines, column ``value``.

    Questions have six fields, answers five (no tag field at all).
    """
    q = table(spark, sf_dir, "orders").select(
        F.concat_ws(",", F.lit("1"), "o_orderkey", F.lit(""), F.lit(""), F.lit("0"), "o_orderpriority").alias("value")
    )
    a = table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            ",",
            F.lit("2"),
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"),
            F.lit(""),
            F.col("l_orderkey").cast("string"),
            F.col("l_quantity").cast("int").cast("string"),
        ).alias("value")
    )
    return q.unionByName(a)


def survey_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time-use survey: ``tucaseid`` text, then whole-minute double columns."""
    li = table(spark, sf_dir, "lineitem")
    d = lambda c: c.cast("double")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("tucaseid"),
        d(1 + F.col("l_orderkey") % 5).alias("telfs"),
        d(1 + F.col("l_partkey") % 2).alias("tesex"),
        d(10 + F.col("l_suppkey") % 70).alias("teage"),
        d(F.col("l_quantity") * 10).alias("t010101"),
        d(F.col("l_linenumber") * 30).alias("t110101"),
        d(F.col("l_orderkey") % 7 * 5).alias("t180101"),
        d(F.col("l_orderkey") % 240).alias("t050101"),
        d(F.col("l_partkey") % 11 * 3).alias("t180501"),
        d(F.col("l_partkey") % 300).alias("t020101"),
        d(F.col("l_suppkey") % 90).alias("t120101"),
        d(F.col("l_suppkey") % 13).alias("t181201"),
        d(F.col("l_linenumber") + 1).alias("t170101"),
        d(F.col("l_orderkey") % 3).alias("t500101"),
    )


# Wide survey: 450 activity columns named by rule, cycling through the
# activity-code prefixes (including two that match no group).
WIDE_PREFIXES = [
    "t01", "t03", "t11", "t1801", "t1803", "t05", "t1805", "t02", "t04", "t06",
    "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18", "t17", "t50",
]
WIDE_ACTIVITY_COLUMNS = 450


def wide_survey_columns(n: int = WIDE_ACTIVITY_COLUMNS) -> list[tuple[str, int, int]]:
    """(name, key column index, modulus) for each generated activity column."""
    out = []
    for i in range(n):
        prefix = WIDE_PREFIXES[i % len(WIDE_PREFIXES)]
        out.append((f"{prefix}{i:04d}", i % 3, 7 + i % 53))
    return out


WIDE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey"]


def wide_survey_table(spark: SparkSession, sf_dir: str, n: int = WIDE_ACTIVITY_COLUMNS) -> DataFrame:
    """``survey_table``'s respondent columns plus ``n`` activity columns,
    each ``(key + i) % modulus`` minutes of one of the lineitem keys."""
    li = table(spark, sf_dir, "lineitem")
    acts = [
        ((F.col(WIDE_KEYS[k]) + i) % m).cast("double").alias(name)
        for i, (name, k, m) in enumerate(wide_survey_columns(n))
    ]
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("tucaseid"),
        (1 + F.col("l_orderkey") % 5).cast("double").alias("telfs"),
        (1 + F.col("l_partkey") % 2).cast("double").alias("tesex"),
        (10 + F.col("l_suppkey") % 70).cast("double").alias("teage"),
        *acts,
    )
