"""Registered queries: a Spark callable and, where SQL can say it, an
equivalent DuckDB statement over the same parquet tables.

Every query reads the shared tables (``sf_dir``) in full; the SQL is the
brute-force definition of the operator (nested-loop matches, joins before
aggregation, unrolled steps) so that it checks the Spark plan independently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.survey import (
    age_band,
    balanced_sum_sql,
    group_hours,
    sex_label,
    working_status,
)
from tessera.functions.text import mentions_term
from tessera.functions.vectors import nearest_center, nearest_distance
from tessera.operators import clusters as K
from tessera.operators import columns as C
from tessera.operators import forum as Q
from tessera.operators import kmeans as M
from tessera.operators import posting_store as I
from tessera.operators import sampling as P
from tessera.operators import survey as U
from tessera.operators import terms as T
from tessera.plans import pipelines as PL
from tessera.session import delete_tree, release, shared_dir
from tessera.sources import tables as S
from tessera.sources.articles import parse_articles, read_articles
from tessera.sources.postings import parse_postings, read_postings
from tessera.sources.survey import read_survey, read_survey_arrays, survey_arrays

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_sql_str(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


# ---------------------------------------------------------------- terms ----

ARTICLES_SQL = "SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents"
TERMS_SQL = f"SELECT * FROM (VALUES {_values(list(enumerate(S.STANDIN_TERMS)))}) AS t(position, term)"
MENTIONS_SQL = "contains(' ' || a.text || ' ', ' ' || t.term || ' ')"
HITS_SQL = f"""
SELECT a.title, t.term, t.position
FROM ({ARTICLES_SQL}) a JOIN ({TERMS_SQL}) t ON {MENTIONS_SQL}
"""
COUNT_TERM = "of"


@register(
    "parse_articles",
    f"""
WITH l AS (
  SELECT {_sql_str(S.ARTICLE_LEAD)} || CAST(doc_id AS VARCHAR) || '</title><text>' || text
         || {_sql_str(S.ARTICLE_TRAIL)} AS value
  FROM documents),
p AS (SELECT value, instr(value, '</title><text>') AS i FROM l)
SELECT substring(value, 15, i - 15) AS title,
       substring(value, i + 14, length(value) - 16 - (i + 13)) AS text
FROM p
""",
)
def q_parse_articles(spark: SparkSession, sf: str) -> DataFrame:
    return parse_articles(S.article_lines(spark, sf))


@register(
    "mentions_term",
    f"""
SELECT a.title, coalesce(contains(' ' || a.text || ' ', ' the '), false) AS mentions
FROM ({ARTICLES_SQL}) a
""",
)
def q_mentions_term(spark: SparkSession, sf: str) -> DataFrame:
    a = S.articles(spark, sf)
    return a.select("title", mentions_term("text", "the").alias("mentions"))


@register("term_hits", HITS_SQL)
def q_term_hits(spark: SparkSession, sf: str) -> DataFrame:
    return T.term_hits(S.articles(spark, sf), S.STANDIN_TERMS)


@register(
    "term_doc_count",
    f"""
SELECT {_sql_str(COUNT_TERM)} AS term,
       count(*) FILTER (WHERE contains(' ' || a.text || ' ', ' {COUNT_TERM} ')) AS n
FROM ({ARTICLES_SQL}) a
""",
)
def q_term_doc_count(spark: SparkSession, sf: str) -> DataFrame:
    return T.term_doc_count(S.articles(spark, sf), COUNT_TERM)


@register(
    "rank_terms_scan",
    f"""
SELECT t.term, t.position, count(a.title) AS n
FROM ({TERMS_SQL}) t LEFT JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL}
GROUP BY t.term, t.position
""",
)
def q_rank_terms_scan(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_scan(S.articles(spark, sf), S.STANDIN_TERMS)


RANK_SQL = f"SELECT term, count(*) AS n FROM ({HITS_SQL}) h GROUP BY term"


@register("rank_terms_index", RANK_SQL)
def q_rank_terms_index(spark: SparkSession, sf: str) -> DataFrame:
    index = T.inverted_index(S.articles(spark, sf), S.STANDIN_TERMS)
    return T.rank_terms_index(index)


@register("rank_terms_count", RANK_SQL)
def q_rank_terms_count(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_count(S.articles(spark, sf), S.STANDIN_TERMS)


@register(
    "inverted_index",
    f"""
SELECT term, position, title, count(*) OVER (PARTITION BY term) AS n
FROM ({HITS_SQL}) h
""",
)
def q_inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return T.inverted_index(S.articles(spark, sf), S.STANDIN_TERMS, by_size=True)


# --------------------------------------------------------------- survey ----


SURVEY_SQL = """
SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS tucaseid,
       CAST(1 + l_orderkey % 5 AS DOUBLE) AS telfs,
       CAST(1 + l_partkey % 2 AS DOUBLE) AS tesex,
       CAST(10 + l_suppkey % 70 AS DOUBLE) AS teage,
       CAST(l_quantity * 10 AS DOUBLE) AS t010101,
       CAST(l_linenumber * 30 AS DOUBLE) AS t110101,
       CAST(l_orderkey % 7 * 5 AS DOUBLE) AS t180101,
       CAST(l_orderkey % 240 AS DOUBLE) AS t050101,
       CAST(l_partkey % 11 * 3 AS DOUBLE) AS t180501,
       CAST(l_partkey % 300 AS DOUBLE) AS t020101,
       CAST(l_suppkey % 90 AS DOUBLE) AS t120101,
       CAST(l_suppkey % 13 AS DOUBLE) AS t181201,
       CAST(l_linenumber + 1 AS DOUBLE) AS t170101,
       CAST(l_orderkey % 3 AS DOUBLE) AS t500101
FROM lineitem
"""
SURVEY_NAMES = [
    "tucaseid", "telfs", "tesex", "teage", "t010101", "t110101", "t180101", "t050101",
    "t180501", "t020101", "t120101", "t181201", "t170101", "t500101",
]
_P, _W, _O = U.classify_columns(SURVEY_NAMES)
WORKING_SQL = "CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END"
SEX_SQL = "CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END"
AGE_SQL = (
    "CASE WHEN teage >= 15 AND teage <= 22 THEN 'young' "
    "WHEN teage >= 23 AND teage <= 55 THEN 'active' ELSE 'elder' END"
)
HOURS_SQL = (
    f"{balanced_sum_sql(_P)} / 60 AS primaryNeeds, {balanced_sum_sql(_W)} / 60 AS work, "
    f"{balanced_sum_sql(_O)} / 60 AS other"
)
SUMMARY_SQL = (
    f"SELECT {WORKING_SQL} AS working, {SEX_SQL} AS sex, {AGE_SQL} AS age, {HOURS_SQL} "
    f"FROM ({SURVEY_SQL}) s WHERE telfs <= 4"
)


def _survey(spark: SparkSession, sf: str) -> DataFrame:
    return S.survey_table(spark, sf)


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    df = _survey(spark, sf)
    p, w, o = U.classify_columns(df.columns)
    return U.time_usage_summary(p, w, o, df)


@register("working_status", f"SELECT tucaseid, {WORKING_SQL} AS working FROM ({SURVEY_SQL}) s")
def q_working_status(spark: SparkSession, sf: str) -> DataFrame:
    return _survey(spark, sf).select("tucaseid", working_status().alias("working"))


@register("sex_label", f"SELECT tucaseid, {SEX_SQL} AS sex FROM ({SURVEY_SQL}) s")
def q_sex_label(spark: SparkSession, sf: str) -> DataFrame:
    return _survey(spark, sf).select("tucaseid", sex_label().alias("sex"))


@register("age_band", f"SELECT tucaseid, {AGE_SQL} AS age FROM ({SURVEY_SQL}) s")
def q_age_band(spark: SparkSession, sf: str) -> DataFrame:
    return _survey(spark, sf).select("tucaseid", age_band().alias("age"))


@register("group_hours", f"SELECT tucaseid, {HOURS_SQL} FROM ({SURVEY_SQL}) s")
def q_group_hours(spark: SparkSession, sf: str) -> DataFrame:
    df = _survey(spark, sf)
    p, w, o = U.classify_columns(df.columns)
    return df.select(
        "tucaseid",
        group_hours(p).alias("primaryNeeds"),
        group_hours(w).alias("work"),
        group_hours(o).alias("other"),
    )


@register("labour_force_filter", f"SELECT tucaseid, telfs FROM ({SURVEY_SQL}) s WHERE telfs <= 4")
def q_labour_force_filter(spark: SparkSession, sf: str) -> DataFrame:
    return U.labour_force(_survey(spark, sf)).select("tucaseid", "telfs")


@register("time_usage_summary", SUMMARY_SQL)
def q_time_usage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(spark, sf)


@register("time_usage_summary_typed", SUMMARY_SQL)
def q_time_usage_summary_typed(spark: SparkSession, sf: str) -> DataFrame:
    return U.time_usage_summary_typed(_summary(spark, sf))


GROUPED_SQL = U.grouped_sql(f"({SUMMARY_SQL}) summed", via_decimal=True)


@register("time_usage_grouped", GROUPED_SQL)
def q_time_usage_grouped(spark: SparkSession, sf: str) -> DataFrame:
    return U.time_usage_grouped(_summary(spark, sf), via_decimal=True)


@register("time_usage_grouped_sql", GROUPED_SQL)
def q_time_usage_grouped_sql(spark: SparkSession, sf: str) -> DataFrame:
    return U.time_usage_grouped_sql(_summary(spark, sf), via_decimal=True)


@register("time_usage_grouped_typed", GROUPED_SQL)
def q_time_usage_grouped_typed(spark: SparkSession, sf: str) -> DataFrame:
    return U.time_usage_grouped_typed(_summary(spark, sf), via_decimal=True)


# -------------------------------------------------------------- columns ----


@register("column_sum", "SELECT CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS total FROM lineitem")
def q_column_sum(spark: SparkSession, sf: str) -> DataFrame:
    return C.column_sum(S.table(spark, sf, "lineitem"), "l_linenumber")


@register("column_max", "SELECT max(o_orderkey) AS maximum FROM orders")
def q_column_max(spark: SparkSession, sf: str) -> DataFrame:
    return C.column_max(S.table(spark, sf, "orders"), "o_orderkey")


# ---------------------------------------------------------------- forum ----


# Fixed parameters of the forum stand-in: five tags, three kernels each.
LANG_SPREAD = Q.DEFAULT_LANG_SPREAD
KERNELS = 15
ETA = M.DEFAULT_ETA
MAX_ITERATIONS = M.DEFAULT_MAX_ITERATIONS
SEED = P.DEFAULT_SEED
HASH = "md5"  # portable sample order, so the SQL oracle draws the same rows

LANG_INDEX_SQL = "CASE tag " + " ".join(
    f"WHEN {_sql_str(t)} THEN {i}" for i, t in enumerate(S.STANDIN_TAGS)
) + " END"
POSTINGS_SQL = """
SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted_answer,
       CAST(NULL AS BIGINT) AS parent_id, 0 AS score, o_orderpriority AS tag
FROM orders
UNION ALL
SELECT 2, l_orderkey * 8 + l_linenumber, CAST(NULL AS BIGINT), l_orderkey,
       CAST(trunc(l_quantity) AS INTEGER), CAST(NULL AS VARCHAR)
FROM lineitem
"""
QUESTIONS_SQL = f"SELECT * FROM ({POSTINGS_SQL}) p WHERE posting_type = 1"
ANSWERS_SQL = f"SELECT * FROM ({POSTINGS_SQL}) p WHERE posting_type = 2 AND parent_id IS NOT NULL"
PAIRS_SQL = f"""
SELECT q.id, q.accepted_answer, q.score, q.tag, a.id AS answer_id,
       a.accepted_answer AS answer_accepted_answer, a.score AS answer_score, a.tag AS answer_tag
FROM ({QUESTIONS_SQL}) q JOIN ({ANSWERS_SQL}) a ON q.id = a.parent_id
"""
# join first, then the best score per question (brute force)
SCORED_SQL = f"""
SELECT q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tag,
       greatest(0, max(a.score)) AS high_score
FROM ({QUESTIONS_SQL}) q JOIN ({ANSWERS_SQL}) a ON q.id = a.parent_id
GROUP BY q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tag
"""
VECTORS_SQL = f"""
SELECT id, CAST(coalesce({LANG_INDEX_SQL}, 0) AS BIGINT) * {LANG_SPREAD} AS x,
       CAST(high_score AS BIGINT) AS y
FROM ({SCORED_SQL}) s
"""
SAMPLE_KEY_SQL = f"md5('{SEED}:' || CAST(id AS VARCHAR))"
PER_GROUP_SQL = f"""
SELECT id, x, y, sample_rank FROM (
  SELECT id, x, y,
         CAST(row_number() OVER (PARTITION BY x ORDER BY {SAMPLE_KEY_SQL}, id) AS INTEGER) AS sample_rank
  FROM ({VECTORS_SQL}) v) r
WHERE sample_rank <= {KERNELS // len(S.STANDIN_TAGS)}
"""
INIT_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY x, sample_rank) - 1 AS INTEGER) AS cluster, x, y
FROM ({PER_GROUP_SQL}) g
"""
# every vector against every centroid, keep the closest (lowest index on ties)
ASSIGN_SQL = f"""
SELECT id, x, y, cluster, d FROM (
  SELECT id, x, y, cluster, d, row_number() OVER (PARTITION BY id ORDER BY d, cluster) AS r
  FROM (
    SELECT v.id, v.x, v.y, c.cluster,
           CAST(v.x - c.x AS DOUBLE) * (v.x - c.x) + CAST(v.y - c.y AS DOUBLE) * (v.y - c.y) AS d
    FROM ({VECTORS_SQL}) v, centers c) p) q
WHERE r = 1
"""
MEANS_SQL = """
SELECT cluster, CAST(sum(x) // count(*) AS BIGINT) AS x, CAST(sum(y) // count(*) AS BIGINT) AS y,
       count(*) AS n
FROM assigned GROUP BY cluster
"""
STEP_SQL = """
SELECT c.cluster, coalesce(m.x, c.x) AS x, coalesce(m.y, c.y) AS y
FROM centers c LEFT JOIN means m ON c.cluster = m.cluster
"""


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n"


INIT_CTES = (("centers", INIT_SQL), ("assigned", ASSIGN_SQL))
# exact k-means to convergence: each recursion level is one step over all
# (vector, centroid) pairs; `done` stops the recursion
KMEANS_TEMPLATE = """
WITH RECURSIVE
vectors AS ({vectors}),
init AS ({init}),
km(iter, cluster, old_x, old_y, x, y, moved, done) AS (
  SELECT 0, cluster, x, y, x, y, CAST(0 AS DOUBLE), false FROM init
  UNION ALL
  SELECT iter, cluster, old_x, old_y, x, y, moved,
         (sum(moved) OVER () < {eta} OR iter >= {max_iterations}) AS done
  FROM (
    SELECT iter, cluster, old_x, old_y, x, y,
           CAST(x - old_x AS DOUBLE) * (x - old_x) + CAST(y - old_y AS DOUBLE) * (y - old_y) AS moved
    FROM (
      SELECT k_iter + 1 AS iter, k_cluster AS cluster, k_x AS old_x, k_y AS old_y,
             coalesce(CAST(sum(vx) FILTER (WHERE r = 1) // count(*) FILTER (WHERE r = 1) AS BIGINT), k_x) AS x,
             coalesce(CAST(sum(vy) FILTER (WHERE r = 1) // count(*) FILTER (WHERE r = 1) AS BIGINT), k_y) AS y
      FROM (
        SELECT k.iter AS k_iter, k.cluster AS k_cluster, k.x AS k_x, k.y AS k_y, v.x AS vx, v.y AS vy,
               row_number() OVER (
                 PARTITION BY v.id
                 ORDER BY CAST(v.x - k.x AS DOUBLE) * (v.x - k.x) + CAST(v.y - k.y AS DOUBLE) * (v.y - k.y),
                          k.cluster) AS r
        FROM km k, vectors v
        WHERE NOT k.done) pairs
      GROUP BY k_iter, k_cluster, k_x, k_y) stepped) moved_rows
)
"""
KMEANS_SQL = KMEANS_TEMPLATE.format(
    vectors=VECTORS_SQL, init=INIT_SQL, eta=ETA, max_iterations=MAX_ITERATIONS
)

FINAL_CENTERS_SQL = "SELECT cluster, x, y FROM km WHERE iter = (SELECT max(iter) FROM km)"


def _postings(spark: SparkSession, sf: str) -> DataFrame:
    return S.postings(spark, sf)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return Q.posting_vectors(Q.scored_postings(_postings(spark, sf)), S.STANDIN_TAGS, LANG_SPREAD)


def _init_frame(spark: SparkSession, sf: str) -> DataFrame:
    return P.sample_vectors(_vectors(spark, sf), len(S.STANDIN_TAGS), KERNELS, LANG_SPREAD, SEED, HASH)


def _init_centers(spark: SparkSession, sf: str) -> list:
    return P.collect_centroids(_init_frame(spark, sf), KERNELS)


def _final(spark: SparkSession, sf: str) -> M.KMeansResult:
    return M.kmeans(_vectors(spark, sf), _init_centers(spark, sf), ETA, MAX_ITERATIONS)


@register(
    "parse_postings",
    """
WITH l AS (
  SELECT '1,' || CAST(o_orderkey AS VARCHAR) || ',,,0,' || o_orderpriority AS value FROM orders
  UNION ALL
  SELECT '2,' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) || ',,' || CAST(l_orderkey AS VARCHAR)
         || ',' || CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) FROM lineitem),
f AS (SELECT string_split(value, ',') AS f FROM l)
SELECT CAST(f[1] AS INTEGER) AS posting_type, CAST(f[2] AS BIGINT) AS id,
       CAST(nullif(f[3], '') AS BIGINT) AS accepted_answer, CAST(nullif(f[4], '') AS BIGINT) AS parent_id,
       CAST(f[5] AS INTEGER) AS score, nullif(f[6], '') AS tag
FROM f
""",
)
def q_parse_postings(spark: SparkSession, sf: str) -> DataFrame:
    return parse_postings(S.posting_lines(spark, sf))


@register("questions", QUESTIONS_SQL)
def q_questions(spark: SparkSession, sf: str) -> DataFrame:
    return Q.questions(_postings(spark, sf))


@register("answers", ANSWERS_SQL)
def q_answers(spark: SparkSession, sf: str) -> DataFrame:
    return Q.answers(_postings(spark, sf))


@register("question_answer_pairs", PAIRS_SQL)
def q_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return Q.question_answer_pairs(_postings(spark, sf))


@register("grouped_postings", f"SELECT p.*, count(*) OVER (PARTITION BY id) AS n_pairs FROM ({PAIRS_SQL}) p")
def q_grouped_postings(spark: SparkSession, sf: str) -> DataFrame:
    return Q.grouped_postings(_postings(spark, sf))


@register(
    "answer_high_score",
    f"SELECT parent_id AS id, greatest(0, max(score)) AS high_score FROM ({ANSWERS_SQL}) a GROUP BY parent_id",
)
def q_answer_high_score(spark: SparkSession, sf: str) -> DataFrame:
    return Q.answer_high_score(_postings(spark, sf))


@register("scored_postings", SCORED_SQL)
def q_scored_postings(spark: SparkSession, sf: str) -> DataFrame:
    return Q.scored_postings(_postings(spark, sf))


@register(
    "first_tag_index",
    f"SELECT id, tag, {LANG_INDEX_SQL} AS tag_index FROM ({QUESTIONS_SQL}) q",
)
def q_first_tag_index(spark: SparkSession, sf: str) -> DataFrame:
    q = Q.questions(_postings(spark, sf))
    return q.select("id", "tag", Q.first_tag_index("tag", S.STANDIN_TAGS).alias("tag_index"))


@register("posting_vectors", VECTORS_SQL)
def q_posting_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf)


@register(
    "sample_fixed",
    f"SELECT id, x, y FROM ({VECTORS_SQL}) v ORDER BY {SAMPLE_KEY_SQL}, id LIMIT {KERNELS}",
)
def q_sample_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return P.sample_fixed(_vectors(spark, sf), KERNELS, SEED, hashing=HASH)


@register("sample_per_group", PER_GROUP_SQL)
def q_sample_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return P.sample_per_group(_vectors(spark, sf), "x", KERNELS // len(S.STANDIN_TAGS), SEED, hashing=HASH)


PER_LANG = KERNELS // len(S.STANDIN_TAGS)
WEIGHTED_SAMPLE_SQL = f"""
WITH w AS (SELECT x, y, count(*) AS n FROM ({VECTORS_SQL}) v GROUP BY x, y),
c AS (SELECT x, y, n, unnest(range(1, least(n, {PER_LANG}) + 1)) AS j FROM w),
u AS (
  SELECT x, y, n, j,
         (CAST(('0x' || substr(md5('{SEED}:' || x || ':' || y || ':' || j), 1, 13)) AS BIGINT) + 0.5)
           / 4503599627370496.0 AS v
  FROM c),
k AS (
  SELECT x, y, j,
         -sum(ln(v) / CAST(n - j + 1 AS DOUBLE))
           OVER (PARTITION BY x, y ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key
  FROM u),
r AS (SELECT x, y, CAST(row_number() OVER (PARTITION BY x ORDER BY key, x, y, j) AS INTEGER) AS sample_rank FROM k)
SELECT x, y, sample_rank FROM r WHERE sample_rank <= {PER_LANG}
"""


@register("sample_weighted", WEIGHTED_SAMPLE_SQL)
def q_sample_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return P.sample_weighted(M.weighted_vectors(_vectors(spark, sf)), "x", PER_LANG, SEED, hashing=HASH)


@register("sample_vectors", INIT_SQL)
def q_sample_vectors(spark: SparkSession, sf: str) -> DataFrame:
    init = _init_frame(spark, sf)
    P.collect_centroids(init, KERNELS)  # validates the count, as the reference asserts
    return init


@register("nearest_center", _with(*INIT_CTES) + "SELECT id, cluster FROM assigned")
def q_nearest_center(spark: SparkSession, sf: str) -> DataFrame:
    centers = _init_centers(spark, sf)
    return _vectors(spark, sf).select("id", nearest_center(centers).cast("int").alias("cluster"))


@register("point_distance", _with(*INIT_CTES) + "SELECT id, cluster, d AS distance FROM assigned")
def q_point_distance(spark: SparkSession, sf: str) -> DataFrame:
    centers = _init_centers(spark, sf)
    return _vectors(spark, sf).select(
        "id",
        nearest_center(centers).cast("int").alias("cluster"),
        nearest_distance(centers).alias("distance"),
    )


@register("average_vectors", _with(*INIT_CTES) + MEANS_SQL)
def q_average_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return M.average_vectors(_vectors(spark, sf), _init_centers(spark, sf))


@register("kmeans_step", _with(*INIT_CTES, ("means", MEANS_SQL)) + STEP_SQL)
def q_kmeans_step(spark: SparkSession, sf: str) -> DataFrame:
    return M.kmeans_step(_vectors(spark, sf), _init_centers(spark, sf))


@register(
    "centroid_shift",
    _with(*INIT_CTES, ("means", MEANS_SQL), ("step", STEP_SQL))
    + """
SELECT sum(CAST(c.x - s.x AS DOUBLE) * (c.x - s.x) + CAST(c.y - s.y AS DOUBLE) * (c.y - s.y)) AS shift
FROM centers c JOIN step s ON c.cluster = s.cluster
""",
)
def q_centroid_shift(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    centers = _init_centers(spark, sf)
    return M.centroid_shift_frame(M.centroid_frame(spark, centers), M.kmeans_step(v, centers))


@register("kmeans", KMEANS_SQL + FINAL_CENTERS_SQL)
def q_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return _final(spark, sf).centers_frame(spark)


@register(
    "kmeans_trace",
    KMEANS_SQL
    + "SELECT CAST(iter AS INTEGER) AS iteration, cluster, old_x, old_y, x, y, moved, "
    "sum(moved) OVER (PARTITION BY iter) AS shift FROM km WHERE iter >= 1",
)
def q_kmeans_trace(spark: SparkSession, sf: str) -> DataFrame:
    return _final(spark, sf).trace_frame(spark)


# cluster descriptions over the converged centroids
CLUSTER_TAIL = (
    f""",
centers AS ({FINAL_CENTERS_SQL}),
assigned AS ({ASSIGN_SQL}),
per_x AS (SELECT cluster, x, count(*) AS cnt FROM assigned GROUP BY cluster, x),
labels AS (
  SELECT cluster, min(x) AS label_x, sum(cnt) AS size,
         arg_min(cnt, x) AS label_cnt
  FROM per_x GROUP BY cluster),
medians AS (SELECT cluster, median(y) AS med FROM assigned GROUP BY cluster),
results AS (
  SELECT l.cluster,
         [{", ".join(_sql_str(t) for t in S.STANDIN_TAGS)}][CAST(label_x // {LANG_SPREAD} AS INTEGER) + 1] AS label,
         CAST(label_cnt * 100 AS DOUBLE) / size AS percent,
         CAST(size AS BIGINT) AS size,
         CAST(trunc(med) AS INTEGER) AS median_score
  FROM labels l JOIN medians m ON l.cluster = m.cluster)
"""
)
CLUSTER_SQL = KMEANS_SQL.rstrip() + CLUSTER_TAIL
WEIGHTED_INIT_SQL = f"""
SELECT CAST(row_number() OVER (ORDER BY x, sample_rank) - 1 AS INTEGER) AS cluster, x, y
FROM ({WEIGHTED_SAMPLE_SQL}) g
"""
# the cluster pipeline's default route: centroids sampled from the weighted points
WEIGHTED_CLUSTER_SQL = (
    KMEANS_TEMPLATE.format(
        vectors=VECTORS_SQL, init=WEIGHTED_INIT_SQL, eta=ETA, max_iterations=MAX_ITERATIONS
    ).rstrip()
    + CLUSTER_TAIL
)


def _described(spark: SparkSession, sf: str, **options: str) -> DataFrame:
    """Cluster descriptions (one row per centroid at most), with the pipeline's stored table released."""
    described, result = PL.pipeline_clusters(
        _postings(spark, sf), S.STANDIN_TAGS, LANG_SPREAD, KERNELS, ETA, MAX_ITERATIONS, SEED,
        sample_hash=HASH, **options,
    )
    try:
        return spark.createDataFrame(described.collect(), described.schema)
    finally:
        release(result.inputs)


def _results(spark: SparkSession, sf: str) -> DataFrame:
    return _described(spark, sf, sample_from="vectors")


@register("cluster_results", CLUSTER_SQL + "SELECT cluster, label, percent, size, median_score FROM results")
def q_cluster_results(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf)


@register("cluster_label", CLUSTER_SQL + "SELECT cluster, label FROM results")
def q_cluster_label(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("cluster", "label")


@register("cluster_percent", CLUSTER_SQL + "SELECT cluster, percent FROM results")
def q_cluster_percent(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("cluster", "percent")


@register("cluster_size", CLUSTER_SQL + "SELECT cluster, size FROM results")
def q_cluster_size(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("cluster", "size")


@register("cluster_median", CLUSTER_SQL + "SELECT cluster, median_score FROM results")
def q_cluster_median(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).select("cluster", "median_score")


@register(
    "cluster_report",
    CLUSTER_SQL
    + f"""
SELECT CAST(i AS INTEGER) AS line_no, line FROM (VALUES
  {", ".join(f"({i}, {_sql_str(s)})" for i, s in enumerate(K.REPORT_HEADER))}) h(i, line)
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY median_score, cluster) + {len(K.REPORT_HEADER) - 1} AS INTEGER),
       printf('{K.REPORT_LINE}', median_score, label, percent, size)
FROM results
""",
)
def q_cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return K.cluster_report(_results(spark, sf))


# ------------------------------------------------------------ pipelines ----


@register(
    "pipeline_terms",
    f"""
WITH articles AS (
  SELECT substring(value, 15, i - 15) AS title,
         substring(value, i + 14, length(value) - 16 - (i + 13)) AS text
  FROM (SELECT value, instr(value, '</title><text>') AS i FROM (
    SELECT {_sql_str(S.ARTICLE_LEAD)} || CAST(doc_id AS VARCHAR) || '</title><text>' || text
           || {_sql_str(S.ARTICLE_TRAIL)} AS value FROM documents) l) p),
terms AS ({TERMS_SQL}),
hits AS (SELECT a.title, t.term, t.position FROM articles a JOIN terms t ON {MENTIONS_SQL})
SELECT 'scan' AS strategy, t.term, count(h.title) AS n
FROM terms t LEFT JOIN hits h ON t.position = h.position GROUP BY t.term, t.position
UNION ALL SELECT 'index', term, count(*) FROM hits GROUP BY term
UNION ALL SELECT 'count', term, count(*) FROM hits GROUP BY term
""",
)
def q_pipeline_terms(spark: SparkSession, sf: str) -> DataFrame:
    articles = parse_articles(S.article_lines(spark, sf))
    return PL.pipeline_terms(articles, S.STANDIN_TERMS)


@register(
    "pipeline_clusters", WEIGHTED_CLUSTER_SQL + "SELECT cluster, label, percent, size, median_score FROM results"
)
def q_pipeline_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return _described(spark, sf, sample_from="weighted")


@register("pipeline_survey", GROUPED_SQL)
def q_pipeline_survey(spark: SparkSession, sf: str) -> DataFrame:
    return PL.pipeline_survey(_survey(spark, sf), via_decimal=True)


# ------------------------------------------------- operator option variants ----

LANGUAGE_TERMS_SQL = f"SELECT * FROM (VALUES {_values(list(enumerate(S.LANGUAGES)))}) AS t(position, term)"


@register(
    "rank_languages_scan",
    f"""
SELECT t.term, t.position, count(a.title) AS n
FROM ({LANGUAGE_TERMS_SQL}) t LEFT JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL}
GROUP BY t.term, t.position
""",
)
def q_rank_languages_scan(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_scan(S.articles(spark, sf), S.LANGUAGES)


SMALL_SPREAD = 100
SMALL_SPREAD_VECTORS_SQL = VECTORS_SQL.replace(f"* {LANG_SPREAD} AS x", f"* {SMALL_SPREAD} AS x")


@register(
    "sample_vectors_small_spread",
    f"""
SELECT CAST(row_number() OVER (ORDER BY x, sample_rank) - 1 AS INTEGER) AS cluster, x, y FROM (
  SELECT x, y, row_number() OVER (ORDER BY {SAMPLE_KEY_SQL}, id) AS sample_rank
  FROM (SELECT * FROM ({SMALL_SPREAD_VECTORS_SQL}) v ORDER BY {SAMPLE_KEY_SQL}, id LIMIT {KERNELS}) s) r
""",
)
def q_sample_vectors_small_spread(spark: SparkSession, sf: str) -> DataFrame:
    v = Q.posting_vectors(Q.scored_postings(_postings(spark, sf)), S.STANDIN_TAGS, SMALL_SPREAD)
    init = P.sample_vectors(v, len(S.STANDIN_TAGS), KERNELS, SMALL_SPREAD, SEED, HASH)
    P.collect_centroids(init, KERNELS)
    return init


@register(
    "cluster_results_mode",
    CLUSTER_SQL.replace(
        "labels AS (",
        """mode_x AS (
  SELECT cluster, x AS mode_x, cnt AS mode_cnt FROM (
    SELECT cluster, x, cnt, row_number() OVER (PARTITION BY cluster ORDER BY cnt DESC, x) AS r
    FROM per_x) m WHERE r = 1),
labels_lowest AS (""",
    ).replace(
        "medians AS (",
        """labels AS (
  SELECT l.cluster, m.mode_x AS label_x, l.size, m.mode_cnt AS label_cnt
  FROM labels_lowest l JOIN mode_x m ON l.cluster = m.cluster),
medians AS (""",
    )
    + "SELECT cluster, label, percent, size, median_score FROM results",
)
def q_cluster_results_mode(spark: SparkSession, sf: str) -> DataFrame:
    return _described(spark, sf, label_rule="mode", sample_from="vectors")


def _wide_sql() -> str:
    cols = S.wide_survey_columns()
    acts = ", ".join(
        f"CAST(({S.WIDE_KEYS[k]} + {i}) % {m} AS DOUBLE) AS {name}" for i, (name, k, m) in enumerate(cols)
    )
    table = (
        "SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS tucaseid, "
        "CAST(1 + l_orderkey % 5 AS DOUBLE) AS telfs, CAST(1 + l_partkey % 2 AS DOUBLE) AS tesex, "
        f"CAST(10 + l_suppkey % 70 AS DOUBLE) AS teage, {acts} FROM lineitem"
    )
    p, w, o = U.classify_columns([c[0] for c in cols])
    hours = (
        f"{balanced_sum_sql(p)} / 60 AS primaryNeeds, {balanced_sum_sql(w)} / 60 AS work, "
        f"{balanced_sum_sql(o)} / 60 AS other"
    )
    summary = (
        f"SELECT {WORKING_SQL} AS working, {SEX_SQL} AS sex, {AGE_SQL} AS age, {hours} "
        f"FROM ({table}) s WHERE telfs <= 4"
    )
    return U.grouped_sql(f"({summary}) summed", via_decimal=True)


@register("pipeline_survey_wide", _wide_sql())
def q_pipeline_survey_wide(spark: SparkSession, sf: str) -> DataFrame:
    return PL.pipeline_survey(S.wide_survey_table(spark, sf), via_decimal=True)


@register("pipeline_survey_arrays", _wide_sql())
def q_pipeline_survey_arrays(spark: SparkSession, sf: str) -> DataFrame:
    return PL.pipeline_survey_arrays(*survey_arrays(S.wide_survey_table(spark, sf)), via_decimal=True)


# -------------------------------------------------- defaults, quirks, files ----


MANY_CENTERS = [(i % 5 * LANG_SPREAD, i // 5 % 60) for i in range(1500)]


@register(
    "nearest_center_many",
    f"""
SELECT id, CAST(min({{'d': (x - cx) * (x - cx) + (y - cy) * (y - cy), 'i': i}}).i AS INTEGER) AS cluster
FROM ({VECTORS_SQL}) v,
     (SELECT i, i % 5 * {LANG_SPREAD} AS cx, i // 5 % 60 AS cy FROM range({len(MANY_CENTERS)}) r(i)) c
GROUP BY id
""",
)
def q_nearest_center_many(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf).select("id", nearest_center(MANY_CENTERS).cast("int").alias("cluster"))


def _first_words(spark: SparkSession, sf: str, n: int) -> DataFrame:
    """A term table: the first ``n`` words of each document; many are listed several times."""
    words = F.substring_index("text", " ", n)
    return S.table(spark, sf, "documents").select(
        F.col("doc_id").alias("position"), words.alias("term")
    ).where("term <> ''")


def _first_words_sql(n: int) -> str:
    words = f"array_to_string(string_split(text, ' ')[1:{n}], ' ')"
    return f"SELECT doc_id AS position, {words} AS term FROM documents WHERE {words} <> ''"


@register(
    "rank_terms_scan_table",
    f"""
SELECT t.term, t.position, count(a.title) AS n
FROM ({_first_words_sql(1)}) t LEFT JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL} GROUP BY t.term, t.position
""",
)
def q_rank_terms_scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_scan(S.articles(spark, sf), _first_words(spark, sf, 1))


@register(
    "rank_terms_count_table",
    f"SELECT t.term, count(*) AS n FROM ({_first_words_sql(2)}) t JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL} GROUP BY t.term",
)
def q_rank_terms_count_table(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_count(S.articles(spark, sf), _first_words(spark, sf, 2))


QUIRK_TAGS = S.STANDIN_TAGS[:2] + S.STANDIN_TAGS[3:]  # one priority is an unknown tag


@register(
    "posting_vectors_quirks",
    f"""
WITH best AS (
  SELECT l_orderkey AS id, max(CAST(l_quantity AS INTEGER) - 25) AS m FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS id,
       CAST(CASE o_orderpriority {' '.join(f"WHEN {_sql_str(t)} THEN {i}" for i, t in enumerate(QUIRK_TAGS))}
            ELSE 0 END AS BIGINT) * {LANG_SPREAD} AS x,
       CAST(greatest(0, m) AS BIGINT) AS y
FROM orders JOIN best ON o_orderkey = id
""",
)
def q_posting_vectors_quirks(spark: SparkSession, sf: str) -> DataFrame:
    """Negative scores, an unknown tag, every question twice, an orphan of every answer."""
    p = _postings(spark, sf)
    question, answer = p.where("posting_type = 1"), p.where("posting_type = 2")
    low = answer.withColumn("score", F.col("score") - 25)
    orphans = low.withColumn("parent_id", -F.col("parent_id") - 1)
    quirky = question.unionByName(question.withColumn("score", F.lit(1))).unionByName(low).unionByName(orphans)
    return Q.posting_vectors(Q.scored_postings(quirky), QUIRK_TAGS, LANG_SPREAD)


REPEATED_TERMS = [S.STANDIN_TERMS[0], "zzz not there", *S.STANDIN_TERMS[:3], S.STANDIN_TERMS[0]]


@register(
    "rank_terms_scan_repeated",
    f"""
SELECT t.term, t.position, count(a.title) AS n
FROM (SELECT * FROM (VALUES {_values(list(enumerate(REPEATED_TERMS)))}) AS v(position, term)) t
LEFT JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL} GROUP BY t.term, t.position
""",
)
def q_rank_terms_scan_repeated(spark: SparkSession, sf: str) -> DataFrame:
    return T.rank_terms_scan(S.articles(spark, sf), REPEATED_TERMS)


# the default sampler hashes with xxhash64, which SQL elsewhere does not have: what is
# checked is its contract, at most k members of each group, all of them input points
@register(
    "sample_per_group_default",
    f"""
SELECT x, CAST(least(count(*), {KERNELS}) AS BIGINT) AS n, CAST(0 AS BIGINT) AS strangers
FROM ({VECTORS_SQL}) v GROUP BY x
""",
)
def q_sample_per_group_default(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    sample = P.sample_per_group(v, "x", KERNELS).select("id", "x", "y")
    known = v.select("id", "x", "y").withColumn("known", F.lit(1))
    return sample.join(known, ["id", "x", "y"], "left").groupBy("x").agg(
        F.count("*").alias("n"), F.count_if(F.col("known").isNull()).alias("strangers")
    )


def _through_files(
    spark: SparkSession, frame: DataFrame, kind: str, use: Callable[[str], DataFrame], header: bool = False
) -> DataFrame:
    """The small result of ``use`` on files of ``frame`` in the shared folder, which are then deleted."""
    path = f"{shared_dir(spark)}/{kind}-files-{uuid.uuid4().hex}"
    if header:
        frame.write.option("header", True).option("quote", "").csv(path)
    else:
        frame.write.text(path)
    try:
        out = use(path)
        return spark.createDataFrame(out.collect(), out.schema)
    finally:
        delete_tree(spark, path)


ONE_LINE_SQL = "SELECT CAST(doc_id AS VARCHAR) AS title, replace(text, chr(10), ' ') AS text FROM documents"


@register("read_articles_files", RANK_SQL.replace(ARTICLES_SQL, ONE_LINE_SQL))
def q_read_articles_files(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking over article files, one line per article, one row per listed term."""
    lines = S.article_lines(spark, sf).select(F.translate("value", "\n", " ").alias("value"))
    return _through_files(
        spark, lines, "article", lambda p: T.rank_terms_count(read_articles(spark, p), S.STANDIN_TERMS)
    )


@register(
    "read_postings_files",
    f"""
SELECT posting_type, tag, count(*) AS n, CAST(sum(score) AS BIGINT) AS total, count(parent_id) AS parents
FROM (SELECT posting_type, tag, score, parent_id FROM ({QUESTIONS_SQL}) q
      UNION ALL SELECT posting_type, tag, score, parent_id FROM ({ANSWERS_SQL}) a) p
GROUP BY posting_type, tag
""",
)
def q_read_postings_files(spark: SparkSession, sf: str) -> DataFrame:
    """Sums over posting files, one row per type and tag."""

    def use(path: str) -> DataFrame:
        return read_postings(spark, path).groupBy("posting_type", "tag").agg(
            F.count("*").alias("n"), F.sum("score").alias("total"), F.count("parent_id").alias("parents")
        )

    return _through_files(spark, S.posting_lines(spark, sf), "posting", use)


@register("read_survey_files", GROUPED_SQL)
def q_read_survey_files(spark: SparkSession, sf: str) -> DataFrame:
    """The grouped survey over CSV files read strictly, one row per status, sex and age."""

    def use(path: str) -> DataFrame:
        return PL.pipeline_survey(read_survey(spark, path)[1], via_decimal=True)

    return _through_files(spark, _survey(spark, sf), "survey", use, header=True)


@register("read_survey_arrays_files", GROUPED_SQL)
def q_read_survey_arrays_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same from files read as an array table."""

    def use(path: str) -> DataFrame:
        return PL.pipeline_survey_arrays(*read_survey_arrays(spark, path), via_decimal=True)

    return _through_files(spark, _survey(spark, sf), "survey", use, header=True)


# --------------------------------------------------- stores, nested, ranges ----


def _new_folder(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage; what a result still reads stays there for the caller to delete."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


INDEX_BLOCK = 100


def _index(spark: SparkSession, sf: str) -> I.PostingStore:
    path = _new_folder(spark, "index")
    return I.write_index(S.articles(spark, sf), path, S.STANDIN_TERMS, block_size=INDEX_BLOCK, buckets=8)


NUMBERED_SQL = f"SELECT title, row_number() OVER (ORDER BY title) - 1 AS article_id FROM ({ARTICLES_SQL}) a"


@register(
    "inverted_index_nested",
    f"""
WITH p AS (
  SELECT term, article_id,
         (row_number() OVER (PARTITION BY term ORDER BY article_id) - 1) // {INDEX_BLOCK} AS block
  FROM ({HITS_SQL}) h JOIN ({NUMBERED_SQL}) n USING (title))
SELECT term, block, count(*) AS n, min(article_id) AS first_id, max(article_id) AS last_id,
       string_agg(CAST(article_id AS VARCHAR), ',' ORDER BY article_id) AS ids
FROM p GROUP BY term, block
""",
)
def q_inverted_index_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = _index(spark, sf).nested()
    return nested.withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@register("rank_terms_store", RANK_SQL)
def q_rank_terms_store(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).rank()


LOOKED_UP = S.STANDIN_TERMS[3:6]


@register(
    "index_lookup",
    f"""
SELECT term, article_id, title FROM ({HITS_SQL}) h JOIN ({NUMBERED_SQL}) n USING (title)
WHERE term IN ({", ".join(map(_sql_str, LOOKED_UP))})
""",
)
def q_index_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).lookup(LOOKED_UP)


@register(
    "index_mention_all",
    f"""
SELECT article_id, title FROM ({HITS_SQL}) h JOIN ({NUMBERED_SQL}) n USING (title)
WHERE term IN ({", ".join(map(_sql_str, LOOKED_UP))}) GROUP BY article_id, title HAVING count(*) = {len(LOOKED_UP)}
""",
)
def q_index_mention_all(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf).mention_all(LOOKED_UP)


@register(
    "term_hits_screened",
    f"SELECT a.title, t.term, t.position FROM ({_first_words_sql(2)}) t JOIN ({ARTICLES_SQL}) a ON {MENTIONS_SQL}",
)
def q_term_hits_screened(spark: SparkSession, sf: str) -> DataFrame:
    """A term table that is not broadcast: its filter screens the word runs."""
    return T.term_hits(S.articles(spark, sf), _first_words(spark, sf, 2), broadcast_rows=0)


SEGMENT = 3


@register(
    "grouped_postings_nested",
    f"""
WITH s AS (
  SELECT id, answer_id, (row_number() OVER (PARTITION BY id ORDER BY answer_id) - 1) // {SEGMENT} AS segment
  FROM ({PAIRS_SQL}) p)
SELECT id, segment, count(*) AS n, string_agg(CAST(answer_id AS VARCHAR), ',' ORDER BY answer_id) AS answers
FROM s GROUP BY id, segment
""",
)
def q_grouped_postings_nested(spark: SparkSession, sf: str) -> DataFrame:
    answers = F.transform("pairs", lambda p: p.answer.id.cast("string"))
    nested = Q.nested_postings(_postings(spark, sf), SEGMENT)
    return nested.select("id", "segment", "n", F.array_join(answers, ",").alias("answers"))


@register(
    "median_by_range",
    f"SELECT CAST(x AS BIGINT) AS cluster, median(y) AS med FROM ({VECTORS_SQL}) v GROUP BY x",
)
def q_median_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """Median score per language, from range-sorted counts; one row per language is collected."""
    per_y = _vectors(spark, sf).groupBy(F.col("x").alias("cluster"), "y").agg(F.count("*").alias("cnt"))
    return K.medians_by_range(per_y)


@register("sample_per_group_merged", PER_GROUP_SQL)
def q_sample_per_group_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The sample of all vectors from sketches of two batches, one of them stored first."""
    k = KERNELS // len(S.STANDIN_TAGS)
    store = P.SketchStore(spark, _new_folder(spark, "sketch"), "x", k, SEED, hashing=HASH)
    vectors = _vectors(spark, sf)
    answered_well = F.col("y") > 40
    store.add(vectors.where(answered_well), "above 40")
    store.add(vectors.where(~answered_well), "up to 40")
    return store.sample()


CELL_CENTERS = MANY_CENTERS[:700]


@register(
    "nearest_center_cells",
    f"""
SELECT id, CAST(min({{'d': (x - cx) * (x - cx) + (y - cy) * (y - cy), 'i': i}}).i AS INTEGER) AS cluster
FROM ({VECTORS_SQL}) v,
     (SELECT i, i % 5 * {LANG_SPREAD} AS cx, i // 5 % 60 AS cy FROM range({len(CELL_CENTERS)}) r(i)) c
GROUP BY id
""",
)
def q_nearest_center_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest of many centroids, looked up by cell."""
    return M.assign(_vectors(spark, sf), CELL_CENTERS).select("id", "cluster")


@register("kmeans_bounds", KMEANS_SQL + FINAL_CENTERS_SQL)
def q_kmeans_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """k-means that compares only the vectors that may have changed cluster; the same centroids."""
    result = M.kmeans(_vectors(spark, sf), _init_centers(spark, sf), ETA, MAX_ITERATIONS, bounds=True)
    return result.centers_frame(spark)
