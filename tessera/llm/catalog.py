"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe_codec as B
from tessera.llm import exact_dedup as D
from tessera.llm import infill as I
from tessera.llm import licenses as C
from tessera.llm import line_dedup as L
from tessera.llm import mixing as M
from tessera.llm import near_dup as N
from tessera.llm import packing as P
from tessera.llm import quality as Q
from tessera.llm import secrets as S
from tessera.llm import token_counts as T
from tessera.llm import url_filter as U
from tessera.llm import vector_codes as V

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


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@register("op1_secret_scan")
def q_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = S.find_secrets(documents(spark, sf).select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")

    base = F.filter("spans", lambda s: s.kind != "random")
    return out.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(S.spans_text(base), 256).alias("base_sha256"),
        S.spans_text(F.col("spans")).alias("spans"),
    )


@register(
    "op2_exact_dedup",
    r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
""",
)
def q_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return D.exact_dedup(documents(spark, sf)).withColumnRenamed("digest", "text_sha256")


PACK_TOKENIZER = "byte_bpe_50k.json"


@register("op3_packing")
def q_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = P.pack(documents(spark, sf), public_tokenizers.path(PACK_TOKENIZER))
    return pieces.select(
        "doc_id", "start", F.col("n").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@register("op4_token_counts")
def q_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return T.token_counts(documents(spark, sf), public_tokenizers.path(PACK_TOKENIZER))


@register("op5_ngram_jaccard")
def q_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    out = N.near_duplicates(documents(spark, sf), size=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id")


@register("ngram_jaccard_links")
def q_ngram_jaccard_links(spark: SparkSession, sf: str) -> DataFrame:
    out = N.near_duplicates(documents(spark, sf), size=4, percent=85, count_links=True)
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


@register("op6_license_scan")
def q_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return C.scan_licenses(documents(spark, sf)).drop("spans")


@register("op7_quality_rules")
def q_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return Q.judge(documents(spark, sf)).select("doc_id", *Q.MEASURES, "base_failed", "kept")


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@register(
    "op8_url_filter",
    r"""
WITH r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
a AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
c AS (
  SELECT row_number() OVER () AS k, page_id,
         translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substring(rest, length(h) + 1), '^[^?#]*') AS path
  FROM b),
m AS (
  SELECT k, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC) AS rn
  FROM c JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM c LEFT JOIN (SELECT * FROM m WHERE rn = 1) USING (k)
""",
)
def q_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return U.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


CODEC_RANKS = "byte_bpe_multi_50k.tiktoken"


@register("op9_bpe_codec")
def q_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(CODEC_RANKS)
    return B.encode(documents(spark, sf), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(B.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


@register(
    "op10_line_dedup",
    r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
g AS (SELECT key FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (
  SELECT k.*, g.key IS NOT NULL AND k.doc_id < max(k.doc_id) OVER (PARTITION BY k.key) AS gone
  FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
""",
)
def q_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    out = L.dedup_lines(documents(spark, sf).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _vector_codes_sql() -> str:
    """The rounds written out: assign (a), then move the entries (b)."""
    assign = """
a{i} AS MATERIALIZED (
  SELECT k, part, min(d) AS d, arg_min(entry, d * 256 + entry) AS entry
  FROM (SELECT k, v.part, entry, sum((v.x - b.x) * (v.x - b.x)) AS d
        FROM v JOIN b{i} b USING (part, pos) GROUP BY k, v.part, entry)
  GROUP BY k, part)"""
    move = """
b{j} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x
  FROM b{i} b LEFT JOIN (
    SELECT part, entry, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM a{i} JOIN v USING (k, part) GROUP BY part, entry, pos) m USING (part, entry, pos))"""
    steps = []
    for i in range(V.ROUNDS + 1):
        steps.append(assign.format(i=i))
        if i < V.ROUNDS:
            steps.append(move.format(i=i, j=i + 1))
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS k, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT k, (p - 1) // (n // 4) AS part, (p - 1) % (n // 4) AS pos, floor(x * 1024)::BIGINT AS x
  FROM (SELECT k, unnest(x) AS x, generate_subscripts(x, 1) AS p, len(x) AS n FROM e)),
b0 AS MATERIALIZED (SELECT part, k - 1 AS entry, pos, x FROM v WHERE k <= 256),
{",".join(steps)},
c AS (SELECT k, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM a{V.ROUNDS} GROUP BY k)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) FROM b{V.ROUNDS}) AS codebooks_sha256
FROM c JOIN e USING (k)
"""


@register("op11_vector_codes", _vector_codes_sql())
def q_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = V.compress(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return codes.select(
        "vec_id", V.code_text(F.col("code")).alias("code"), "error", "label_error",
        F.lit(V.books_sha256(books)).alias("codebooks_sha256"),
    )  # fmt: skip


@register(
    "op12_fill_in_middle",
    r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS u
  FROM documents),
h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t),
c AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
""",
)
def q_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    out = I.fill_in_middle(documents(spark, sf).select("doc_id", "text"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(I.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )  # fmt: skip


@register(
    "op13_mixing",
    r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS size,
         ('0x' || md5('42:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, ''))[1:15])::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
r AS (  -- a source is clamped if the level that is left to it and all of higher size per weight is above
  SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS tw,
         coalesce(sum(3 * source_size) OVER lower, 0) AS c, coalesce(sum(w) OVER lower, 0) AS cw
  FROM s WINDOW lower AS (ORDER BY source_size::DOUBLE / w RANGE UNBOUNDED PRECEDING EXCLUDE GROUP)),
f AS (SELECT *, w * ((t - c)::DOUBLE / (tw - cw)::DOUBLE) > 3 * source_size AS clamped FROM r),
l AS (
  SELECT (any_value(t) - coalesce(sum(3 * source_size) FILTER (WHERE clamped), 0))::DOUBLE
         / (sum(w) FILTER (WHERE NOT clamped))::DOUBLE AS level
  FROM f),
g AS (
  SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE ELSE w * level END AS target FROM f, l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target + 0.5)::BIGINT // source_size, 3) ELSE 0 END AS whole
  FROM g),
o AS (
  SELECT d.*, source_size, target, whole, floor(target + 0.5)::BIGINT - whole * source_size AS wanted,
         sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto,
         sum(size) OVER (PARTITION BY d.source, key) AS held
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * whole + CASE WHEN upto <= wanted THEN size WHEN upto - held < wanted
                            THEN size * (wanted - upto + held) // held ELSE 0 END)::BIGINT AS taken
FROM o
""",
)
def q_mixing(spark: SparkSession, sf: str) -> DataFrame:
    out = M.mix(documents(spark, sf).select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
