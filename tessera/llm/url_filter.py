"""URL filters: host-suffix and path-prefix expressions joined on short hash prefixes.

Every distinct (host, path) is expanded into the expressions a rule could
have: each host suffix at a label boundary, with each path prefix.  Expressions
and rules meet on the first four bytes of their SHA-256; the full digest
confirms the match, and rule precedence (longest rule, then longest host, then
``block`` before ``allow``) picks one rule.

Only suffixes of as many labels, and prefixes of as many slashes (or, for rule
paths that do not end in a slash, of such length), as some rule has can match;
those counts are the one thing read from the rules beforehand.  They are
bounded by the length of the longest rule, not by the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_LOWER, ASCII_UPPER

SHORT_HEX = 8  # four bytes


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or without ``://``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case.  Path: from there up to ``?``, ``#`` or the end.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


def _depth(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _shape(rules: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Label counts of rule hosts, slash counts and lengths of rule paths."""
    slashed = F.col("path").endswith("/")
    row = rules.agg(
        F.collect_set(F.size(F.split("host", "\\."))).alias("labels"),
        F.collect_set(F.when(slashed, _depth(F.col("path")))).alias("depths"),
        F.collect_set(F.when(~slashed, F.length("path"))).alias("lengths"),
    ).first()
    return sorted(row.labels), sorted(row.depths), sorted(row.lengths)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) for every distinct (host, path) that some rule fits.

    ``urls``: columns host, path.  ``rules``: columns host, path, verdict
    (null fields count as empty; a rule fits its host and all subdomains if the
    path starts with the rule's).  Urls without a fitting rule have no row.
    """
    rules = rules.select(
        F.translate(F.coalesce("host", F.lit("")), ASCII_UPPER, ASCII_LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.col("verdict"),
    ).distinct()
    labels, depths, lengths = _shape(rules)
    if not labels:
        return urls.sparkSession.createDataFrame([], "host string, path string, rule string, verdict string")
    digest = F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256)
    keyed = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    ).withColumns({"digest": digest, "short": F.substring(digest, 1, SHORT_HEX)})

    n_labels = F.size(F.split("host", "\\."))
    suffixes = [F.when(n_labels >= n, F.substring_index("host", ".", -n)) for n in labels]
    prefixes = [
        F.when(_depth(F.col("path")) >= n, F.concat(F.substring_index("path", "/", n), F.lit("/"))) for n in depths
    ] + [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    expanded = (
        urls.select("host", "path")
        .distinct()
        .withColumn("rule_host", F.explode(F.array_compact(F.array(*suffixes))))
        .withColumn("rule_path", F.explode(F.array_compact(F.array(*prefixes))))
        .withColumn("full", digest)
        .withColumn("short", F.substring("full", 1, SHORT_HEX))
        .drop("rule_host", "rule_path")
    )
    # the rules are broadcast by Catalyst's own size check, else the join is shuffled and split by AQE
    hits = expanded.join(keyed, "short").filter(F.col("full") == F.col("digest"))
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("a"),
        F.length("rule_host").alias("b"),
        (F.col("rule_verdict") == "block").alias("c"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` by its URL.

    Adds host, path, rule (null if none fits) and verdict; where no rule fits,
    the verdict is ``default``.  Columns of the input that carry one of those
    names are replaced.  Null, empty and malformed urls have an empty host and
    path and take the default; repeated urls are judged once, and equal rows
    all stay.  An empty table gives an empty result.
    """
    host, path = url_parts(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.withColumns({"__host": host, "__path": path}).select(
        *kept, F.col("__host").alias("host"), F.col("__path").alias("path")
    )
    hits = match_rules(parsed.select("host", "path"), rules)
    hits = hits.select(
        F.col("host").alias("__h"), F.col("path").alias("__p"), "rule", F.col("verdict").alias("__v")
    )
    return parsed.join(hits, (F.col("host") == F.col("__h")) & (F.col("path") == F.col("__p")), "left").select(
        *kept, "host", "path", "rule", F.coalesce("__v", F.lit(default)).alias("verdict")
    )
