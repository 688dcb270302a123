"""End-to-end jobs composed from the operators.

* :func:`pipeline_terms`    - raw article records -> the three rankings.
* :func:`pipeline_clusters` - postings -> scored vectors -> sampled
  centroids -> k-means -> cluster descriptions.
* :func:`pipeline_survey`   - survey table -> classified columns ->
  summary -> averages by working status, sex and age band.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import clusters as K
from tessera.operators import forum as Q
from tessera.operators import kmeans as M
from tessera.operators import sampling as P
from tessera.operators import survey as U
from tessera.operators import terms as T
from tessera.session import check_state, committed, input_fingerprint, materialize, release

STRATEGIES = ("scan", "index", "count")


def rankings(articles: DataFrame, terms: Sequence[str]) -> dict[str, DataFrame]:
    """The three ranking strategies, keyed by name (lazy DataFrames)."""
    return {
        "scan": T.rank_terms_scan(articles, terms),
        "index": T.rank_terms_index(T.inverted_index(articles, terms)),
        "count": T.rank_terms_count(articles, terms),
    }


def pipeline_terms(articles: DataFrame, terms: Sequence[str]) -> DataFrame:
    """All three rankings in one frame: ``strategy, term, n``."""
    frames = [
        df.select(F.lit(name).alias("strategy"), "term", "n")
        for name, df in rankings(articles, terms).items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(label: str, action: Callable[[], object], log: list[str]) -> float:
    """Wall-clock one action; appends ``Processing <label> took <n> ms.``"""
    start = time.perf_counter()
    action()
    ms = (time.perf_counter() - start) * 1000
    log.append(f"Processing {label} took {ms:.0f} ms.")
    return ms / 1000


def compare_strategies(articles: DataFrame, terms: Sequence[str]) -> dict[str, float]:
    """Time each ranking strategy (index time includes building the index)."""
    log: list[str] = []
    out = {}
    for name, df in rankings(articles, terms).items():
        out[name] = timed(f"ranking by {name}", lambda d=df: _run(d), log)
    print("\n".join(log))
    return out


def pipeline_clusters(
    postings: DataFrame,
    languages: Sequence[str],
    lang_spread: int = Q.DEFAULT_LANG_SPREAD,
    kernels: int = Q.DEFAULT_KERNELS,
    eta: float = M.DEFAULT_ETA,
    max_iterations: int = M.DEFAULT_MAX_ITERATIONS,
    seed: int = P.DEFAULT_SEED,
    label_rule: str = "lowest",
    materialize_postings: bool = False,
    sample_hash: str = "xxhash64",
    sample_from: str = "weighted",
    kmeans_state: str | None = None,
) -> tuple[DataFrame, M.KMeansResult]:
    """Cluster answered questions by (language, best answer score).

    Returns the cluster descriptions (lazy) and the k-means result.  The
    vectors are collapsed to distinct weighted points ``(x, y, n)`` and
    materialised once; that table (bounded by the number of distinct
    points, not by the number of postings) feeds the sampler, every k-means
    step and the description, so the postings are read and joined once.
    ``sample_from="vectors"`` instead samples individual questions by a
    hash of their id, which needs the per-question vectors materialised as
    well.  ``sample_hash="md5"`` makes either sample reproducible by other
    engines.
    ``kmeans_state`` (a folder on shared storage) keeps the weighted points
    and every k-means iteration, so a rerun after a lost driver skips the
    scoring join (once the weighted table's write has committed) and the
    finished iterations; a folder of other input files or parameters is
    refused.  ``result.inputs`` holds the weighted table for
    :func:`tessera.session.release` (tables in the state folder are kept).
    """
    if sample_from not in ("weighted", "vectors"):
        raise ValueError("sample_from must be 'weighted' or 'vectors'")
    spark = postings.sparkSession
    state = kmeans_state.rstrip("/") if kmeans_state else None
    if state:
        about = {
            "input": input_fingerprint(postings), "languages": list(languages), "lang_spread": lang_spread,
            "kernels": kernels, "eta": eta, "seed": seed, "sample": [sample_hash, sample_from],
        }
        check_state(spark, f"{state}/about", about)
    if state and sample_from == "weighted" and committed(spark, f"{state}/weighted"):
        # rerun after a lost driver: the postings are not read again
        weighted = spark.read.parquet(f"{state}/weighted")
    else:
        if materialize_postings:
            # parsed text: parse every line once (the question and answer
            # filters would otherwise each re-run the parse expression)
            postings = materialize(postings, "postings")
        try:
            vectors = Q.posting_vectors(Q.scored_postings(postings), languages, lang_spread)
            if sample_from == "weighted":
                weighted = _weighted_points(vectors, state)
            else:
                # sample by question id: the per-question vectors are kept once
                vectors = materialize(vectors, "vectors")
                try:
                    weighted = _weighted_points(vectors, state)
                    init = P.sample_vectors(
                        vectors, len(languages), kernels, lang_spread, seed, sample_hash
                    )
                    centers = P.collect_centroids(init, kernels)
                finally:
                    release(vectors)
        finally:
            if materialize_postings:
                release(postings)
    if sample_from == "weighted":
        init = P.sample_vectors(weighted, len(languages), kernels, lang_spread, seed, sample_hash)
        centers = P.collect_centroids(init, kernels)
    trace_path = f"{state}/trace" if state else None
    result = M.kmeans(weighted, centers, eta, max_iterations, weighted=True, state_path=trace_path)
    result.inputs = weighted  # release it once `described` has run
    described = K.cluster_results(result.centers, weighted, languages, lang_spread, label_rule)
    return described, result


def _weighted_points(vectors: DataFrame, state: str | None) -> DataFrame:
    """Distinct weighted points, materialised - kept in the state folder
    when one is given (so a rerun can skip everything before k-means)."""
    points = M.weighted_vectors(vectors)
    if state is None:
        return materialize(points, "weighted-vectors")
    points.write.mode("overwrite").parquet(f"{state}/weighted")
    return vectors.sparkSession.read.parquet(f"{state}/weighted")


def pipeline_survey(df: DataFrame, via_decimal: bool = False) -> DataFrame:
    """Average daily hours by working status, sex and age band."""
    primary, work, other = U.classify_columns(df.columns)
    summary = U.time_usage_summary(primary, work, other, df)
    return U.time_usage_grouped(summary, via_decimal)


def pipeline_survey_arrays(names: Sequence[str], df: DataFrame, via_decimal: bool = False) -> DataFrame:
    """:func:`pipeline_survey` over an array table, for surveys of hundreds of columns."""
    return U.time_usage_grouped(U.time_usage_summary_arrays(names, df), via_decimal)
