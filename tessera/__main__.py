"""Command line: run the three end-to-end jobs on files.

    python -m tessera terms    ARTICLES [--terms T ...]
    python -m tessera clusters POSTINGS [--kernels 45 --spread 50000 --eta 20 --max-iterations 120]
    python -m tessera survey   SURVEY_CSV
    python -m tessera list
    python -m tessera query    NAME SF_DIR [--rows 20]

Inputs are raw article records, posting lines and a survey CSV; with
``--parquet`` they are parquet tables instead (``title, text``; the posting
columns; the survey columns).  Paths may be files, directories or globs,
local or on shared storage.
Only small results reach this process: rankings (one row per term), the
cluster report (one line per cluster), the survey table (12 rows).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import forum as Q
from tessera.operators.clusters import cluster_report
from tessera.operators import kmeans as M
from tessera.plans import pipelines as PL
from tessera.session import release
from tessera.sources.articles import read_articles
from tessera.sources.postings import read_postings
from tessera.sources.survey import read_survey
from tessera.sources.tables import LANGUAGES


def _session() -> SparkSession:
    return SparkSession.builder.appName("tessera").getOrCreate()


def run_terms(args: argparse.Namespace) -> None:
    spark = _session()
    if args.parquet:
        articles = spark.read.parquet(args.path).select("title", "text")
    else:
        articles = read_articles(spark, args.path)
    terms = args.terms or LANGUAGES
    for name, df in PL.rankings(articles, terms).items():
        print(f"ranking by {name}: " + ", ".join(f"{r.term}={r.n}" for r in df.collect()))
    PL.compare_strategies(articles, terms)


def run_clusters(args: argparse.Namespace) -> None:
    spark = _session()
    if args.parquet:
        postings = spark.read.parquet(args.path).select(*Q.POSTING_FIELDS)
    else:
        postings = read_postings(spark, args.path)
    described, result = PL.pipeline_clusters(
        postings, LANGUAGES, args.spread, args.kernels, args.eta, args.max_iterations,
        materialize_postings=not args.parquet, kmeans_state=args.state,
    )
    try:
        for it in sorted({t[0] for t in result.trace}):
            rows = [t for t in result.trace if t[0] == it]
            print(f"Iteration: {it}\n  * current distance: {rows[0][7]}\n  * desired distance: {args.eta}")
            for _, _, ox, oy, x, y, moved, _ in rows:
                print(f"   {str((ox, oy)):>20s} ==> {str((x, y)):>20s}    distance: {moved:8.0f}")
        if not result.converged:
            print(f"Stopped after {result.iterations} iterations without converging.")
        for r in _report_lines(described):
            print(r)
    finally:
        release(result.inputs)


def _report_lines(described: DataFrame) -> list[str]:
    return [r.line for r in cluster_report(described).collect()]


def run_survey(args: argparse.Namespace) -> None:
    spark = _session()
    if args.parquet:
        df = spark.read.parquet(args.path)
    else:
        _, df = read_survey(spark, args.path)
    PL.pipeline_survey(df).show(truncate=False)


def run_list(args: argparse.Namespace) -> None:
    from tessera.plans.catalog import ORACLE, QUERIES

    for name in QUERIES:
        print(name + ("" if name in ORACLE else "  (no SQL oracle)"))


def run_query(args: argparse.Namespace) -> None:
    from tessera.plans.catalog import QUERIES

    if args.name not in QUERIES:
        raise SystemExit(f"unknown query {args.name!r}; see `python -m tessera list`")
    QUERIES[args.name](_session(), args.sf_dir).show(args.rows, truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tessera")
    sub = ap.add_subparsers(dest="job", required=True)
    t = sub.add_parser("terms", help="rank terms by the number of articles mentioning them")
    t.add_argument("path")
    t.add_argument("--terms", nargs="*")
    t.set_defaults(fn=run_terms)
    c = sub.add_parser("clusters", help="cluster forum questions by language and best answer score")
    c.add_argument("path")
    c.add_argument("--kernels", type=int, default=Q.DEFAULT_KERNELS)
    c.add_argument("--spread", type=int, default=Q.DEFAULT_LANG_SPREAD)
    c.add_argument("--eta", type=float, default=M.DEFAULT_ETA)
    c.add_argument("--max-iterations", type=int, default=M.DEFAULT_MAX_ITERATIONS)
    c.add_argument("--state", help="folder on shared storage recording k-means progress (resume)")
    c.set_defaults(fn=run_clusters)
    s = sub.add_parser("survey", help="average daily hours by working status, sex and age band")
    s.add_argument("path")
    s.set_defaults(fn=run_survey)
    for p in (t, c, s):
        p.add_argument("--parquet", action="store_true", help="read a parquet table instead")
    ls = sub.add_parser("list", help="list the registered queries")
    ls.set_defaults(fn=run_list)
    q = sub.add_parser("query", help="run a registered query over the shared tables")
    q.add_argument("name")
    q.add_argument("sf_dir", help="folder holding <table>.parquet for every table")
    q.add_argument("--rows", type=int, default=20, help="rows to show")
    q.set_defaults(fn=run_query)
    args = ap.parse_args(argv)
    args.fn(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
