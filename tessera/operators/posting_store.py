"""A stored inverted index: term entries in bounded blocks of sorted, delta-coded article ids.

Written once from the articles; ranked, looked up and intersected afterwards
without reading a text.  Below the store's folder:

* ``articles``  article_id, title - ids number the articles in title order;
* ``entries``   term, position, times, n, n_blocks - one row per mentioned term;
* ``blocks``    term, block, n, first_id, last_id, ids - at most ``block_size`` ids per
  row, ascending; Parquet's delta encoding keeps each as its packed distance from
  the one before;
* ``about``     the parameters, written last: a store without it is incomplete.

Entries and blocks lie in folders by a hash of the term, and sorted by (term,
block) within, so a look-up opens the folders of its terms and skips row groups
by term and id.  A frequent term has many blocks in many files; no entry is ever
in one row or one task.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.text import matched_terms, tokens
from tessera.operators import terms as T
from tessera.operators.ordering import ranged, running_totals
from tessera.session import committed, materialize, release

DEFAULT_BLOCK_SIZE = 16_384
DEFAULT_BUCKETS = 64
_SCHEMAS = {  # partitioned tables without rows have no file that would tell
    "blocks": "term string, block long, n long, first_id long, last_id long, ids array<long>, bucket int",
    "entries": "term string, position long, times long, n long, n_blocks long, bucket int",
}
#: Writer options: sorted numbers are kept as packed differences instead of through a dictionary.
DELTA_CODED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false"}


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _numbered(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """article_id per row of a staged table (row, title): its place by title, copies by row; and the table to release."""
    parts = ranged(articles, [], ["title", "row"], "titles")
    starts, total = {}, 0
    for part, n in sorted(parts.groupBy("_part").count().collect()):  # one row per range
        starts[part], total = total, total + n
    start = articles.sparkSession.createDataFrame(list(starts.items()), "_part int, _before long")
    joined = parts.join(F.broadcast(start), "_part")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("title", "row"))
    return joined.select("row", "title", (F.col("_before") + place - 1).alias("article_id")), parts


def write_index(
    articles: DataFrame,
    path: str,
    terms: T.TermsArg | None = None,
    key: str = "title",
    text: str = "text",
    block_size: int = DEFAULT_BLOCK_SIZE,
    buckets: int = DEFAULT_BUCKETS,
) -> PostingStore:
    """Write the index of ``articles`` for ``terms`` (None: for every blank-delimited word) and open it.

    Articles with the same title are articles of their own.  A term listed
    several times is stored once and counts as often in the ranking.  The
    texts are read once; what is shuffled is titles and (term, id) postings.
    An existing complete store is refused.
    """
    spark = articles.sparkSession
    path = path.rstrip("/")
    if committed(spark, f"{path}/about"):
        raise ValueError(f"there is an index at {path}")
    if terms is None:
        found = F.array_distinct(tokens(text))
    elif T._is_inline(terms):
        found = matched_terms(text, terms)
    else:
        listed = T.term_frame(spark, terms)
        found = T.word_runs(listed, text)
    staged = materialize(
        articles.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("title"), found.alias("terms")),
        "staged-articles",
    )
    numbered, parts = _numbered(staged.select("row", "title"))
    numbered = materialize(numbered, "article-ids")
    release(parts)
    numbered.select("article_id", "title").repartitionByRange("article_id").sortWithinPartitions("article_id").write.mode(
        "overwrite"
    ).parquet(f"{path}/articles")
    hits = staged.join(numbered, "row").select(F.explode("terms").alias("term"), "article_id")
    if terms is not None and not T._is_inline(terms):
        hits = T.listed_only(hits, listed)
    by_term = ranged(hits, ["term"], ["article_id"], "postings")
    placed = running_totals(by_term, ["term"], ["article_id"], F.lit(1).cast("long"), "place")
    ids = F.sort_array(F.collect_list("article_id"))
    blocks = placed.groupBy("term", F.expr(f"place div {int(block_size)}").alias("block")).agg(ids.alias("ids"))
    blocks = blocks.select(
        _bucket(F.col("term"), buckets).alias("bucket"),
        "term",
        "block",
        F.size("ids").cast("long").alias("n"),
        F.element_at("ids", 1).alias("first_id"),
        F.element_at("ids", -1).alias("last_id"),
        "ids",
    )
    sorted_blocks = blocks.repartitionByRange("bucket", "term", "block").sortWithinPartitions("bucket", "term", "block")
    delta_coded = sorted_blocks.write.mode("overwrite").partitionBy("bucket").options(**DELTA_CODED)
    delta_coded.parquet(f"{path}/blocks")
    for table in (by_term, numbered, staged):
        release(table)

    written = spark.read.schema(_SCHEMAS["blocks"]).parquet(f"{path}/blocks")
    entries = written.groupBy("bucket", "term").agg(F.sum("n").alias("n"), F.count("*").alias("n_blocks"))
    if terms is None:
        entries = entries.withColumns({"position": F.lit(0).cast("long"), "times": F.lit(1).cast("long")})
    else:
        order = T.term_frame(spark, terms).groupBy("term").agg(
            F.min("position").cast("long").alias("position"), F.count("*").alias("times")
        )
        entries = entries.join(order, "term")
    entries.select("bucket", "term", "position", "times", "n", "n_blocks").repartitionByRange(
        "bucket", "term"
    ).sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/entries")
    about = json.dumps({"buckets": buckets, "block_size": block_size})
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> PostingStore:
    """The store at ``path``; a folder without a complete one raises ``ValueError``."""
    path = path.rstrip("/")
    if not committed(spark, f"{path}/about"):
        raise ValueError(f"no complete index at {path}")
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    return PostingStore(spark, path, about["buckets"])


class PostingStore:
    """Reads a stored index.  Every method returns a DataFrame; none reads an article's text."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _of(self, table: str, terms: Sequence[str] | None) -> DataFrame:
        df = self.spark.read.schema(_SCHEMAS[table]).parquet(f"{self.path}/{table}")
        if terms is None:
            return df.drop("bucket")
        listed = list(dict.fromkeys(terms))
        # constants: folders and row groups are pruned by them
        folders = self.spark.createDataFrame([(t,) for t in listed], "term string").select(
            _bucket(F.col("term"), self.buckets).alias("b")
        )
        numbers = sorted({r.b for r in folders.collect()})
        return df.where(F.col("bucket").isin(numbers) & F.col("term").isin(listed)).drop("bucket")

    def entries(self, terms: Sequence[str] | None = None) -> DataFrame:
        """``term, position, times, n, n_blocks`` of the mentioned terms."""
        return self._of("entries", terms)

    def nested(self, terms: Sequence[str] | None = None) -> DataFrame:
        """The entries as lists: ``term, block, n, first_id, last_id, ids``, at most a block's ids per row."""
        return self._of("blocks", terms).select("term", "block", "n", "first_id", "last_id", "ids")

    def postings(
        self, terms: Sequence[str] | None = None, low: int | None = None, high: int | None = None
    ) -> DataFrame:
        """``term, article_id``, flat; with ``low`` and ``high`` only ids in that range (blocks beyond are skipped)."""
        blocks = self._of("blocks", terms)
        if low is not None:
            blocks = blocks.where(F.col("last_id") >= low)
        if high is not None:
            blocks = blocks.where(F.col("first_id") <= high)
        out = blocks.select("term", F.explode("ids").alias("article_id"))
        if low is not None:
            out = out.where(F.col("article_id") >= low)
        return out if high is None else out.where(F.col("article_id") <= high)

    def lookup(self, terms: Sequence[str]) -> DataFrame:
        """``term, article_id, title`` of every article that mentions a term."""
        return self.postings(terms).join(self.spark.read.parquet(f"{self.path}/articles"), "article_id").select(
            "term", "article_id", "title"
        )

    def mention_all(self, terms: Sequence[str]) -> DataFrame:
        """``article_id, title`` of the articles that mention every term.

        Only blocks within the ids that all terms have are read.
        """
        listed = list(dict.fromkeys(terms))
        spans = self._of("blocks", listed).groupBy("term").agg(F.min("first_id").alias("a"), F.max("last_id").alias("b"))
        row = spans.agg(F.count("*"), F.max("a"), F.min("b")).first()
        articles = self.spark.read.parquet(f"{self.path}/articles")
        if row[0] < len(listed):  # some term is mentioned nowhere
            return articles.limit(0)
        ids = self.postings(listed, row[1], row[2]).groupBy("article_id").agg(F.count("*").alias("_n"))
        both = articles.where(F.col("article_id").between(row[1], row[2]))
        return both.join(ids.where(F.col("_n") == len(listed)), "article_id").select("article_id", "title")

    def rank(self) -> DataFrame:
        """``term, n`` ordered by size, as :func:`tessera.operators.terms.rank_terms_index`; reads the entries alone."""
        ranked = self.entries().select("term", (F.col("n") * F.col("times")).alias("n"), "position")
        return ranked.orderBy(F.desc("n"), "position", "term").select("term", "n")
