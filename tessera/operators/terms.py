"""Rank terms by the number of articles that mention them.

Articles are rows ``(title, text)``; a term list is a Python list (order
matters: it breaks ties) or, for long lists, a DataFrame ``(term[,
position])``.  Three ranking strategies give the reference's three answers:

* :func:`rank_terms_scan`  - every list entry, zero counts kept, repeated
  entries repeated.  One pass for all terms (not one scan per term).
* :func:`rank_terms_index` - sizes of the entries of an inverted index; no
  zero-count terms; a term listed twice counts every article twice.
* :func:`rank_terms_count` - (term, 1) pairs summed by key with map-side
  combine; same answer as the index strategy.

Every ranking is ordered by count descending, then by first list position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import (
    BLANK,
    literal_map,
    matched_terms,
    mentions_term,
    shingles,
    tokens,
    with_tokens,
)
from tessera.session import materialize, owning

# Longest term list inlined into the plan as literals; longer lists, and
# term DataFrames, use a token equi-join instead.
INLINE_TERMS_LIMIT = 512
# A term table within both limits is broadcast and met in the scan.  A larger
# one is shuffled on the term; rankings count the tokens first, so a frequent
# token is one row per task by then.
BROADCAST_TERMS_LIMIT = 1_000_000
BROADCAST_TERMS_BYTES = 64 * 1024 * 1024
# For tables too large to broadcast: the entries of a term come in lists of about
# ENTRY_BLOCK, and a term listed more often than SHARE_ENTRIES has its mentions dealt
# into a share per so many entries, at most MOST_SHARES.  A task of the join takes
# about TASK_CELLS pairs of list and share.
ENTRY_BLOCK = 512
SHARE_ENTRIES = 128
MOST_SHARES = 64
TASK_CELLS = 32
MOST_TASKS = 10_000
# Most bits of the filter that screens the runs for a larger table (16 MB).
SCREEN_BITS = 1 << 27

TermsArg = Sequence[str] | DataFrame


def _is_inline(terms: TermsArg) -> bool:
    return not isinstance(terms, DataFrame) and len(terms) <= INLINE_TERMS_LIMIT


def term_frame(spark: SparkSession, terms: TermsArg) -> DataFrame:
    """Term list as a DataFrame ``(position, term)``."""
    if isinstance(terms, DataFrame):
        if "position" in terms.columns:
            return terms.select(F.col("position").cast("long"), F.col("term"))
        # without a given order, equal counts are ordered by the term itself
        return terms.select(F.lit(0).cast("long").alias("position"), F.col("term"))
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(terms)], "position int, term string"
    )


def _first_positions(terms: Sequence[str]) -> dict[str, int]:
    first: dict[str, int] = {}
    for i, t in enumerate(terms):
        first.setdefault(t, i)
    return first


def _multiplicity(terms: Sequence[str]) -> dict[str, int]:
    mult: dict[str, int] = {}
    for t in terms:
        mult[t] = mult.get(t, 0) + 1
    return mult


def _broadcast_checked(tf: DataFrame, most_rows: int | None = None) -> DataFrame:
    """Broadcast a term table only after measuring it (rows and text bytes)."""
    most_rows = BROADCAST_TERMS_LIMIT if most_rows is None else most_rows
    stats = tf.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes"),
    ).first()
    rows, nbytes = stats["rows"], stats["bytes"]
    # ~ 32 bytes of row and hash-table overhead per entry on top of the text
    if rows <= most_rows and nbytes + 32 * rows <= BROADCAST_TERMS_BYTES:
        return F.broadcast(tf)
    return tf


def term_hits(
    articles: DataFrame,
    terms: TermsArg,
    key: str = "title",
    text: str = "text",
    keep: Sequence[str] = (),
    broadcast_rows: int | None = None,
) -> DataFrame:
    """One row per (article, list entry) mention: ``key, term, position``.

    ``keep`` names further article columns to carry along.  A term table of more
    than ``broadcast_rows`` (``BROADCAST_TERMS_LIMIT``) is shuffled; a filter of its
    terms then screens the articles' word runs in the scan.  What meets in that
    join is a share of a term's mentions and a list of about ``ENTRY_BLOCK`` of its
    entries, so a term that many entries list and many articles mention is spread
    over the tasks.  The number of tasks follows from the lists and shares, not from
    the bytes shuffled, which tell nothing of the rows made.  The result then reads
    a stored copy of the term table: release it after use.
    """
    carried = [key, *keep]
    if _is_inline(terms):
        terms = list(terms)
        exploded = articles.select(
            *carried, F.explode(matched_terms(text, terms)).alias("term")
        )
        positions = {}
        for i, t in enumerate(terms):
            positions.setdefault(t, []).append(i)
        if all(len(p) == 1 for p in positions.values()):
            pos = F.element_at(
                literal_map([(t, p[0]) for t, p in positions.items()]), F.col("term")
            )
        else:
            pos = F.explode(
                F.element_at(
                    literal_map(
                        [(t, F.array(*[F.lit(x) for x in p])) for t, p in positions.items()]
                    ),
                    F.col("term"),
                )
            )
        return exploded.select(key, "term", pos.alias("position"), *keep)

    tf = term_frame(articles.sparkSession, terms)
    right = _broadcast_checked(tf, broadcast_rows)
    if right is tf:  # shuffled on the term: screen the runs in the scan first
        tf = materialize(tf, "terms")  # read several times
        blocks, several, tasks = _entry_blocks(tf)
        mentions = _mentions(articles, tf, key, text, keep)
        # terms of several lists or shares are few: at most the entries by SHARE_ENTRIES
        met = mentions.join(F.broadcast(several), "term", "left").select(
            *dict.fromkeys(carried),
            "term",
            F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)).alias("_block"),
            F.pmod("_doc", F.coalesce("_shares", F.lit(1))).cast("int").alias("_share"),
        )
        cell = ["term", "_block", "_share"]
        met = met.repartition(tasks, *cell).join(blocks.repartition(tasks, *cell), cell)
        return owning(met.select(key, "term", F.explode("_positions").alias("position"), *keep), tf)
    return _grams(articles, tf, text, carried).join(right, "term").select(key, "term", "position", *keep)


def _mentions(articles: DataFrame, tf: DataFrame, key: str, text: str, keep: Sequence[str]) -> DataFrame:
    """The word runs of each article that pass a filter of the table's terms, each once: ``key, *keep, term, _doc``.

    A run is cut from the article's words where they are unfolded, in one generated
    method, so only those that pass are held; they are made distinct afterwards.
    ``_doc`` is a hash of the article, by which its runs are shuffled.
    """
    listed = tf.where(F.col("term").isNotNull())
    widths = _widths(listed) or [1]  # an empty filter lets nothing through
    screen = bloom_filter(listed, listed.count())
    carried = [F.col(c) for c in dict.fromkeys([key, *keep])]
    docs = articles.where(F.col(text).isNotNull()).select(
        *carried,
        F.monotonically_increasing_id().alias("_row"),  # articles may be equal
        F.xxhash64(F.col(key).cast("string"), text).alias("_doc"),
        tokens(text).alias("_words"),
    )
    runs = docs.select("*", F.explode(F.sequence(F.lit(1), F.size("_words"))).alias("_at"))
    runs = runs.select("*", F.explode(F.array(*map(F.lit, widths))).alias("_width"))
    runs = runs.where(F.col("_at") + F.col("_width") - 1 <= F.size("_words"))
    # behind a generator the run is made once, not in every test that reads it
    run = F.array_join(F.slice("_words", F.col("_at"), F.col("_width")), BLANK)
    runs = runs.select("*", F.explode(F.array(run)).alias("term")).where(maybe_listed(F.col("term"), screen))
    runs = runs.select(*carried, "_row", "_doc", "term")
    return runs.repartition("_doc").dropDuplicates(["_doc", "_row", "term"]).drop("_row")


def _entry_blocks(tf: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The entries of a term table as lists: ``term, _block, _share, _positions``, and
    ``term, _blocks, _shares`` where a term has several, and the tasks to join them in.

    Equal entries are counted with map-side combine and come in pieces of at most
    ``ENTRY_BLOCK``; a hash of the piece gives its list.  Every share of a term's
    mentions gets all its lists.  Terms that are null match nothing.
    """
    listed = tf.where(F.col("term").isNotNull())
    several = listed.groupBy("term").agg(F.count("*").alias("_n"))
    several = several.where(F.col("_n") > min(SHARE_ENTRIES, ENTRY_BLOCK)).select(
        "term",
        F.ceil(F.col("_n") / ENTRY_BLOCK).cast("int").alias("_blocks"),
        F.least(F.ceil(F.col("_n") / SHARE_ENTRIES), F.lit(MOST_SHARES)).cast("int").alias("_shares"),
    )
    cells = several.agg(F.sum(F.col("_blocks").cast("long") * F.col("_shares")).alias("n")).first()["n"] or 0
    asked = int(tf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(asked, min(-(-cells // TASK_CELLS), MOST_TASKS))
    copies = listed.groupBy("term", "position").agg(F.count("*").alias("_copies"))
    last = F.expr(f"(_copies - 1) div {ENTRY_BLOCK}")
    pieces = copies.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_piece"))
    times = F.least(F.col("_copies") - F.col("_piece") * ENTRY_BLOCK, F.lit(ENTRY_BLOCK)).cast("int")
    placed = pieces.join(F.broadcast(several), "term", "left").select(
        "term",
        F.pmod(F.xxhash64("position", "_piece"), F.coalesce("_blocks", F.lit(1))).cast("int").alias("_block"),
        F.coalesce("_shares", F.lit(1)).alias("_shares"),
        F.struct("position", times.alias("times")).alias("_entry"),
    )
    held = F.transform(F.collect_list("_entry"), lambda e: F.array_repeat(e.position, e.times))
    lists = placed.groupBy("term", "_block", "_shares").agg(F.flatten(held).alias("_positions"))
    share = F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)).alias("_share")
    return lists.select("term", "_block", share, "_positions"), several, tasks


def _widths(tf: DataFrame) -> list[int]:
    """The numbers of words of the table's terms."""
    return sorted(r[0] for r in tf.select(F.size(tokens("term")).alias("w")).distinct().collect())


def word_runs(tf: DataFrame, text: str) -> Column:
    """Distinct runs of words of a text, as long as some term of the table (array)."""
    widths = _widths(tf)
    if not widths:
        return F.array().cast("array<string>")

    def runs(toks: Column) -> Column:
        grams = [shingles(toks, w) for w in widths]
        return F.array_distinct(grams[0] if len(grams) == 1 else F.concat(*grams))

    return with_tokens(text, widths, runs)


def _bit_places(term: Column, bits: int) -> list[Column]:
    """The bits of a filter of ``bits`` (a power of two) that a term sets: two from each of two hashes."""
    hashes = [F.xxhash64(term), F.xxhash64(term, F.lit(1))]
    return [F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(bits - 1)) for h in hashes for shift in (0, 32)]


def bloom_filter(
    listed: DataFrame, rows: int, bits_per_term: int = 12, most_bits: int = SCREEN_BITS
) -> tuple[Column, int]:
    """A filter of the terms as one array of 64-bit words, and its bits, to be read by :func:`maybe_listed`.

    Built by aggregation: each term sets its bits, words are or-ed with map-side
    combine, and the words are put in order.  The array has at most ``most_bits``
    however many terms there are (a fuller filter lets more through).  It reaches
    the plan as a scalar subquery, computed once.
    """
    bits = 1 << min(max(rows * bits_per_term, 64).bit_length(), most_bits.bit_length() - 1)
    bit = listed.select(F.explode(F.array(*_bit_places(F.col("term"), bits))).alias("bit"))
    one = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    zero = listed.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
    words = bit.select(F.shiftright("bit", 6).alias("word"), one.alias("set")).unionByName(zero)
    words = words.groupBy("word").agg(F.bit_or("set").alias("set"))
    array = F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda w: w.set)
    return words.agg(array.alias("filter")).scalar(), bits


def maybe_listed(term: Column, screen: tuple[Column, int]) -> Column:
    """False only for terms that are not in the filter's list."""
    words, bits = screen
    found = F.lit(True)
    for place in _bit_places(term, bits):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return found


def listed_only(grams: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of ``grams`` whose term the table lists (each term once).

    A table measured as small is broadcast.  Above that a filter of the terms is
    applied in the scan, so that only listed runs and a few false positives are
    shuffled to the table, which decides.
    """
    small = _broadcast_checked(listed)
    if small is listed:
        grams = grams.where(maybe_listed(F.col("term"), bloom_filter(listed, listed.count())))
    return grams.join(small, "term", "left_semi")


def _grams(articles: DataFrame, tf: DataFrame, text: str, carried: Sequence[str] = ()) -> DataFrame:
    """Each distinct run of words, as long as some term of the table, of each article."""
    return articles.select(*carried, F.explode(word_runs(tf, text)).alias("term"))


def _table_counts(articles: DataFrame, tf: DataFrame, text: str) -> DataFrame:
    """Articles per word run that the term table lists: ``term, n``.

    Counted before the table is joined: what enters that join is at most one
    row per listed word run and task, so no token is too frequent for one task.
    A table small enough to broadcast screens the runs in the scan; for a larger
    one its filter does.
    """
    grams, listed = _grams(articles, tf, text), tf.select("term").distinct()
    screened = _broadcast_checked(listed)
    if screened is not listed:
        grams = grams.join(screened, "term", "left_semi")
    else:
        grams = grams.where(maybe_listed(F.col("term"), bloom_filter(listed, listed.count())))
    return grams.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def term_doc_count(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """Number of articles mentioning ``term`` (0 if none): one row ``term, n``."""
    return articles.agg(F.count_if(mentions_term(text, term)).alias("n")).select(
        F.lit(term).alias("term"), F.col("n")
    )


def _distinct_term_counts(articles: DataFrame, terms: Sequence[str], text: str) -> DataFrame:
    """Articles per distinct listed term (mentioned terms only): ``term, n``.

    One split per article, an explode of at most one row per distinct
    term, and a partial aggregate: each task shuffles at most one row per
    distinct term.
    """
    return (
        articles.select(F.explode(matched_terms(text, terms)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def rank_terms_scan(
    articles: DataFrame, terms: TermsArg, key: str = "title", text: str = "text"
) -> DataFrame:
    """Every list entry with its article count, zero counts kept.

    Output ``term, position, n`` ordered by ``n`` desc, ``position``.  One
    pass counts the distinct terms; the counts (at most one per listed
    term) are folded into a single map row and the list is unfolded from
    it - no join.  Term tables join their counts instead.
    """
    if _is_inline(terms) and len(terms) == 0:
        empty = term_frame(articles.sparkSession, [])
        return empty.select("term", "position", F.lit(0).cast("long").alias("n"))
    if _is_inline(terms):
        terms = list(terms)
        counts = _distinct_term_counts(articles, terms, text)
        # one row holding a term -> count map; at most one entry per listed
        # term, so the gathered group is bounded by the (inlined) list
        found = counts.agg(F.map_from_entries(F.collect_list(F.struct("term", "n"))).alias("m"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(t).alias("term"),
                    F.lit(p).alias("position"),
                    F.coalesce(F.element_at(F.col("m"), F.lit(t)), F.lit(0).cast("long")).alias("n"),
                )
                for p, t in enumerate(terms)
            ]
        )
        return found.select(F.inline(rows)).orderBy(F.desc("n"), "position")
    tf = term_frame(articles.sparkSession, terms)
    joined = tf.join(_table_counts(articles, tf, text), "term", "left")
    return joined.select(
        "term", "position", F.coalesce("n", F.lit(0)).alias("n")
    ).orderBy(F.desc("n"), "position", "term")


def inverted_index(
    articles: DataFrame,
    terms: TermsArg,
    key: str = "title",
    text: str = "text",
    with_text: bool = False,
    by_size: bool = False,
) -> DataFrame:
    """Flat inverted index: one row per (term entry, article) ``term, position, key``.

    Terms mentioned nowhere have no rows.  ``with_text`` carries the article
    text along (memory heavy; off by default).  ``by_size`` adds the
    entry size ``n``, by which the reference orders its entries; the postings
    themselves are not sorted (order the result by ``n`` and ``position`` if
    that is wanted).
    The nested one-row-per-term form is deliberately not offered: a
    frequent term would collect most of the corpus into a single row.
    """
    hits = term_hits(articles, terms, key, text, keep=[text] if with_text else [])
    out = hits.select("term", "position", key, *([text] if with_text else []))
    if not by_size:
        return out
    # One shuffle boundary, hashed on (term, key) so a frequent term is
    # spread over many tasks: the entry sizes and the postings read its output
    # (one reused exchange) instead of re-scanning and re-splitting the text.
    staged = out.repartition("term", key)
    # count a column of every row (never null) so both branches keep the same
    # columns below the exchange and Spark reuses it
    sizes = staged.groupBy("term").agg(F.count("position").alias("n"))
    if _is_inline(terms):
        sizes = F.broadcast(sizes)  # at most one row per listed term
    return staged.join(sizes, "term")


def rank_terms_index(index: DataFrame) -> DataFrame:
    """Entry sizes of an inverted index: ``term, n`` ordered by size desc."""
    return (
        index.groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("_first"))
        .orderBy(F.desc("n"), "_first", "term")
        .select("term", "n")
    )


def rank_terms_count(
    articles: DataFrame,
    terms: TermsArg,
    key: str = "title",
    text: str = "text",
    include_zero: bool = False,
) -> DataFrame:
    """(term, 1) pairs summed per term: ``term, n`` ordered by n desc.

    Terms mentioned nowhere are absent unless ``include_zero`` (then they
    follow with ``n = 0``); a term listed twice counts twice.  The shuffle
    carries at most one partial count per distinct term per task.
    """
    if _is_inline(terms):
        terms = list(terms)
        first = _first_positions(terms)
        mult = _multiplicity(terms)
        counts = _distinct_term_counts(articles, terms, text)
        if include_zero:
            listed = articles.sparkSession.createDataFrame([(t,) for t in first], "term string")
            counts = listed.join(F.broadcast(counts), "term", "left").select(
                "term", F.coalesce("n", F.lit(0)).alias("n")
            )
        n = F.col("n")
        if any(m > 1 for m in mult.values()):
            n = n * F.element_at(literal_map(list(mult.items())), F.col("term"))
        return (
            counts.select(
                "term",
                n.alias("n"),
                F.element_at(literal_map(list(first.items())), F.col("term")).alias("_first"),
            )
            .orderBy(F.desc("n"), "_first")
            .select("term", "n")
        )
    tf = term_frame(articles.sparkSession, terms)
    listed = tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("_times"), F.min("position").alias("_first")
    )
    counts = _table_counts(articles, tf, text)
    return (
        listed.join(counts, "term", "left" if include_zero else "inner")
        .select("term", (F.coalesce("n", F.lit(0)) * F.col("_times")).alias("n"), "_first")
        .orderBy(F.desc("n"), "_first", "term")
        .select("term", "n")
    )
