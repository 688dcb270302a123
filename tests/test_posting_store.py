"""Stored inverted index, ordered running totals, nested postings, medians by range, sketches, term filter."""

from __future__ import annotations

import glob
import random
import re
import statistics
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import clusters as K
from tessera.operators import forum as Q
from tessera.operators import ordering as O
from tessera.operators import posting_store as I
from tessera.operators import sampling as P
from tessera.operators import terms as T
from tessera.session import release
from tests.conftest import plan_text


@pytest.fixture()
def many_ranges(spark):
    """Small tables in as many ranges as the session has partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def article_rows(seed, n):
    r = random.Random(seed)
    words = ["kiwi", "fig", "plum pie", "plum", "pie", "a", "", "kiwi\n"]
    rows = [(f"t{r.randrange(n)}", " ".join(r.choice(words) for _ in range(r.randrange(6)))) for _ in range(n)]
    return [*rows, ("t1", None), rows[0], rows[0]]


def mentions(text, term):
    return text is not None and f" {term} " in f" {text} "


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(article_rows(1, 300), "title string, text string").cache()


TERMS = ["kiwi", "plum pie", "nowhere", "fig", "kiwi"]


@pytest.mark.parametrize("kind", ["list", "table"])
def test_store_holds_every_posting_in_bounded_blocks(spark, articles, tmp_dir, kind, many_ranges):
    terms = TERMS if kind == "list" else spark.createDataFrame(list(enumerate(TERMS)), "position long, term string")
    store = I.write_index(articles, f"{tmp_dir}/i", terms, block_size=7, buckets=3)
    rows = articles.collect()
    titles = {r.article_id: r.title for r in spark.read.parquet(f"{tmp_dir}/i/articles").collect()}
    assert [titles[i] for i in range(len(rows))] == sorted(r.title for r in rows)
    nested = defaultdict(dict)
    for r in store.nested().collect():
        assert r.n == len(r.ids) <= 7 and r.ids == sorted(set(r.ids)) and [r.first_id, r.last_id] == [r.ids[0], r.ids[-1]]
        nested[r.term][r.block] = r.ids
    for term in ("kiwi", "plum pie", "fig"):
        blocks = nested[term]
        ids = [i for b in range(len(blocks)) for i in blocks[b]]
        assert all(len(blocks[b]) == 7 for b in range(len(blocks) - 1)) and ids == sorted(set(ids))
        assert Counter(titles[i] for i in ids) == Counter(r.title for r in rows if mentions(r.text, term))
    assert set(nested) == {"kiwi", "plum pie", "fig"}
    ranked = [tuple(r) for r in store.rank().collect()]
    assert ranked == [tuple(r) for r in T.rank_terms_index(T.inverted_index(articles, TERMS)).collect()]


def test_store_of_every_word(spark, articles, tmp_dir):
    store = I.write_index(articles, f"{tmp_dir}/i", buckets=2)
    counts = Counter(w for r in articles.collect() if r.text is not None for w in set(r.text.split(" ")))
    assert {r.term: r.n for r in store.entries().collect()} == counts


def test_look_ups(spark, articles, tmp_dir):
    I.write_index(articles, f"{tmp_dir}/i", TERMS, block_size=5)
    store = I.open_index(spark, f"{tmp_dir}/i")
    rows = articles.collect()
    found = Counter((r.term, r.title) for r in store.lookup(["kiwi", "fig", "fig", "none"]).collect())
    assert found == Counter((t, r.title) for t in ("kiwi", "fig") for r in rows if mentions(r.text, t))
    both = Counter(r.title for r in store.mention_all(["kiwi", "plum pie"]).collect())
    assert both == Counter(r.title for r in rows if mentions(r.text, "kiwi") and mentions(r.text, "plum pie"))
    assert store.mention_all(["kiwi", "none"]).count() == 0
    ids = sorted(r.article_id for r in store.postings(["kiwi"]).collect())
    some = sorted(r.article_id for r in store.postings(["kiwi"], 50, 120).collect())
    assert some == [i for i in ids if 50 <= i <= 120]


def test_look_ups_open_only_their_folders_and_blocks(spark, articles, tmp_dir):
    store = I.write_index(articles, f"{tmp_dir}/i", TERMS, buckets=8)
    plan = plan_text(store.postings(["kiwi"], 50, 120))
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d\)\]", plan)
    assert "EqualTo(term,kiwi)" in plan and "/articles" not in plan
    found = {f.rsplit("/", 2)[1] for f in store._of("blocks", ["kiwi"]).inputFiles()}
    assert len(found) >= 1
    f = glob.glob(f"{tmp_dir}/i/blocks/bucket=*/*.parquet")[0]
    group = pq.ParquetFile(f).metadata.row_group(0)
    encodings = {group.column(i).path_in_schema: group.column(i).encodings for i in range(group.num_columns)}
    assert encodings["ids.list.element"] == ("DELTA_BINARY_PACKED",)


def test_store_is_complete_or_refused(spark, articles, tmp_dir):
    with pytest.raises(ValueError, match="no complete index"):
        I.open_index(spark, f"{tmp_dir}/i")
    I.write_index(articles, f"{tmp_dir}/i", ["fig"])
    with pytest.raises(ValueError, match="there is an index"):
        I.write_index(articles, f"{tmp_dir}/i", ["fig"])


def test_store_of_nothing(spark, articles, tmp_dir):
    for i, (df, terms) in enumerate([(articles.limit(0), TERMS), (articles, ["nowhere"])]):
        store = I.write_index(df, f"{tmp_dir}/{i}", terms)
        assert store.rank().collect() == [] and store.lookup(["nowhere"]).collect() == []


# --------------------------------------------------------------- totals ----


def test_running_totals_of_a_hot_group(spark, many_ranges):
    r = random.Random(3)
    rows = [("hot", i, r.randrange(4)) for i in range(900)] + [(f"g{i % 50}", i, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i int, w long").repartition(7)
    parts = O.ranged(df, ["g"], ["i"])
    assert parts.where("g = 'hot'").select("_part").distinct().count() > 2  # one group, many tasks
    found = O.running_totals(parts, ["g"], ["i"], F.col("w"))
    before, expected = Counter(), {}
    for g, i, w in sorted(rows):
        expected[g, i] = before[g]
        before[g] += w
    assert {(x.g, x.i): x.before for x in found.collect()} == expected
    release(parts)


# --------------------------------------------------------------- nested ----


def test_nested_postings(spark, many_ranges):
    r = random.Random(4)
    q = [(1, i, None, None, i % 3, "t") for i in range(30)] + [(1, 5, None, None, 7, "twice")] * 3
    a = [(2, 1000 + i, None, 7, i % 5, None) for i in range(400)]  # one question with most answers
    a += [(2, 2000 + i, r.choice((None, 1)), r.randrange(40), -1, None) for i in range(200)]
    a += [(2, 9999, None, 8, 1, "same")] * 250  # copies of one answer
    p = spark.createDataFrame([*q, *a], "posting_type int, id long, accepted_answer long, parent_id long, score int, tag string")
    nested = Q.nested_postings(p.repartition(6), 32)
    rows = nested.collect()
    pairs = Counter()
    for x in Q.question_answer_pairs(p).collect():
        pairs[tuple(x)] += 1
    found, by_id = Counter(), defaultdict(dict)
    for x in rows:
        assert x.n == len(x.pairs) <= 32
        by_id[x.id][x.segment] = x.pairs
        for one in x.pairs:
            found[tuple(one.question) + tuple(one.answer)] += 1
    assert found == pairs
    for segments in by_id.values():
        assert sorted(segments) == list(range(len(segments)))
        assert all(len(segments[s]) == 32 for s in range(len(segments) - 1))
        flat = [tuple(one.question) + tuple(one.answer) for s in range(len(segments)) for one in segments[s]]
        assert flat == sorted(flat, key=lambda t: [(v is not None, v) for v in t])
    release(nested)


def test_nested_postings_of_nothing(spark):
    p = spark.createDataFrame([], "posting_type int, id long, accepted_answer long, parent_id long, score int, tag string")
    assert Q.nested_postings(p).collect() == []


# -------------------------------------------------------------- medians ----


@pytest.mark.parametrize("seed", range(3))
def test_medians_by_range(spark, seed, many_ranges):
    r = random.Random(seed)
    members = {c: [r.randrange(10**6) for _ in range(n)] for c, n in enumerate((1, 2, 3, 1000, 1001, 40))}
    members[6] = [1, 1, 1, 9, 9, 9]
    rows = [(c, y, n) for c, ys in members.items() for y, n in Counter(ys).items()]
    per_y = spark.createDataFrame(rows, "cluster int, y long, cnt long").repartition(5)
    expected = {c: statistics.median(ys) for c, ys in members.items()}
    assert {x.cluster: x.med for x in K.medians_by_range(per_y).collect()} == expected
    assert {x.cluster: x.med for x in K._medians_sorted(per_y).collect()} == expected


def test_cluster_results_by_range(spark, monkeypatch, many_ranges):
    v = spark.createDataFrame([(i % 3 * 50_000, i * i % 97, 1 + i % 4) for i in range(200)], "x long, y long, n long")
    centers = [(0, 10), (0, 60), (50_000, 30), (100_000, 5)]
    expected = K.cluster_results(centers, v, ["a", "b", "c"]).collect()
    raw = v.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("x", "y")
    monkeypatch.setattr(K, "SORTED_SCORES", 3)
    assert K.cluster_results(centers, v, ["a", "b", "c"]).collect() == expected
    assert K.cluster_results(centers, raw, ["a", "b", "c"]).collect() == expected


# -------------------------------------------------------------- sketches ----


@pytest.mark.parametrize("hashing", P.HASHES)
def test_merged_sketches_are_the_sample_of_all(spark, hashing):
    df = spark.createDataFrame([(i, None if i % 7 == 6 else i % 7, f"v{i}") for i in range(500)], "id long, g long, v string")
    a, b, c = (df.where(f"id % 10 IN ({d})") for d in ("0", "1, 2, 3, 4, 5", "6, 7, 8, 9"))
    sketches = [P.group_sketch(x, "g", 20, hashing=hashing) for x in (a, b, c)]
    left = P.merge_sketches(P.merge_sketches(sketches[0], sketches[1], "g", 20), sketches[2], "g", 20)
    right = P.merge_sketches(sketches[2], P.merge_sketches(sketches[1], sketches[0], "g", 20), "g", 20)
    for k in (20, 5):
        expected = sorted(map(str, P.sample_per_group(df, "g", k, hashing=hashing).collect()))
        assert sorted(map(str, P.sketch_sample(left, "g", k).collect())) == expected
        assert sorted(map(str, P.sketch_sample(right, "g", k).collect())) == expected


def test_sketch_store(spark, tmp_dir):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "id long, g long")
    df.where("id < 60").write.parquet(f"{tmp_dir}/first")
    store = P.SketchStore(spark, f"{tmp_dir}/s", "g", 8)
    with pytest.raises(ValueError, match="no batch"):
        store.sample()
    store.add(spark.read.parquet(f"{tmp_dir}/first"), "first")
    again = P.SketchStore(spark, f"{tmp_dir}/s", "g", 8)  # reopened by a later run
    second = df.where("id >= 60")
    again.add(second, "second")
    again.add(second, "second")  # a repeated run
    assert again.batches() == ["first", "second"]
    assert sorted(again.sample().collect()) == sorted(P.sample_per_group(df, "g", 8).collect())
    assert sorted(again.sample(3).collect()) == sorted(P.sample_per_group(df, "g", 3).collect())
    assert not any("/first" in f for f in again.sample().inputFiles())
    with pytest.raises(ValueError, match="keeps 8"):
        again.sample(9)
    with pytest.raises(ValueError, match="other input or parameters"):
        P.SketchStore(spark, f"{tmp_dir}/s", "g", 9)


# ---------------------------------------------------------------- filter ----


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("term"))
    other = spark.range(5000, 25000).select(F.concat(F.lit("w"), "id").alias("term"))
    screen = T.bloom_filter(listed, 5000)
    assert listed.where(T.maybe_listed(F.col("term"), screen)).count() == 5000
    assert other.where(T.maybe_listed(F.col("term"), screen)).count() < 600  # 3 %
    full = T.bloom_filter(listed, 5000, most_bits=64)  # too small: lets everything through, loses nothing
    assert listed.where(T.maybe_listed(F.col("term"), full)).count() == 5000


def test_large_term_tables_are_screened_in_the_scan(spark, articles):
    table = spark.createDataFrame([(i, t) for i, t in enumerate([*TERMS, "kiwi fig", ""])], "position long, term string")
    hits = T.term_hits(articles, table, broadcast_rows=0)
    expected = T.term_hits(articles, table)
    assert Counter(map(tuple, hits.collect())) == Counter(map(tuple, expected.collect()))
    plan = plan_text(hits)
    assert "getbit" in plan and "Subquery" in plan
    # what is shuffled to the table: the runs that pass the filter
    runs = T._grams(articles, table, "text")
    kept = runs.where(T.maybe_listed(F.col("term"), T.bloom_filter(table, table.count()))).count()
    assert expected.select("title", "term").count() * 0.5 < kept < runs.count() * 0.6
    words = T.term_hits(articles, table.limit(0), broadcast_rows=0)
    assert words.collect() == []
