"""Exact dedup, line dedup and the n-gram Jaccard join against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import BinaryFuse, exact_dedup
from tessera.llm.line_dedup import LineRuns, _ranges, _unseen, dedup_lines, line_keys
from tessera.llm.near_dup import Bands, components, keep_one_of_each, near_duplicates, set_tokens
from tests.llm import helpers as H

WS = "\x20\t\n\x0b\x0c\r"


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


# ------------------------------------------------------------ exact dedup ----


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 500, 20_000])
def test_binary_fuse_has_no_false_negatives(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    f = BinaryFuse.build(keys)
    assert f.contains(keys).all()
    others = np.random.default_rng(n + 1).integers(0, 2**63, 20_000).astype(np.uint64)
    assert f.contains(others).mean() < 0.02
    if n == 20_000:
        assert len(f.slots) < 1.3 * n


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids)) for i in ids]
    return order(out)


def copies(spark, seed=0):
    rnd = random.Random(seed)
    base = [f"text number {i} of {rnd.random()}" for i in range(60)]
    texts = [rnd.choice(base[:20] + base).replace(" ", rnd.choice([" ", "\n", " \t "])) for _ in range(300)]
    return H.documents(spark, texts + ["hot copy"] * 150)


@pytest.mark.parametrize("digest", [None, lambda t: F.pmod(F.crc32(t.cast("binary")), F.lit(7)).cast("string")])
def test_exact_dedup(spark, digest):
    for docs in (copies(spark), H.awkward(spark)):
        kwargs = {"digest": digest} if digest else {}
        rows = exact_dedup(docs, shard_digests=20, **kwargs).collect()
        source = [(r.doc_id, r.text) for r in docs.collect()]
        assert order((r.doc_id, r.keep_id, r.group_size) for r in rows) == expected_groups(source)
        # one row of each group stays, and it is one with the smallest id
        assert sum(r.kept for r in rows) == len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in source})
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)


@pytest.mark.parametrize("held", ["true", "false", "doc_id % 3 = 0"])
def test_the_split_into_snapshot_and_batch_changes_nothing(spark, held):
    docs = copies(spark, 3)
    found = exact_dedup(docs, in_snapshot=F.expr(held)).drop("digest").collect()
    assert order(found) == order(exact_dedup(docs).drop("digest").collect())


# -------------------------------------------------------------- line dedup ----


def expected_lines(rows, min_chars, min_docs):
    low = lambda s: s.strip(WS).translate(H.LOWER)
    holders = defaultdict(list)
    for i, t in rows:
        for k in {low(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")

        def goes(x):
            ids = holders.get(low(x), [])
            known = [j for j in ids if j is not None]
            return len(ids) >= min_docs and bool(known) and i != max(known)

        kept = [x for x in lines if not goes(x)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return order(out)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup(spark, batches):
    rnd = random.Random(batches)
    lines = [f"{rnd.choice(['Line', 'LINE', 'línea'])} {i} long enough to count" for i in range(30)] + ["short", "", "  "]
    texts = ["\n".join(rnd.choice(["", " ", "\t"]) + rnd.choice(lines) for _ in range(rnd.randrange(6))) for _ in range(120)]
    for docs in (H.documents(spark, texts), H.awkward(spark)):
        found = dedup_lines(docs, 8, 3, batches)
        assert found.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
        rows = found.select("doc_id", "text", "n_lines", "n_dropped").collect()
        assert order(map(tuple, rows)) == expected_lines([(r.doc_id, r.text) for r in docs.collect()], 8, 3)


def test_line_dedup_takes_any_column_names(spark):
    docs = H.documents(spark, ["the very same line that is shared", "another one"] * 4)
    names = ["own_id", "dropped", "own_text", "g1", "g2", "__id", "__gone", "__text", "__g1"]
    clashing = docs.withColumns({n: F.lit(n) for n in names})
    cols = ["doc_id", "text", "n_lines", "n_dropped"]
    found = dedup_lines(clashing, 8, 3)
    expected = order(map(tuple, dedup_lines(docs, 8, 3).select(cols).collect()))
    rows = found.collect()
    assert order(tuple(r[c] for c in cols) for r in rows) == expected
    assert all(r[n] == n for r in rows for n in names)


def test_runs_are_compacted_and_screen_later_batches(spark):
    docs = H.documents(spark, [f"a line that is long enough {i % 5}" for i in range(20)])
    keys = line_keys(docs, 10)
    runs = LineRuns(spark)
    for low in (15, 10, 5, 0):
        runs.add(keys.filter(F.col("doc_id").between(low, low + 4)))
    assert [len(x) for x in runs.levels] == [0, 0, 1]  # four runs of level 0 became one of level 2
    assert runs.novel(keys).count() == 0
    other = line_keys(H.documents(spark, ["never seen before in any run"]), 10)
    assert runs.novel(other).count() == 1
    assert runs.repeated(4).count() == 5 and runs.repeated(5).count() == 0
    runs.drop()


def test_runs_reopen_and_go_on(spark):
    docs = H.documents(spark, [f"a line that is long enough {i % 5}" for i in range(20)])
    keys = line_keys(docs, 10)
    runs = LineRuns(spark)
    runs.add(keys.filter("doc_id >= 13"))  # all five lines
    for level in runs.levels:
        for name in level:
            spark.sql(f"DROP TABLE {name}")  # another session's catalogue does not know them
    again = LineRuns.open(spark, runs.path)
    again.add(keys.filter("doc_id < 13"))
    found = {(r.k1, r.k2): r.keep_id for r in again.repeated(4).collect()}
    # the keepers are those of the first batch: the second found all its keys in the runs
    assert sorted(found.values()) == [15, 16, 17, 18, 19]
    assert again.repeated(5).count() == 0
    again.drop()
    with pytest.raises(ValueError, match="no line runs"):
        LineRuns.open(spark, runs.path)


def test_keepers_come_from_the_anti_join(spark, monkeypatch):
    docs = H.documents(spark, ["the very same line that is shared", "another one"] * 8)
    right = dedup_lines(docs, 8, 3).agg(F.sum("n_dropped")).first()[0]
    monkeypatch.setattr("tessera.llm.line_dedup._unseen", lambda keys, runs: keys)
    assert dedup_lines(docs, 8, 3).agg(F.sum("n_dropped")).first()[0] != right == 14


def test_a_merge_anti_join_moves_no_run(spark):
    keys = line_keys(H.documents(spark, [f"a line that is long enough {i}" for i in range(20)]), 10)
    runs = LineRuns(spark)
    runs.add(keys.filter("doc_id < 10"))
    runs.add(keys)  # merged with the first
    runs.add(keys.filter("doc_id > 5"))
    merged, newest = (runs._run(level[0]) for level in reversed(runs.levels))
    for joined in (_unseen(newest, [merged]), runs._merged([merged, newest])):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.drop()


def test_lines_of_null_and_repeated_ids(spark):
    line = "a line that everyone has in common"
    rows = [(None, line), (None, line + "\nand one more that is alone"), (4, line), (4, line), (9, line), (9, "x\n" + line)]
    found = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 8, 3)
    cols = ["doc_id", "text", "n_lines", "n_dropped"]
    assert order(map(tuple, found.select(cols).collect())) == expected_lines(rows, 8, 3)


def test_ranges_cover_all_ids():
    assert _ranges(None, None, 4) == []
    assert _ranges(3, 3, 4) == [(3, 3)]
    spans = _ranges(-5, 17, 4)
    assert spans[0][1] == 17 and spans[-1][0] == -5 and sum(b - a + 1 for a, b in spans) == 23


# ------------------------------------------------------------ n-gram join ----


def planted(spark, seed):
    """Families of near copies around the limit; half of them share one passage."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    draw = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    passage, texts = draw(60), []
    for _ in range(40):
        n = rnd.choice([3, 5, 8, 12, 20, 30, 50, 90, 150, 300])
        base = passage + draw(rnd.randrange(1, 60)) if rnd.random() < 0.5 else draw(n)
        for _ in range(rnd.choice([1, 4, 20])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5, n // 40])):
                at, kind = rnd.randrange(len(w) + 1), rnd.random()
                if kind < 0.4:
                    w[at : at + 1] = draw(1)
                elif kind < 0.7:
                    del w[at : at + 1]
                else:
                    w[at:at] = draw(1)
            texts.append(" ".join(w))
    rnd.shuffle(texts)
    return H.documents(spark, texts).repartition(4)


@pytest.mark.parametrize("size,percent", [(5, 80), (4, 85)])
def test_components_are_exact(spark, size, percent):
    for docs in (planted(spark, size), H.awkward(spark)):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        expected = [
            (i, len(H.shingles(t, size)), c) for (i, t), c in zip(rows, H.components(rows, size, percent))
        ]
        found = near_duplicates(docs, size, percent).select("doc_id", "n_shingles", "component_id").collect()
        assert order(map(tuple, found)) == order(expected)


@pytest.mark.parametrize("size,percent", [(4, 85)])
def test_links_between_distinct_sets_are_counted(spark, size, percent):
    rnd = random.Random(3)
    base = [f"v{rnd.randrange(500)}" for _ in range(150)]
    family = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(0, 150)]  # more than two blocks
    more = H.documents(spark, family).withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = planted(spark, size).unionByName(more).unionByName(H.awkward(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = sorted({H.shingles(t, size) for _, t in rows} - {frozenset()}, key=len)
    n_links = Counter()
    for i, a in enumerate(sets):
        for b in sets[:i]:
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                n_links.update([a, b])
    assert sum(n_links.values()) >= 150 * 149
    expected = [(i, n_links[H.shingles(t, size)], c) for (i, t), c in zip(rows, H.components(rows, size, percent))]
    found = near_duplicates(docs, size, percent, count_links=True).select("doc_id", "n_links", "component_id").collect()
    assert order(map(tuple, found)) == order(expected)


def test_one_of_each_stays(spark):
    docs = planted(spark, 9).unionByName(H.awkward(spark).withColumn("doc_id", F.col("doc_id") + 10_000))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    low = Counter(r.doc_id for r in kept.collect())
    texts = {r.text for r in kept.collect()}
    components_ = dict(zip(rows, H.components(rows, 5, 80)))
    alive = Counter((components_[(r.doc_id, r.text)]) for r in kept.collect() if H.shingles(r.text, 5))
    assert set(alive.values()) == {1} and sum(low.values()) >= len(texts)


def test_linked_sets_share_as_many_tokens_as_needed():
    rng, bands = np.random.default_rng(1), Bands(85)
    for n in (7, 12, 40, 100, 400, 1000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**62, n)).astype(np.uint64)
            d = int(bands.differ(np.array([2 * n]))[0])
            b = np.unique(np.concatenate([a[d // 2 :], rng.integers(0, 2**62, d - d // 2).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared < 85 * (len(a) + len(b) - shared):
                continue
            _, level, need, token = set_tokens([a], bands)
            _, level2, need2, token2 = set_tokens([b], bands)
            at = bands.of(np.array([max(len(a), len(b))]))[0]
            common = set(token[level == at]) & set(token2[level2 == at])
            least = max([*need[level == at], *need2[level2 == at]], default=0)
            assert len(common) >= least or set(token) & set(token2)
            assert set(token) & set(token2)


def test_components_of_long_paths(spark):
    rnd = random.Random(2)
    names = rnd.sample(range(10_000), 300)
    edges = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in zip(names[:200], names[1:200])]
    edges += [(names[200], b) for b in names[201:300]]
    found = {r.key: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{n: min(names[:200]) for n in names[:200]}, **{n: min(names[200:300]) for n in names[200:300]}}


def test_empty_tables(spark):
    none = H.empty(spark)
    assert exact_dedup(none).collect() == []
    assert dedup_lines(none).collect() == []
    assert near_duplicates(none).collect() == []
    assert keep_one_of_each(none).collect() == []
