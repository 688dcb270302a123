"""N-gram Jaccard join by a token-group matrix.

Which documents link (Jaccard of their shingle sets at least ``percent``) is
found exactly, without a pair of every two documents that share a passage:

* *Tokens.*  Sets of similar size are cut into parts by hash; two sets that
  link differ in at most d shingles, so of more than d parts some are equal in
  both.  A token is the hash of one part's content, about a fifth as many as
  there are shingles, and a passage that many documents share seldom fills a
  part alone.  Each set also knows how many of its tokens a partner must have
  (``need``); its ``need - 1`` most crowded tokens can be left out.
* *Groups.*  Equal sets are one node.  Each node is compared with the one leader
  (smallest node of a token) with which it shares most tokens; those that link
  form the groups, so that thousands of near copies are one group after one
  comparison each.
* *Matrix.*  Nodes that share tokens across groups are partitioned into blocks of
  like nodes, and the union of each block's shingles is stored by shingle.  Only
  pairs of blocks that meet in a rare shingle are opened: a node's overlap with
  the union of a block bounds its overlap with each member, and only members of
  blocks that reach the bound are compared.

Links then join groups into components.  Groups are opened in blocks of bounded
size; hot tokens and groups are spread by joins that AQE can split.  Hashes of
shingles and sets have 64 bits: sets that collide (one pair in ten billion
documents) would count as equal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytebpe import text_offsets, text_slices
from tessera.llm.common import WS_CLASS, content_keys, drop_stored, stored, text_or_empty

SLICE_BYTES = 2 << 20
BAND_GROWTH = 1.6
SPARE_PARTS = 3
BLOCK = 64
PREFIX_LEVEL = 1000

# ------------------------------------------------------------- shingles ----

_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return _mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, 0x9E3779B97F4A7C15, _U))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words before each text)."""
    inside = ~_WHITE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    begin[firsts] = inside[firsts]  # a word does not go on in the next text
    at = np.flatnonzero(begin)
    words = np.searchsorted(at, offsets)
    if not len(at):
        return np.zeros(0, _U), words
    letters = _LOWER[data[inside]]
    starts = np.cumsum(inside)[at] - 1  # place of each word among the letters
    lengths = np.diff(np.append(starts, len(letters)))
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    values = _byte_values()[letters] * _powers(int(lengths.max()))[place]
    return _mix(np.add.reduceat(values, starts) + lengths.astype(_U)), words


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text; fewer words make one shingle, none an empty set."""
    offsets = text_offsets(texts)
    raw = texts.cast(pa.large_string()).buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    with np.errstate(over="ignore"):
        words, at = _word_hashes(data, offsets - offsets[0])
        rolled = np.zeros(len(words), _U)
        for j in range(min(size, len(words))):
            rolled[: len(words) - j] = _mix(rolled[: len(words) - j] * _U(3) + words[j:] + _U(j + 1))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(words[a:b].tobytes(), b - a)], _U))
        else:
            out.append(np.zeros(0, _U))
    return out


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Do two non-empty sorted sets reach the similarity?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int(np.count_nonzero(large[at] == small))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


# --------------------------------------------------------------- tokens ----


class Bands:
    """Size bands: a pair is looked for at the level of the band of its larger set."""

    def __init__(self, percent: int):
        self.percent = percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
        self.edges = np.array(edges)

    def differ(self, total: np.ndarray) -> np.ndarray:
        """Most shingles that only one of two linked sets has, for sizes that add up to ``total``."""
        return total * (100 - self.percent) // (100 + self.percent)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, "right") - 1

    def parts(self, level: np.ndarray) -> np.ndarray:
        return self.differ(2 * (self.edges[level + 1] - 1)) + 1 + SPARE_PARTS

    def largest(self, n: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The largest partner that a set of size n can have at the level."""
        return np.minimum(self.edges[level + 1] - 1, 100 * n // self.percent)


def set_tokens(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, ...]:
    """(set number, level, need, token) of every token of non-empty sets, by set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.flatnonzero(sizes > 0)
    level = bands.of(sizes[own])
    up = bands.largest(sizes[own], level + 1) >= bands.edges[level + 1]
    which = np.concatenate([own, own[up]])
    level = np.concatenate([level, level[up] + 1])
    most = bands.differ(sizes[which] + bands.largest(sizes[which], level))
    some = most > 0  # else only equal sets link, which are one node
    which, level, most = which[some], level[some], most[some]
    if not len(which):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    with np.errstate(over="ignore"):
        k, n = bands.parts(level), sizes[which]
        base = np.cumsum(k) - k
        values = np.concatenate([sets[i] for i in which])
        of = np.repeat(np.arange(len(which)), n)
        mixed = _mix(values + _U(0x632BE59BD9B4E019))
        part = ((mixed >> _U(32)) * k[of].astype(_U) >> _U(32)).astype(np.int64)
        sums = np.zeros(int(k.sum()), _U)
        np.add.at(sums, base[of] + part, _mix(mixed))
        held = np.bincount(base[of] + part, minlength=len(sums))
        row = np.repeat(np.arange(len(which)), k)
        number = np.arange(len(sums)) - base[row]
        tokens = _mix(_mix(sums + held.astype(_U)) + (level[row] * 1_000_003 + number).astype(_U))
        full = held > 0
        filled = np.bincount(row[full], minlength=len(which))
        need = np.maximum(filled - most, 1)
        out = [which[row[full]], level[row[full]], need[row[full]], tokens[full].view(np.int64)]
        # sets whose parts may all differ from a partner's: the least shingles, one of which any partner has
        extra = [[x] for x in out]
        for i in np.flatnonzero(filled <= most):
            s = sets[which[i]]
            first = s[: len(s) - (-(-bands.percent * len(s) // 100)) + 1]
            for column, x in zip(extra, (which[i], PREFIX_LEVEL, 1, None)):
                column.append(_mix(first + _U(11)).view(np.int64) if x is None else np.full(len(first), x))
        out = [np.concatenate(c) for c in extra]
    order = np.argsort(out[0], kind="stable")
    return tuple(c[order] for c in out)


def _set_key(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes()))))


def signatures(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, id, h1, h2, n, key, level, need, token): the set of each row and, once per task and set, its tokens."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for part in text_slices(batch, batch.schema.get_field_index("text"), SLICE_BYTES):
                sets = shingle_sets(part.column("text"), size)
                keys = [_set_key(s) for s in sets]
                new = []
                for key, s in zip(keys, sets):
                    new.append(s if key not in seen else s[:0])
                    seen.add(key)
                which, level, need, token = set_tokens(new, bands)
                at = pa.array(np.searchsorted(which, np.arange(len(sets) + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(at, pa.array(x, t))
                    for x, t in ((level, pa.int32()), (need, pa.int32()), (token, pa.int64()))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc_id", "h1", "h2")),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.int64()),
                        *lists,
                    ],
                    ["doc_id", "h1", "h2", "n", "key", "level", "need", "token"],
                )

    return rows.mapInArrow(
        sign,
        f"doc_id {kind}, h1 long, h2 long, n long, key long, level array<int>, need array<int>, token array<long>",
    )


# ----------------------------------------------------------- candidates ----


def shared_tokens(signed: DataFrame) -> DataFrame:
    """(token, key): the tokens that two different nodes have, without those that a node can leave out."""
    each = signed.filter(F.size("token") > 0).select(
        "key", F.inline(F.arrays_zip("token", "level", "need")).alias("token", "level", "need")
    )
    by_token = Window.partitionBy("token")
    several = (
        each.withColumn("crowd", F.count("*").over(by_token))
        .withColumn("low", F.min("key").over(by_token))
        .withColumn("high", F.max("key").over(by_token))
        .filter("low < high")
        .select("token", "key", "level", "need", "crowd")
        .distinct()
    )
    crowded_first = Window.partitionBy("key", "level").orderBy(F.desc("crowd"), "token")
    return several.withColumn("place", F.row_number().over(crowded_first)).filter("place >= need").select("token", "key")


def node_sets(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(key, n, hashes): the set of each node, from one of the documents that have it."""
    # nodes without tokens in a task were signed by an earlier row of that task
    chosen = (
        signed.filter(F.size("token") > 0)
        .join(nodes.select("key").distinct(), "key", "left_semi")
        .groupBy("key")
        .agg(F.min(F.struct("h1", "h2")).alias("c"))
        .select("key", "c.h1", "c.h2")
    )
    texts = docs.join(chosen, ["h1", "h2"]).select("key", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1, SLICE_BYTES):
                found = shingle_sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                    ],
                    ["key", "n", "hashes"],
                )

    # a repeated row may have brought the same node twice
    return texts.mapInArrow(sets, "key long, n long, hashes binary").dropDuplicates(["key"])


def best_leaders(tokens: DataFrame) -> DataFrame:
    """(a, b): each node with the leader it shares most tokens with; leaders are the smallest nodes of tokens."""
    led = tokens.withColumn("b", F.min("key").over(Window.partitionBy("token"))).filter("key > b")
    counts = led.groupBy(F.col("key").alias("a"), "b").agg(F.count("*").alias("n"))
    return counts.groupBy("a").agg(F.max(F.struct("n", "b")).alias("best")).select("a", F.col("best.b").alias("b"))


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("x"), batch.column("y"))
            keep = [links(np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U), percent) for x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(compare, "a long, b long")


# ----------------------------------------------------------- components ----


def components(edges: DataFrame) -> DataFrame:
    """(key, root): the smallest node of each node's component, for the nodes of ``edges`` (a, b).

    Each round gives every node the smallest root next to it and then follows
    the roots' own roots; the number of rounds grows as the logarithm of the
    longest path.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    roots = stored(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("low")).select(
        "key", F.least("key", "low").alias("root")), "roots")
    while True:
        near = (
            both.join(roots.select(F.col("key").alias("b"), F.col("root").alias("r")), "b")
            .groupBy(F.col("a").alias("key"))
            .agg(F.min("r").alias("r"))
        )
        # roots hook onto the smallest root that any of their nodes sees
        hooks = (
            roots.join(near, "key").select("root", F.least("root", "r").alias("to")).groupBy("root").agg(F.min("to").alias("to"))
        )
        hooked = roots.join(hooks, "root").select("key", F.col("to").alias("root"))
        jump = hooked.select(F.col("key").alias("root"), F.col("root").alias("next"))
        moved = stored(hooked.join(jump, "root").select("key", F.col("next").alias("root")), "roots")
        changed = not moved.join(roots.withColumnRenamed("root", "old"), "key").filter("root != old").isEmpty()
        drop_stored(roots)
        roots = moved
        if not changed:
            drop_stored(both)
            return roots


# --------------------------------------------------------------- matrix ----


def _shingles_of(sets: DataFrame) -> DataFrame:
    """(key, grp, n, token): every shingle of the given nodes (key, grp, n, hashes)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tokens = np.frombuffer(batch.column("hashes")[row].as_py(), np.int64)
                at = pa.array(np.full(len(tokens), row))
                rest = [batch.column(c).take(at) for c in ("key", "grp", "n")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(tokens)], ["key", "grp", "n", "token"])

    return sets.select("key", "grp", "n", "hashes").mapInArrow(each, "key long, grp long, n long, token long")


def opened_links(
    tokens: DataFrame,
    leaders: DataFrame,
    groups: DataFrame | None,
    sets: DataFrame,
    percent: int,
) -> DataFrame:
    """(a, b, n) of nodes that link and are not linked yet, as many as join their groups; n is 0.

    Of two opened blocks, links between groups that other links there have joined
    are passed over: at most one link per node, not one per pair.

    Without ``groups`` each node is its own and no pair is passed over: besides
    the links that join, rows (a, a, n) count the links of node a in two opened
    blocks, so that their sum is the exact number of nodes it links with.

    ``leaders``: (a, b) of each node and the leader it is likest; ``groups``:
    (key, root) of the nodes linked so far.  Nodes that share a token with
    another linked group are partitioned into blocks of up to BLOCK nodes of the
    same leader.  The matrix has a row (shingle, block) for what the nodes of a
    block hold.  A node that links has at least ceil(percent * n / 100) shingles
    in common with its partner, so all but one of that many can be left out,
    those in most groups first: a passage that thousands of groups share is not
    among the rest.  Pairs of blocks that meet in the matrix are opened.
    """
    count = groups is None
    if count:
        groups = sets.select("key", F.col("key").alias("root"))
    sized = stored(
        tokens.join(groups, "key", "left").select("token", "key", F.coalesce("root", "key").alias("grp")), "grouped"
    )
    by_token = Window.partitionBy("token")
    mixed = sized.withColumn("low", F.min("grp").over(by_token)).withColumn("high", F.max("grp").over(by_token))
    mixed = mixed.filter("low < high").select("key", "grp").distinct()
    family = mixed.join(leaders.select(F.col("a").alias("key"), F.col("b").alias("family")), "key", "left")
    family = family.withColumn("family", F.coalesce("family", "key"))
    number = F.row_number().over(Window.partitionBy("family").orderBy("key")) - 1
    nodes = stored(
        family.select("key", "grp", F.xxhash64("family", F.floor(number / BLOCK)).alias("block")).join(sets, "key"), "nodes"
    )
    shingles = stored(_shingles_of(nodes), "shingles")
    matrix = shingles.select("token", "grp").distinct().withColumn("crowd", F.count("*").over(by_token))
    held = shingles.join(matrix.filter("crowd > 1"), ["token", "grp"])
    crowded_first = Window.partitionBy("key").orderBy(F.desc("crowd"), "token")
    least = F.ceil(F.col("n") * percent / 100)
    rare = held.withColumn("place", F.row_number().over(crowded_first)).filter(F.col("place") >= least)
    rare = stored(rare.join(nodes.select("key", "block"), "key").select("token", "block").distinct(), "matrix")
    other = rare.select("token", F.col("block").alias("to"))
    pairs = stored(rare.join(other, "token").filter("block <= to").select("block", "to").distinct(), "block-pairs")
    blocks = stored(
        nodes.groupBy("block").agg(F.collect_list(F.struct("key", "grp", "hashes")).alias("held")), "blocks"
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for left, right, same in zip(batch["x"], batch["y"], batch["same"]):
                counts: Counter[int] = Counter()
                right = [(m["key"], m["grp"], np.frombuffer(m["hashes"], _U)) for m in right]
                union = np.unique(np.concatenate([s for _, _, s in right]))
                joined: dict[int, int] = {}  # groups that links of this pair of blocks have joined

                def root(grp: int) -> int:
                    while grp in joined:
                        grp = joined[grp]
                    return grp

                for q in left:
                    x = np.frombuffer(q["hashes"], _U)
                    at = np.searchsorted(union, x)
                    at[at == len(union)] = 0
                    if 100 * np.count_nonzero(union[at] == x) < percent * len(x):
                        continue  # no member of the block can reach the similarity
                    for key, grp, s in right:
                        a, b = root(q["grp"]), root(grp)
                        if (a == b and not count) or key == q["key"] or not links(x, s, percent):
                            continue
                        if count:
                            # two nodes of one block meet twice
                            counts.update([q["key"]] if same else [q["key"], key])
                        if a != b:
                            joined[a] = b
                            found.append((q["key"], key, 0))
                found += [(key, key, n) for key, n in counts.items()]
            yield pd.DataFrame(found, columns=["a", "b", "n"], dtype="int64")

    left = blocks.select("block", F.col("held").alias("x"))
    right = blocks.select(F.col("block").alias("to"), F.col("held").alias("y"))
    opened = pairs.join(left, "block").join(right, "to").select("x", "y", (F.col("block") == F.col("to")).alias("same"))
    out = stored(opened.mapInPandas(compare, "a long, b long, n long"), "opened")
    for table in (sized, nodes, shingles, rare, pairs, blocks):
        drop_stored(table)
    return out


# ----------------------------------------------------------------- join ----


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    count_links: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, h1, h2) of every row of ``docs``.

    With ``count_links`` also n_links, the exact number of other distinct sets
    that the row's set links with; every pair of the opened blocks is then
    compared.  Without it, only links that join components are.

    A document's set holds its distinct shingles of ``size`` words (A-Z in lower
    case); fewer words are one shingle.  Documents link when 100 * shared >=
    ``percent`` * united.  ``component_id`` is the smallest id reachable by
    links, ``component`` the smallest hash of a set there (null without
    shingles); h1 and h2 are the row's ``content_keys``.

    Null and empty texts, and texts of white space, have no shingles and link
    with nothing: each is its own component.  Repeated rows have equal sets and
    so link.  Null ids are passed over in the smallest id, which is null only if
    all ids of a component are.  Other columns are not carried.  An empty table
    gives an empty result.
    """
    rows = _keyed(docs, doc_id, text).select(
        *(F.col(f"__{c}").alias(a) for c, a in (("id", "doc_id"), ("text", "text"), ("h1", "h1"), ("h2", "h2")))
    )
    signed = stored(signatures(rows, size, percent), "signatures")
    tokens = stored(shared_tokens(signed), "shared-tokens")
    sets = stored(node_sets(rows, signed, tokens, size), "node-sets")
    leaders = stored(best_leaders(tokens), "leaders")
    done = [tokens, sets, leaders]
    if count_links:
        every = opened_links(tokens, leaders, None, sets, percent)
        numbers = stored(every.filter("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n_links")), "link-counts")
    else:
        first = stored(linked_pairs(leaders, sets, percent), "leader-links")
        groups = components(first)
        rest = opened_links(tokens, leaders, groups, sets, percent)
        every = stored(first.select("a", "b").union(rest.select("a", "b")), "links")
        done += [first, groups, rest]
    roots = components(every.filter("a != b"))
    for table in (*done, every):
        drop_stored(table)

    nodes = signed.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("low")).join(roots, "key", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "key"))
    lowest = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = nodes.join(lowest, "root").select("key", "component_id", F.col("root").alias("component"))
    if count_links:
        ids = ids.join(numbers, "key", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    found = signed.filter("n > 0").join(ids, "key")
    alone = signed.filter("n = 0").withColumns({"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")})
    if count_links:
        alone = alone.withColumn("n_links", F.lit(0).cast("long"))
    result = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "component", "h1", "h2"]
    result += ["n_links"] if count_links else []
    return found.select(*result).unionByName(alone.select(*result))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    plain = text_or_empty(text)
    h1, h2 = content_keys(doc_id, plain)
    return docs.withColumns({"__id": F.col(doc_id), "__text": plain, "__h1": h1, "__h2": h2})


def keep_one_of_each(
    docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, the row with the smallest id.

    A null id comes last; ties in the id are broken by content, and of repeated
    rows one stays.  Documents without shingles all stay.
    """
    found = near_duplicates(docs, size, percent, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), "h1", "h2")
    first = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("k")).select(
        F.col("k.h1").alias("__h1"), F.col("k.h2").alias("__h2")
    )
    keyed = _keyed(docs, doc_id, text)
    empty = F.regexp_replace("__text", WS_CLASS + "+", "") == ""
    kept = keyed.filter(~empty).join(first, ["__h1", "__h2"], "left_semi").dropDuplicates(["__h1", "__h2"])
    return kept.select(*docs.columns).unionByName(keyed.filter(empty).select(*docs.columns))
