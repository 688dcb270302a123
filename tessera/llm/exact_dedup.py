"""Exact dedup: static binary-fuse filters per immutable snapshot.

A snapshot is the digest table of documents already held, with one binary-fuse
filter per shard of digests.  A new batch is grouped by digest first (its own
duplicates), and its distinct digests are screened by the filters.  Only the
positives, true or false, are joined with the exact digest buckets of the
snapshot.  Texts of groups with more than one row are then compared byte by
byte: equal digests with different texts are told apart by the text itself.

Shards hold a bounded number of *distinct* digests, so neither a filter nor a
screening task grows with the corpus or with a group of copies.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WS_CLASS, drop_stored, stored, text_or_empty

SHARD_DIGESTS = 4_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def normalised(text: Column) -> Column:
    """Text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(text), WS_CLASS + "+", " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


# ------------------------------------------------------------ the filter ----


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _places(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots of each key, in three consecutive segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    base = first.astype(np.int64) * segment
    mask = segment - 1
    spots = [(h >> np.uint64(s)).astype(np.int64) & mask for s in (0, 11, 21)]
    return np.stack([base + i * segment + spots[i] for i in range(3)])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) * _MIX1 >> np.uint64(56)).astype(np.uint8)


class BinaryFuse:
    """Static approximate set of 64-bit keys: no false negatives, 1 in 256 false positives.

    Three slots per key in neighbouring segments, about 1.13 bytes per key for
    large sets; built by peeling slots that only one key uses.
    """

    def __init__(self, seed: int, segment: int, segments: int, slots: np.ndarray):
        self.seed, self.segment, self.segments, self.slots = seed, segment, segments, slots

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = max(len(keys), 2)
        # sizes of the published construction for three places
        segment = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
        slots = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
        segments = max(1, -(-slots // segment) - 2)
        seed = 0
        while True:
            h = _mixed(keys, seed)
            found = cls._peel(h, segment, segments)
            if found is not None:
                return cls(seed, segment, segments, found)
            seed += 1
            if seed % 8 == 0:
                segments += 1 + segments // 16

    @staticmethod
    def _peel(h: np.ndarray, segment: int, segments: int) -> np.ndarray | None:
        size = (segments + 2) * segment
        at = _places(h, segment, segments)
        count = np.bincount(at.ravel(), minlength=size)
        who = np.zeros(size, np.int64)  # xor of the keys in a slot: the key itself once it is alone
        for row in at:
            np.bitwise_xor.at(who, row, np.arange(len(h)))
        rounds: list[tuple[np.ndarray, np.ndarray]] = []
        left, alone = len(h), np.flatnonzero(count == 1)
        while len(alone):
            keys, first = np.unique(who[alone], return_index=True)
            rounds.append((keys, alone[first]))
            left -= len(keys)
            for row in at[:, keys]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(who, row, keys)
            touched = np.unique(at[:, keys])
            alone = touched[count[touched] == 1]
        if left:
            return None
        slots, prints = np.zeros(size, np.uint8), _prints(h)
        for keys, own in reversed(rounds):
            others = slots[at[0, keys]] ^ slots[at[1, keys]] ^ slots[at[2, keys]]  # its own slot is still 0
            slots[own] = prints[keys] ^ others
        return slots

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mixed(keys.astype(np.uint64), self.seed)
        a, b, c = _places(h, self.segment, self.segments)
        return (self.slots[a] ^ self.slots[b] ^ self.slots[c]) == _prints(h)


# ---------------------------------------------------------- the snapshot ----


def _key64(digest: Column) -> Column:
    return F.xxhash64(digest)


def _shard(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(7)), F.lit(shards)).cast("int")


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, first, n): the row that stays and the size of each group of equal digests."""
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("uid").alias("c"))
    return rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n"))


def build_filters(digests: DataFrame, shards: int) -> DataFrame:
    """(shard, seed, segment, segments, slots): one static filter per shard of distinct digests."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = BinaryFuse.build(pdf["key"].to_numpy().view(np.uint64))
        row = (int(pdf["shard"].iloc[0]), f.seed, f.segment, f.segments, f.slots.tobytes())
        return pd.DataFrame([row], columns=["shard", "seed", "segment", "segments", "slots"])

    keyed = digests.select(_shard(F.col("digest"), shards).alias("shard"), _key64(F.col("digest")).alias("key"))
    return keyed.groupBy("shard").applyInPandas(
        build, "shard int, seed int, segment int, segments int, slots binary"
    )


def screen(digests: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The distinct digests that may be in the snapshot: all true members and a few others."""

    def test(pdf: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(pdf):
            return pdf.loc[[], ["digest"]]
        row = held.iloc[0]
        f = BinaryFuse(int(row.seed), int(row.segment), int(row.segments), np.frombuffer(row.slots, np.uint8))
        return pdf.loc[f.contains(pdf["key"].to_numpy().view(np.uint64)), ["digest"]]

    keyed = digests.select(
        "digest", _shard(F.col("digest"), shards).alias("shard"), _key64(F.col("digest")).alias("key")
    )
    return (
        keyed.groupBy("shard")
        .cogroup(filters.groupBy("shard"))
        .applyInPandas(test, digests.select("digest").schema)
    )


# --------------------------------------------------------------- dedup ----


def exact_dedup(
    docs: DataFrame,
    in_snapshot: Column | None = None,
    digest: Callable[[Column], Column] = sha256_hex,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_digests: int = SHARD_DIGESTS,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row of ``docs``.

    Texts are equal when identical after white space is normalised; of equal
    texts the row with the smallest id stays.  ``in_snapshot`` tells the rows
    that were already held from the new batch (by default, ids up to the middle
    of the id range); it shares out the work and does not change the result.

    Null text is empty text, so empty and null texts form one group.  A null id
    comes after all others; rows that tie in id and text (repeated rows) are one
    group, of which exactly one row stays.  Columns besides id and text are
    ignored.  ``digest`` may be weak: texts are compared in full.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        digest(normalised(F.col(text))).alias("digest"),
        (F.lit(None).cast("boolean") if in_snapshot is None else in_snapshot).alias("held"),
    )
    rows = stored(rows, "digests")
    if in_snapshot is None:
        low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        rows = rows.withColumn("held", F.col("doc_id") <= F.lit(0 if low is None else (low + high) // 2))
    held = F.coalesce("held", F.lit(False))

    snapshot = stored(grouped(rows.filter(held)), "snapshot")
    batch = stored(grouped(rows.filter(~held)), "batch")
    shards = -(-max(snapshot.count(), batch.count(), 1) // shard_digests)
    filters = stored(build_filters(snapshot, shards), "fuse-filters")
    positives = screen(batch.select("digest"), filters, shards)
    # exact buckets of the positives; false positives find no partner
    both = stored(
        positives.join(snapshot, "digest").join(
            batch.select("digest", F.col("n").alias("more"), F.col("first").alias("new_first")), "digest"
        ),
        "matched",
    )
    groups = stored(grouped_again(snapshot, batch, both), "groups")
    for table in (snapshot, batch, filters, both):
        drop_stored(table)

    # byte check: the texts behind one digest, for groups of more than one row
    texts = docs.select(normalised(F.col(text)).alias("norm")).withColumn("digest", digest(F.col("norm")))
    several = texts.join(groups.filter("n > 1").select("digest"), "digest", "left_semi").groupBy("digest", "norm").count()
    clashes = stored(several.groupBy("digest").count().filter("count > 1").select("digest"), "clashes")

    def result(r: DataFrame, g: DataFrame, on: list[str]) -> DataFrame:
        return r.join(g, on).select(
            "doc_id",
            F.col("first.b").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("uid") == F.col("first.c")).alias("kept"),
            "digest",
        )

    if clashes.isEmpty():
        return result(rows, groups, ["digest"])
    # digests that several texts share: these rows are grouped by their texts
    full = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))
    full = stored(full.join(clashes, "digest", "left_semi"), "clash-texts")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("uid").alias("c"))
    by_text = full.groupBy("digest", "norm").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    return result(rows.join(clashes, "digest", "left_anti"), groups, ["digest"]).unionByName(
        result(full, by_text, ["digest", "norm"])
    )


def grouped_again(snapshot: DataFrame, batch: DataFrame, both: DataFrame) -> DataFrame:
    """Groups over snapshot and batch: matched ones take the smaller first row of the two."""
    return (
        snapshot.join(both.select("digest"), "digest", "left_anti")
        .unionByName(batch.join(both.select("digest"), "digest", "left_anti"))
        .unionByName(
            both.select("digest", F.least("first", "new_first").alias("first"), (F.col("n") + F.col("more")).alias("n"))
        )
    )
