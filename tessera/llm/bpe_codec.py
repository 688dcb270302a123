"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

Two passes.  The first counts the distinct words (pieces) of the slices; the most
common ones, a bounded number, are folded once.  The second
splits a slice of texts into its distinct pieces, knows the ids of the common
ones and hands Spark one row: the byte array of each other piece, as ids of
single bytes, and for each text the runs of ids between such pieces, with their
numbers.  In both, higher-order functions fold the ranked merges over a word,
looking pairs up in a literal rank map; then they put the ids of each text
together.  Decoding looks the piece of each id up in a literal array and concatenates.

The literal rank map is a hash table without collisions, in two literal arrays: a
literal map would be searched from end to end.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import gcd
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytebpe import Pieces, load_vocabulary, split_texts, text_slices
from tessera.llm.common import drop_stored, let, stored

LONG_PIECE = 256  # bytes; the fold takes quadratic time, so longer pieces are merged with a heap beforehand
SLICE_BYTES = 4 << 20
COUNTED_BYTES = 4 << 20  # slices of the first pass
WORDS_PER_ROW = 4_000
COUNTS = 10_000  # slices of a word are told apart up to so many
COMMON_WORDS = 1_500_000  # at most so many words are folded beforehand and sent to the tasks
# the fold's state has a number per part: what it and the next one merge into, its place, its id
_ID_BITS, _PLACE_BITS = 26, 11
_ID_MASK = (1 << _ID_BITS) - 1
_RANK_SHIFT = _ID_BITS + _PLACE_BITS
NEVER = _ID_MASK  # above every id, as it stands for no merge
_EMPTY = 1 << 62  # above every pair
_STRIDE = 40503  # between the shifts that are tried for a group of pairs


class RankMap(NamedTuple):
    """Hash table of the pairs (two ids in one number) without collisions: pair x is at (x + shift[x % len(shift)]) % len(cells).

    A cell holds a pair's number above its merged id, so ``cell ^ (pair << _ID_BITS)``
    is the merged id, and more than any id for another pair.
    """

    shift: Column
    cells: Column
    shifts: int
    size: int


def _placed(merges: dict[int, int]) -> tuple[list[int], list[int]]:
    """Shifts and cells of a :class:`RankMap`: the fullest groups of pairs are placed first."""
    shifts, size = len(merges) // 3 * 2 + 1, len(merges) * 3 // 2 + 1
    while gcd(shifts * _STRIDE, size) > 1:
        size += 1
    groups: list[list[int]] = [[] for _ in range(shifts)]
    for pair in merges:
        groups[pair % shifts].append(pair)
    shift, cells = [0] * shifts, [_EMPTY] * size
    free = 0
    for at in sorted(range(shifts), key=lambda g: -len(groups[g])):
        group = groups[at]
        if len(group) > 1:
            for attempt in range(size):
                by = attempt * _STRIDE % size
                places = {(pair + by) % size for pair in group}
                if len(places) == len(group) and all(cells[p] == _EMPTY for p in places):
                    break
            else:
                raise ValueError("the pairs cannot be placed")
        elif group:
            free = next(i for i in range(free, size) if cells[i] == _EMPTY)
            by = (free - group[0]) % size
        else:
            break
        shift[at] = by
        for pair in group:
            cells[(pair + by) % size] = pair << _ID_BITS | merges[pair]
    return shift, cells


@lru_cache(2)
def _rank_literals(path: str) -> tuple[str, str, int, int]:
    """JSON of the shifts and of the cells of the rank map, and how many there are.

    Ids are ranks.  A pair of pieces merges if their joined bytes are a piece.
    """
    ids = load_vocabulary(path).ids
    base = max(ids.values()) + 1
    if base > 1 << 18:
        raise ValueError("a pair and an id would not fit in one number")
    merges: dict[int, int] = {}
    for piece, rank in ids.items():
        for cut in range(1, len(piece)):
            first, second = ids.get(piece[:cut]), ids.get(piece[cut:])
            if first is not None and second is not None:
                merges[first << 18 | second] = rank
    shift, cells = _placed(merges)
    return json.dumps(shift), json.dumps(cells), len(shift), len(cells)


@lru_cache(2)
def _piece_literal(path: str) -> str:
    """JSON of the pieces by id; bytes as the characters U+0000 to U+00FF."""
    ids = load_vocabulary(path).ids
    pieces = [""] * (max(ids.values()) + 1)
    for piece, rank in ids.items():
        pieces[rank] = piece.decode("latin-1")
    return json.dumps(pieces)


def with_rank_map(path: str, body: Callable[[RankMap], Column]) -> Column:
    """``body`` of the literal rank map, which is in the plan once."""
    shift, cells, shifts, size = _rank_literals(path)
    return let(
        F.from_json(F.lit(shift), "array<int>"),
        lambda s: let(
            F.from_json(F.lit(cells), "array<bigint>"), lambda c: body(RankMap(s, c, shifts, size))
        ),
    )


def _merged(ranks: RankMap, first: Column, second: Column) -> Column:
    """The id that two neighbours (longs) merge into, which is its rank; NEVER if none or if one is null."""
    pair = F.shiftleft(first, 18) + second
    cell = ranks.cells[(pair + ranks.shift[pair % ranks.shifts]) % ranks.size]
    return F.least(cell.bitwiseXOR(F.shiftleft(pair, _ID_BITS)), F.lit(NEVER).cast("long"))


def fold_merges(parts: Column, ranks: RankMap) -> Column:
    """Ids of one piece, given as the ids of its bytes: the lowest-ranked pair is merged until none is left.

    The fold's state has one number for each part: what it merges into with the
    next one, its place and its id, so that the least number is the merge that is
    due, the leftmost of equals.  A merge puts one number for two and looks up
    the two pairs that it touches.
    """

    def packed(first: Column, second: Column, place: Column) -> Column:
        return F.shiftleft(_merged(ranks, first, second), _RANK_SHIFT) + place + first

    def part(x: Column) -> Column:
        return x.bitwiseAND(_ID_MASK)

    def place(x: Column) -> Column:
        return x.bitwiseAND(((1 << _PLACE_BITS) - 1) << _ID_BITS)

    def start(p: Column) -> Column:
        return F.transform(
            p,
            lambda x, i: packed(x.cast("long"), F.get(p, i + 1).cast("long"), F.shiftleft(i.cast("long"), _ID_BITS)),
        )

    def step(s: Column, _: Column) -> Column:
        def merge(low: Column, at: Column) -> Column:
            rank = F.shiftright(low, _RANK_SHIFT)
            # x follows s[i] and takes its index, as the numbers after the merge do
            joined = F.transform(
                F.slice(s, 2, F.size(s)),
                lambda x, i: F.when(place(x) < at, s[i])
                .when(x == low, packed(part(s[i]), rank, place(s[i])))
                .when(s[i] == low, packed(rank, part(F.get(s, i + 2)), at))
                .otherwise(x),
            )
            return F.when(low >= NEVER << _RANK_SHIFT, s).otherwise(joined)

        return let(F.array_min(s), lambda low: let(place(low), lambda at: merge(low, at)))

    # as many steps as there can be merges
    steps = F.slice(parts, 2, F.size(parts))
    return F.aggregate(steps, start(parts), step, lambda s: F.transform(s, lambda x: part(x).cast("int")))


@lru_cache(2)
def _single(path: str) -> np.ndarray:
    """Ids of the 256 bytes."""
    ids = load_vocabulary(path).ids
    return np.array([ids[bytes([b])] for b in range(256)], np.int32)


def _byte_ids(words: list[bytes], path: str) -> pa.ListArray:
    """Each word as the ids of its bytes."""
    ends = np.append(0, np.cumsum([len(w) for w in words])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_single(path)[np.frombuffer(b"".join(words), np.uint8)]))


def common_words(texts: DataFrame, path: str, most: int = COMMON_WORDS) -> pa.Table:
    """(word, ids) of the words that most slices share, at most ``most`` and none of a single slice; each folded once.

    Tokens, which need no fold, and pieces of over ``LONG_PIECE`` bytes are left out.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = load_vocabulary(path).ids
        for batch in batches:
            for part in text_slices(batch, 0, COUNTED_BYTES):
                words = [p for p in split_texts(part.column(0), path).distinct if p not in ids and len(p) <= LONG_PIECE]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], ["word"])

    def in_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, WORDS_PER_ROW):
                words = batch.column(0).slice(at, WORDS_PER_ROW).to_pylist()
                parts, whole = _byte_ids(words, path), pa.array([0, len(words)], pa.int32())
                columns = [pa.ListArray.from_arrays(whole, c) for c in (pa.array(words, pa.binary()), parts)]
                yield pa.RecordBatch.from_arrays(columns, ["word", "parts"])

    found = texts.mapInArrow(distinct, "word binary")
    shared = stored(found.groupBy("word").count().where(F.col("count") > 1), "words")
    # the words of at least so many slices: no sort of all, and a bounded histogram
    often = F.least("count", F.lit(COUNTS)).alias("often")
    least, kept = COUNTS + 1, 0
    for count, n in sorted(map(tuple, shared.groupBy(often).count().collect()), reverse=True):
        if kept + n > most:
            break
        least, kept = count, kept + n
    common = shared.where(F.col("count") >= least) if kept else shared.where(F.col("count") >= COUNTS).limit(most)
    # rows of a bounded number of words, spread over the tasks
    rows = common.select("word").mapInArrow(in_rows, "word array<binary>, parts array<array<int>>")
    rows = rows.repartition(max(kept // WORDS_PER_ROW // 8, 1))
    ids = with_rank_map(path, lambda ranks: F.transform("parts", lambda p: fold_merges(p, ranks)))
    table = rows.select(F.inline(F.arrays_zip(F.col("word"), ids.alias("ids")))).toArrow()
    drop_stored(shared)
    return table


class _Known:
    """Ids of the tokens and of the common words, kept flat: word at place i has ``ids[ends[i] : ends[i + 1]]``.

    The common words are found by sorted hashes and then compared.
    """

    def __init__(self, tokens: dict[bytes, int], table: pa.Table):
        self.words, ids = (table.column(i).combine_chunks() for i in (0, 1))
        self.place = {piece: i for i, piece in enumerate(tokens)}  # a piece that is a token is that token
        single = np.fromiter(tokens.values(), np.int32, len(tokens))
        self.ids = np.append(single, ids.values.to_numpy().astype(np.int32, copy=False))
        self.ends = np.append(np.arange(len(tokens)), len(tokens) + ids.offsets.to_numpy().astype(np.int64))
        hashes, step = np.zeros(len(self.words), np.int64), 1 << 16
        for at in range(0, len(hashes), step):
            hashes[at : at + step] = self._hashes(self.words.slice(at, step).to_pylist())
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(hash, words), np.int64, len(words))

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word, -1 for an unknown one."""
        get = self.place.get
        places = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        others = np.flatnonzero(places < 0)
        if len(others) and len(self.hashes):
            rest = [words[i] for i in others.tolist()]
            near = np.searchsorted(self.hashes, self._hashes(rest))
            row = self.order[np.minimum(near, len(self.hashes) - 1)]
            same = pc.equal(self.words.take(pa.array(row)), pa.array(rest, self.words.type)).to_numpy(False)
            places[others[same]] = len(self.place) + row[same]
        return places


def _known_runs(
    pieces: Pieces, lengths: np.ndarray, starts: np.ndarray, ids: np.ndarray, number: np.ndarray
) -> tuple[pa.ListArray, pa.ListArray]:
    """For each text the runs of known ids, and the number of the unknown piece after each run (0 after the last).

    Of each distinct piece: ``lengths`` and ``starts`` of its known ids in
    ``ids``, and the ``number`` of an unknown one, else 0.
    """
    index, docs = pieces.index, pieces.docs
    n = lengths[index]
    ends = np.append(0, np.cumsum(n))
    flat = ids[np.repeat(starts[index] - ends[:-1], n) + np.arange(ends[-1])]
    open_at = np.flatnonzero(number[index])
    # a run ends at each unknown piece and at the end of each text; at one place, unknown pieces come after text ends
    cuts = np.append(docs[1:], open_at)
    after = np.append(np.zeros(len(docs) - 1, np.int64), number[index[open_at]])
    order = np.lexsort((after > 0, cuts))
    cuts, after = cuts[order], after[order]
    of_text = pa.array(np.append(0, np.flatnonzero(after == 0) + 1), pa.int32())
    found = pa.ListArray.from_arrays(pa.array(np.append(0, ends[cuts]), pa.int32()), pa.array(flat, pa.int32()))
    return pa.ListArray.from_arrays(of_text, found), pa.ListArray.from_arrays(of_text, pa.array(after, pa.int32()))


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row, as the library of the .tiktoken file gives them.

    ``path`` names the rank file, at the same place on every executor.  Special
    strings are ordinary text.  Null text counts as empty and has no ids;
    repeated rows and null ids stay; other columns are not carried.  An empty
    table gives an empty result.  The words of the table are counted when this
    is called.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_words(rows.select("text"), path))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        shared = _Known(vocabulary.ids, common.value)
        for batch in batches:
            for part in text_slices(batch, 1, SLICE_BYTES):
                pieces = split_texts(part.column(1), path)
                place = shared.places(pieces.distinct)
                starts, lengths = shared.ends[place], shared.ends[place + 1] - shared.ends[place]
                number, words, ids, width = np.zeros(len(place), np.int64), [b""], [shared.ids], len(shared.ids)
                for i in np.flatnonzero(place < 0).tolist():
                    word = pieces.distinct[i]
                    if len(word) > LONG_PIECE:
                        merged = np.array(vocabulary.encode(word), np.int32)
                        starts[i], lengths[i] = width, len(merged)
                        ids.append(merged)
                        width += len(merged)
                    else:
                        starts[i] = lengths[i] = 0
                        number[i] = len(words)
                        words.append(word)
                table = np.concatenate(ids) if len(ids) > 1 else shared.ids
                runs, after = _known_runs(pieces, lengths, starts, table, number)
                one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                        *map(one, (runs, after, _byte_ids(words, path))),
                    ],
                    ["doc_ids", "runs", "after", "words"],
                )

    slices = rows.mapInArrow(
        split,
        f"doc_ids array<{kind}>, runs array<array<array<int>>>, after array<array<int>>, words array<array<int>>",
    )
    coded = with_rank_map(path, lambda ranks: F.transform("words", lambda w: fold_merges(w, ranks)))

    def joined(ids: Column) -> Column:
        """The texts: after each run the ids of the folded piece behind it (word 0 is empty)."""

        def text(runs: Column, i: Column) -> Column:
            behind = lambda after: F.transform(runs, lambda run, k: F.array(run, ids[after[k]]))
            return F.struct(
                F.col("doc_ids")[i].alias("doc_id"), F.flatten(let(F.col("after")[i], behind)).alias("parts")
            )

        return F.transform("runs", text)

    return slices.select(F.inline(let(coded, joined))).select("doc_id", F.flatten("parts").alias("ids"))


def decode(ids: Column, path: str) -> Column:
    """Bytes of an id array: its pieces, concatenated; no ids give no bytes, null gives null."""
    pieces = F.from_json(F.lit(_piece_literal(path)), "array<string>")
    return F.encode(F.array_join(F.transform(ids, lambda i: pieces[i]), ""), "ISO-8859-1")
