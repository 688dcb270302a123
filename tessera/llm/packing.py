"""Packing along a space-filling curve.

Each document becomes token ids and a hashed token vector, projected to three
dimensions; the Hilbert key of that point orders the corpus.  Documents are
laid end to end along the curve and cut every ``length`` tokens, so neighbours
share sequences and no sequence but the last is short.  The rest is cut into
sequences of powers of two, which need no padding.

Token ids are written once, as a table.  Only (row, key, count) is range-sorted:
a running sum within each range and one total per range (one number per
partition on the driver) give every document its place on the curve, which is
joined back to its ids by row.  A key that a third of all documents share is
split by the row number that breaks ties.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytebpe import byte_letters, split_texts, text_slices
from tessera.llm.common import drop_stored, stored

HASHED_DIMS = 256
CURVE_BITS = 10
SPREAD = 0.5  # projected means beyond this are put on the border
MAX_PIECES = 250_000
SLICE_BYTES = 4 << 20


# ------------------------------------------------------------- the curve ----


def hilbert_key(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (n, d), each below 2**bits.

    Works down the bits: each bit of a coordinate that is set inverts the lower
    bits of the first one, each that is not swaps them with the first one's;
    the Gray code of what results, bits interleaved, is the key.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(d):
            is_set = (x[i] & bit) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    fix = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        fix ^= np.where(x[d - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= fix
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@lru_cache(1)
def _projection(n_ids: int) -> np.ndarray:
    """Row of each token id: its hashed dimension's signs in the three projected ones."""
    ids = np.arange(n_ids, dtype=np.uint64)
    with np.errstate(over="ignore"):
        dims = ((ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(HASHED_DIMS)
    signs = np.random.default_rng(7).integers(0, 2, (HASHED_DIMS, 3)) * 2 - 1
    return signs[dims.astype(np.int64)].astype(np.int32)


# --------------------------------------------------------------- tokens ----


class PieceEncoder:
    """Ids of distinct pieces by the library's model, with those met before in a bounded cache.

    The model takes a piece as the stand-in letters of its bytes, in the
    task's own thread: the library's batches would start a thread per core.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.model, self.specials, self.n_ids = tokenizer.model, tuple(added), tokenizer.get_vocab_size()
        self.added = {content.encode(): array("i", [i]).tobytes() for content, i in added.items()}
        self.letters = str.maketrans({chr(b): letter for letter, b in byte_letters().items()})
        self.path, self.known = path, dict(self.added)

    def _ids(self, piece: bytes) -> bytes:
        tokens = self.model.tokenize(piece.decode("latin-1").translate(self.letters))
        return array("i", [t.id for t in tokens]).tobytes()

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text, each with ``end_id`` after it."""
        pieces = split_texts(texts, self.path, self.specials)
        if len(self.known) > MAX_PIECES:
            self.known = dict(self.added)
        known, rows = self.known, []
        for p in pieces.distinct:
            row = known.get(p)
            if row is None:
                row = known[p] = self._ids(p)
            rows.append(row)
        rows.append(array("i", [end_id]).tobytes())
        ends = np.append(0, np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) // 4))
        each = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))
        index = np.insert(pieces.index.astype(np.int32), pieces.docs[1:], len(rows) - 1)
        runs = each.take(pa.array(index))
        docs = pieces.docs + np.arange(len(pieces.docs))
        return runs.flatten().to_numpy(), runs.offsets.to_numpy()[docs]


@lru_cache(2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, key, n, ids): curve key, token count and little-endian ids (two or four bytes each)."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        signs = _projection(max(encoder.n_ids, end_id + 1))
        small = np.dtype("<u2" if len(signs) <= 1 << 16 else "<u4")
        for batch in batches:
            for part in text_slices(batch, 1, SLICE_BYTES):
                ids, at = encoder.encode(part.column(1), end_id)
                n = np.diff(at)
                sums = np.stack([np.diff(np.append(0, np.cumsum(signs[ids, d], dtype=np.int64))[at]) for d in range(3)], 1)
                side = 1 << CURVE_BITS
                spot = np.clip((sums / n[:, None] / SPREAD + 1) / 2 * side, 0, side - 1).astype(np.int64)
                raw = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(n),
                    [None, pa.py_buffer((at * small.itemsize).astype(np.int64)), pa.py_buffer(ids.astype(small).tobytes())],
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(hilbert_key(spot)), pa.array(n), raw], ["doc_id", "key", "n", "ids"]
                )

    return rows.mapInArrow(encode, f"doc_id {kind}, key long, n long, ids binary")


# -------------------------------------------------------------- packing ----


def tail_cuts(total: int, length: int) -> list[int]:
    """Where the last sequences begin: full ones end, then powers of two, largest first."""
    at, rest = total - total % length, total % length
    cuts = []
    while rest:
        cuts.append(at)
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
    return cuts


def pack(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most ``length`` tokens.

    One row per piece: doc_id, start (ids of its document before it), n (its
    length), ids (binary, little-endian unsigned 32-bit), doc_tokens, and
    sequence_id and offset (its place there, without gaps from 0).  Every
    sequence has ``length`` tokens, but for the last ones, whose lengths are
    distinct powers of two.

    Null text counts as empty: a document of ``end_id`` alone.  Repeated rows
    and null ids are documents like any other; other columns are not carried.
    Ties of the curve key are broken by row.  An empty table gives no rows.
    """
    renamed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    tokens = stored(
        tokenized(renamed, path, end_id).select(F.monotonically_increasing_id().alias("row"), "*"), "tokens"
    )
    ranged = tokens.select("row", "key", "n").repartitionByRange("key", "row")
    curve = stored(ranged.withColumn("part", F.spark_partition_id()), "curve")
    totals = sorted(curve.groupBy("part").agg(F.sum("n")).collect())  # one row per partition
    bases, total = [], 0
    for part, n in totals:
        bases.append((part, total))
        total += n
    base = curve.sparkSession.createDataFrame(bases, "part int, base long")
    along = Window.partitionBy("part").orderBy("key", "row")
    places = curve.withColumn("end", F.sum("n").over(along)).join(F.broadcast(base), "part")
    places = stored(places.select("row", (F.col("base") + F.col("end") - F.col("n")).alias("at")), "places")
    drop_stored(curve)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    cuts = tail_cuts(total, length)
    first_tail = total - total % length
    wide = "<u2"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in batches:
            rows: list[tuple[int, int, int, bytes, int, int]] = []
            for d, (raw, n, at) in enumerate(zip(*(batch.column(c) for c in ("ids", "n", "at")))):
                raw, n, at = raw.as_py(), n.as_py(), at.as_py()
                ids = np.frombuffer(raw, wide if len(raw) == 2 * n else "<u4").astype("<u4")
                done = 0
                while done < n:
                    here = at + done
                    if here < first_tail:
                        seq, off = divmod(here, length)
                        stop = length - off
                    else:
                        k = bisect_right(cuts, here) - 1
                        seq, off = first_tail // length + k, here - cuts[k]
                        stop = (cuts[k + 1] if k + 1 < len(cuts) else total) - here
                    take = min(stop, n - done)
                    rows.append((d, done, take, ids[done : done + take].tobytes(), seq, off))
                    done += take
            cols = list(zip(*rows)) if rows else [()] * 6
            which = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(which),
                    pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.binary()),
                    batch.column("n").take(which),
                    pa.array(cols[4], pa.int64()),
                    pa.array(cols[5], pa.int64()),
                ],
                ["doc_id", "start", "n", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return (
        tokens.select("row", "doc_id", "n", "ids")
        .join(places, "row")
        .mapInArrow(
            cut,
            f"doc_id {kind}, start long, n long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    )
