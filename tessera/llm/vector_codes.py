"""Vector codes: integer codebooks per part, searched in the Walsh-Hadamard domain.

Vectors become integers and are cut into equal parts; each part position has a
codebook that a fixed number of rounds adapts to the table (assign every part
to its nearest entry, then move each entry to the mean of its parts).  The
nearest entry is found without floating point: parts and entries are padded with
zeros to a power of two and transformed by the integer Walsh-Hadamard transform,
which scales squared distances by that power.  Scaled squared differences are
summed coefficient by coefficient in sequency order; an entry whose sum so far is
above a complete distance is out, as sums only grow.

Each round is one pass over the stored integer table.  A task returns one sum
per entry component; the driver holds the codebooks, which are as large as
``entries`` vectors whatever the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_stored, join_per_key, stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK_ROWS = 512

Books = list[list[list[int]]]


class Compressed(NamedTuple):
    """``codes`` has a row per kept vector; ``codebooks`` are the final entries: part, entry, component."""

    codes: DataFrame
    codebooks: Books


# ------------------------------------------------------------ the search ----


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix of a power of two, by their number of sign changes.

    The row with s changes is the bit-reversed Gray code of s.
    """
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum(((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)) if bits else gray


def walsh(parts: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, zero-padded to a power of two, in sequency order."""
    n, width = parts.shape
    size = 1 << max(width - 1, 0).bit_length()
    x = np.zeros((n, size), parts.dtype)
    x[:, :width] = parts
    half = 1
    while half < size:
        pairs = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
        half *= 2
    return x[:, sequency_order(size)]


def exact_type(most: int, width: int) -> type:
    """Smallest integer type that holds scaled squared distances of components up to ``most``; else Python's integers."""
    size = 1 << max(width - 1, 0).bit_length()
    bound = size * width * (2 * most) ** 2
    return np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (ties to the lower) and the squared distance."""
    t, e = walsh(parts), walsh(entries)
    size = t.shape[1]
    step = max(size // 4, 1)
    sums = np.zeros((len(t), len(e)), t.dtype)
    at = 0
    while at < size:  # all entries, until the sums leave few
        for c in range(at, at + step):
            d = t[:, c, None] - e[None, :, c]
            sums += d * d
        at += step
        likely = sums.argmin(1)
        complete = ((t - e[likely]) ** 2).sum(1)
        left = sums <= complete[:, None]
        if 4 * np.count_nonzero(left) < left.size:
            break
    row, entry = np.nonzero(left)
    d2 = sums[row, entry]
    for c in range(at, size):  # only the entries that are left
        d = t[row, c] - e[entry, c]
        d2 = d2 + d * d
        stay = d2 <= complete[row]
        row, entry, d2 = row[stay], entry[stay], d2[stay]
    first = np.searchsorted(row, np.arange(len(t)))
    least = np.minimum.reduceat(d2, first) if len(t) else d2
    best = np.nonzero(d2 == least[row])[0]
    best = best[np.searchsorted(row[best], np.arange(len(t)))]  # entries ascend within a row
    return entry[best], d2[best] // size


# ------------------------------------------------------------ the passes ----


def _blocks(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of rows of a list column as integers (rows, parts, width), zero-padded at the end."""
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        lists = batch.column(column).slice(at, BLOCK_ROWS)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        rows = values.reshape(len(lists), len(values) // len(lists))
        padded = np.zeros((len(lists), PARTS * width), np.int64)
        padded[:, : rows.shape[1]] = rows
        yield at, padded.reshape(len(lists), PARTS, width)


def _search(block: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nearest entries and distances for each part position of a block."""
    most = max([0, *(abs(int(f())) for a in (block, *books) if a.size for f in (a.max, a.min))])
    kind = exact_type(most, block.shape[2])
    for p, book in enumerate(books):
        yield nearest(block[:, p].astype(kind), book.astype(kind))


def _entry_sums(vectors: DataFrame, books: Books, width: int) -> DataFrame:
    """Sum (high * 2**32 + low) and number of the parts nearest to each entry, by part, entry and component."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.array(b, object).reshape(len(b), width) for b in books]
        total = [np.zeros(b.shape, object) for b in held]
        n = [np.zeros(len(b), np.int64) for b in held]
        for batch in batches:
            for _, block in _blocks(batch, "ints", width):
                for p, (entry, _d2) in enumerate(_search(block, held)):
                    order = np.argsort(entry, kind="stable")
                    used, first = np.unique(entry[order], return_index=True)
                    parts = block[order, p]
                    if abs(parts).max(initial=0) >= 1 << 52:  # a block's sum might not fit
                        parts = parts.astype(object)
                    total[p][used] += np.add.reduceat(parts, first, axis=0).astype(object)
                    n[p] += np.bincount(entry, minlength=len(n[p]))
        for p in range(PARTS):
            rows = [
                (p, int(e), c, int(total[p][e, c]) >> 32, int(total[p][e, c]) & 0xFFFFFFFF, int(n[p][e]))
                for e in np.nonzero(n[p])[0]
                for c in range(width)
            ]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int32()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "entry", "pos", "high", "low", "n"]
            )

    found = vectors.select("ints").mapInArrow(sums, "part int, entry int, pos int, high long, low long, n long")
    return found.groupBy("part", "entry", "pos").agg(F.sum("high"), F.sum("low"), F.sum("n"))


def _moved(vectors: DataFrame, books: Books, width: int) -> Books:
    """Each entry at the floor of the mean of its parts; unused entries stay."""
    out = [[list(entry) for entry in book] for book in books]
    for p, e, c, high, low, n in _entry_sums(vectors, books, width).collect():  # one row per entry component
        out[p][e][c] = ((high << 32) + low) // n
    return out


def _coded(vectors: DataFrame, books: Books, width: int) -> DataFrame:
    """Columns of ``vectors`` but ints, with code (array) and error."""
    fields = [f for f in vectors.schema.fields if f.name != "ints"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.array(b, object).reshape(len(b), width) for b in books]
        for batch in batches:
            codes, errors = [], []
            for _, block in _blocks(batch, "ints", width):
                found = list(_search(block, held))
                codes.extend(np.stack([entry for entry, _ in found], 1).tolist())
                total = sum(d2.astype(object) for _, d2 in found)
                errors.extend(min(int(d), (1 << 63) - 1) for d in total)
            columns = [batch.column(f.name) for f in fields]
            columns += [pa.array(codes, pa.list_(pa.int32())), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in fields), "code", "error"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return vectors.mapInArrow(code, f"{kept}, code array<int>, error long")


def integers(vector: Column) -> Column:
    """Components as integers ``floor(SCALE * x)``, saturating at 64 bits; null if the vector has none for some component."""
    doubles = vector.cast("array<double>")
    whole = F.forall(doubles, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    most = float(1 << 62)
    return F.when(
        whole, F.transform(doubles, lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(most)), F.lit(-most))))
    )


def compress(
    vectors: DataFrame,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> Compressed:
    """Codes of all vectors, and the codebooks.

    ``codes`` has vec_id, label, code (an array with the entry of each of the
    ``PARTS`` parts), error (squared distance to the entries) and label_error (error
    summed over the rows of the label; nulls are one label).  The codebooks begin
    as the parts of the ``entries`` smallest vec_ids.

    Dropped are null vectors, vectors with a null or non-finite component, and
    vectors of another length than most of the table (of equally common lengths the
    longest stays).  Lengths that are no multiple of ``PARTS`` are padded with zeros.
    Null ids come last; repeated rows and ids are vectors like any other, in the
    order of their components.  Components beyond 2**62 / ``SCALE`` are cut to it,
    errors beyond 64 bits to the largest long.  An empty table gives no rows and
    empty codebooks.
    """
    plain = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), integers(F.col(embedding)).alias("ints")
    )
    table = stored(plain.filter("ints IS NOT NULL"), "vectors")
    lengths = table.groupBy(F.size("ints").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    width = -(-dim // PARTS)
    kept = table.filter(F.size("ints") == dim)
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    padded = [[*r.ints, *[0] * (PARTS * width - dim)] for r in start]
    books: Books = [[v[p * width : (p + 1) * width] for v in padded] for p in range(PARTS)]
    for _ in range(rounds if padded else 0):
        books = _moved(kept, books, width)
    coded = stored(_coded(kept, books, width), "codes")
    drop_stored(table)
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    by_label = by_label.select("label", F.least("total", F.lit((1 << 63) - 1)).cast("long").alias("label_error"))
    salt = F.xxhash64("vec_id", "error")
    return Compressed(join_per_key(coded, stored(by_label, "label-errors"), "label", salt), books)


def code_text(code: Column) -> Column:
    """Two lower-case hex digits per part."""
    return F.array_join(F.transform(code, lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")


def books_sha256(books: Books) -> str:
    """SHA-256 of all components by part, entry and place, as decimals with commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
