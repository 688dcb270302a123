"""Fill-in-middle transformation, with the cuts found by word-parallel arithmetic.

A text is cut at token borders (a token is a word with the white space before
it, or the white space at the end) into prefix, middle and suffix, and put
together again in another order behind marks.  The borders are found on the
UTF-8 bytes, eight at a time: texts are laid out as little-endian 64-bit words,
one mask per word marks the bytes that end a token, bit counts are summed along
the words, a search in the sums finds the word that holds a token's end, and a
multiplication finds its byte.  Code points are counted by a second mask, so the
texts themselves never leave Spark's own string functions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tessera.llm.bytebpe import text_offsets, text_slices
from tessera.llm.common import text_or_empty, unused

SENTINELS = ("<P>", "<S>", "<M>")
SLICE_BYTES = 8 << 20

_WORD = np.dtype("<u8")
_ONES = np.uint64(0x0101010101010101)
_HIGH = _ONES << np.uint64(7)
_LOW7 = ~_HIGH
_BITS = [np.uint64(i) for i in range(65)]


def _spread(byte: int) -> np.uint64:
    """``byte`` in each of the eight bytes."""
    return np.uint64(byte * 0x0101010101010101)


def space_mask(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that is white space (0x20, 0x09 to 0x0D).

    Sums of two seven-bit numbers stay within their byte, so no carry crosses.
    """
    low = words & _LOW7
    not_blank = (low ^ _spread(0x20)) + _LOW7
    from_tab = low + _spread(0x80 - 0x09)
    past_return = low + _spread(0x80 - 0x0E)
    return (~not_blank | (from_tab & ~past_return)) & ~words & _HIGH


def lead_mask(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that begins a code point (all but 0x80 to 0xBF)."""
    return (~words | (words << _BITS[1])) & _HIGH


def select_byte(mask: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Index of the byte that holds the ``nth`` (from 1) mark of each mask.

    The product has in each byte the number of marks up to it; bytes whose
    number is below ``nth`` lose their high bit in the subtraction.
    """
    upto = (mask >> _BITS[7]) * _ONES
    reached = ((upto | _HIGH) - nth.astype(np.uint64) * _ONES) & _HIGH
    return 8 - np.bitwise_count(reached).astype(np.int64)


_CUTS = StructType()
for _name in ("n", "prefix_chars", "middle_chars"):
    _CUTS = _CUTS.add(_name, LongType())


class Units:
    """Token ends and code points of a batch of texts, as masks over 64-bit words.

    Text i has the words ``first[i]`` up to ``first[i + 1]``; blanks fill its last
    word, at least one.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = text_offsets(texts)
        raw = texts.buffers()[2]
        raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        sizes = np.diff(offsets)
        self.first = np.append(0, np.cumsum(sizes // 8 + 1))
        held = np.full(int(self.first[-1]) * 8, 0x20, np.uint8)
        for at, start, size in zip((self.first[:-1] * 8).tolist(), offsets[:-1].tolist(), sizes.tolist()):
            held[at : at + size] = raw[start : start + size]
        words = held.view(_WORD).astype(np.uint64)

        space = space_mask(words)
        after = (space >> _BITS[8]) | (np.append(space[1:], _HIGH) << _BITS[56])
        self.ends = ~space & after & _HIGH
        last = (self.first[:-1] * 8 + sizes - 1)[sizes > 0]
        last = last[(space[last >> 3] >> (8 * (last & 7) + 7).astype(np.uint64) & _BITS[1]) == 1]
        self.ends[last >> 3] |= _BITS[1] << (8 * (last & 7) + 7).astype(np.uint64)  # white space at the end
        self.leads = lead_mask(words)
        self.ends_before = np.append(0, np.cumsum(np.bitwise_count(self.ends), dtype=np.int64))
        self.leads_before = np.append(0, np.cumsum(np.bitwise_count(self.leads), dtype=np.int64))
        self.n = np.diff(self.ends_before[self.first])

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte place (in the words) after the first ``k`` tokens of each text."""
        target = self.ends_before[self.first[:-1]] + k
        word = np.searchsorted(self.ends_before, target, "left") - 1
        inside = k > 0
        at = self.first[:-1] * 8
        w = word[inside]
        at[inside] = 8 * w + 1 + select_byte(self.ends[w], target[inside] - self.ends_before[w])
        return at

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code points of each text before a byte place."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = self.leads[word] & ((_BITS[1] << (byte << _BITS[3])) - _BITS[1])
        return self.leads_before[word] + np.bitwise_count(below) - self.leads_before[self.first[:-1]]


@F.arrow_udf(returnType=_CUTS)
def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """Tokens of each text, and code points of the prefix and middle that h1 and h2 choose."""
    found = []
    for part in text_slices(pa.RecordBatch.from_arrays([text, h1, h2], ["text", "h1", "h2"]), 0, SLICE_BYTES):
        units = Units(part.column(0))
        a, b = (part.column(i).to_numpy(zero_copy_only=False) % (units.n + 1) for i in (1, 2))
        prefix = units.chars(units.cut(np.minimum(a, b)))
        both = units.chars(units.cut(np.maximum(a, b)))
        found.append((units.n, prefix, both - prefix))
    columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else ((),) * 3)]
    return pa.StructArray.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], _CUTS.names
    )


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
    sentinels: tuple[str, str, str] = SENTINELS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Texts rearranged for fill-in-middle training: the columns of ``docs`` with n, form, prefix_chars, middle_chars and output.

    h1 to h4 are the first four groups of eight hex digits of the SHA-256 of
    ``seed:doc_id``.  A text of n tokens is cut after ``h1 % (n + 1)`` and
    ``h2 % (n + 1)`` tokens, the smaller first.  ``h3 % 100 < percent`` transforms it,
    as spm if ``h4 % 100 < spm_percent`` and else as psm.  Empty texts and texts with
    a mark in them stay plain: output is the text, prefix_chars and middle_chars are
    null.  :func:`restore` gives the text back.

    Null text counts as empty, a null id as the empty string; rows of one id
    draw the same numbers (each for its own text).  Repeated rows get the same
    result.  Columns of ``docs`` with the name of a result column are replaced.
    An empty table gives no rows.
    """
    prefix_mark, suffix_mark, middle_mark = sentinels
    cut = unused(docs, "cut")
    digest = unused(docs, "digest")
    body = text_or_empty(text)

    def h(i: int) -> Column:
        return F.conv(F.substring(F.col(digest), 8 * i - 7, 8), 16, 10).cast("long")

    id_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    drawn = docs.withColumn(digest, F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256))
    drawn = drawn.withColumn(cut, _cuts(body, h(1), h(2)))
    marked = F.lit(False)
    for mark in sentinels:
        marked = marked | body.contains(mark)
    form = (
        F.when((body == "") | marked | (h(3) % 100 >= percent), "plain")
        .when(h(4) % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    p, m = F.col(cut).prefix_chars, F.col(cut).middle_chars
    prefix = F.substring(body, F.lit(1), p.cast("int"))
    middle = F.substring(body, (p + 1).cast("int"), m.cast("int"))
    suffix = F.substring(body, (p + m + 1).cast("int"), F.length(body))
    results = {
        "n": F.col(cut).n,
        "form": F.col(form_name := unused(docs, "chosen")),
        "prefix_chars": F.when(F.col(form_name) != "plain", p),
        "middle_chars": F.when(F.col(form_name) != "plain", m),
        "output": F.when(F.col(form_name) == "plain", body)
        .when(F.col(form_name) == "psm", F.concat(F.lit(prefix_mark), prefix, F.lit(suffix_mark), suffix, F.lit(middle_mark), middle))
        .otherwise(F.concat(F.lit(suffix_mark), suffix, F.lit(prefix_mark), prefix, F.lit(middle_mark), middle)),
    }
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in results]
    return drawn.withColumn(form_name, form).select(*kept, *(c.alias(name) for name, c in results.items()))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of.

    Transformed texts hold no mark of their own and no mark begins within
    another, so the marks found are those put in.
    """
    pieces = F.split(output, "|".join(f"\\Q{mark}\\E" for mark in sentinels), -1)
    return (
        F.when(form == "psm", F.concat(pieces[1], pieces[3], pieces[2]))
        .when(form == "spm", F.concat(pieces[2], pieces[3], pieces[1]))
        .otherwise(output)
    )
