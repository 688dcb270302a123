"""Token counts by compiled finite-state transducers (see ``bytebpe``).

Row-local: each task reads slices of bounded size, splits them with the chunked
splitter transducer and adds up the counts that the piece transducer emits.
No shuffle; a task keeps a bounded cache of compiled states and piece counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bytebpe import begins_by_transducer, split_texts, text_offsets, text_slices, transducer

MAX_PIECES = 400_000


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``path`` names a byte-level BPE .json file, at the same place on every
    executor.  Counts are those of the file's library for the whole text,
    without begin, end or other added tokens; special strings inside a text
    are one token each, the library's default.

    Null text counts as empty: 0 bytes, 0 tokens.  Repeated rows and null ids
    stay as they are; other columns are not carried.  An empty table gives an
    empty result.
    """

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        specials = {s.encode(): 1 for s in machine.vocabulary.specials}
        known = dict(specials)  # counts of pieces met before
        for batch in batches:
            for part in text_slices(batch, 1):
                pieces = split_texts(part.column(1), path, tuple(machine.vocabulary.specials), begins_by_transducer)
                if len(known) > MAX_PIECES:
                    known = dict(specials)
                counts = np.empty(len(pieces.distinct), np.int64)
                for i, piece in enumerate(pieces.distinct):
                    n = known.get(piece)
                    if n is None:
                        n = machine.count(piece)
                        if len(piece) < 64:
                            known[piece] = n
                    counts[i] = n
                sizes = np.diff(text_offsets(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), pa.array(pieces.sums(counts))], ["doc_id", "n_bytes", "n_tokens"]
                )

    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
