"""Line dedup: levelled sorted runs of line hashes.

A *run* holds one row per line key of its batches: the key and in how many
documents it was found, with the largest document id if it is a single batch.  Runs are bucketed by key and sorted within the buckets,
with as many buckets as the session has shuffle partitions.  Each batch of
documents adds one run at level 0; when a level holds ``FANOUT`` runs they are
merged into one run of the next level, so that a key is rewritten only a
logarithmic number of times.  ``novel`` merge-anti-joins a batch with all runs:
its keys were not seen before, so this batch holds the line that stays, and its
largest document id with that key is written as the key's keeper.  Batches come
in descending order of document ids, so that the keeper is the largest of all.
Neither a merge nor an anti-join moves a run: bucket meets bucket.

The runs of a folder are listed in a manifest, a small numbered table that is
written after the tables it names; ``LineRuns.open`` goes on from the last one.

Keys are 128-bit hashes of the normalised line, so buckets are balanced whatever
the lines are.  A batch is counted per key before any shuffle; a line that
stands in a third of all documents is one row per task.  What to drop is looked
up by a broadcast of the repeated keys if these are measured as small, else with
the rows of a key dealt over salted parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WS, content_keys, drop_stored, join_per_key, new_path, stored, unused
from tessera.session import delete_tree

FANOUT = 2
_KEY = ["k1", "k2"]


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """16-byte key of a line, or None if the stripped line is shorter than ``min_chars``."""
    key = line.strip(WS.encode()).lower()  # bytes.lower() changes A-Z only
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, c1, c2, k1, k2): each distinct long enough line key of each document, with the document's content key."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, t in enumerate(batch.column(3)):
                found = {line_key(x, min_chars) for x in (t.as_py() or "").encode().split(b"\n")}
                found.discard(None)
                rows += [i] * len(found)
                out += found
            both = pa.array(out, pa.binary(16)).buffers()[1] if out else pa.py_buffer(b"")
            halves = pa.Array.from_buffers(pa.int64(), 2 * len(out), [None, both]).to_numpy()
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(of) for c in range(3)), pa.array(halves[::2]), pa.array(halves[1::2])],
                ["doc_id", "c1", "c2", *_KEY],
            )

    c1, c2 = content_keys(doc_id, F.col(text))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), c1.alias("c1"), c2.alias("c2"), F.col(text).alias("text"))
    return rows.mapInArrow(keys, "doc_id long, c1 long, c2 long, k1 long, k2 long")


def _unseen(keys: DataFrame, runs: list[DataFrame]) -> DataFrame:
    for run in runs:
        keys = keys.join(run.select(*_KEY).hint("merge"), _KEY, "left_anti")
    return keys


class LineRuns:
    """Levels of sorted runs, and the keepers of the batches, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, path: str | None = None):
        self.spark, self.fanout = spark, fanout
        self.path = path or new_path(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.kept: list[str] = []
        self.version = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineRuns:
        """The runs of a folder as of its last complete manifest."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-*/_SUCCESS")
        found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(folder)
        versions = [int(f.getPath().getParent().getName().split("-")[1]) for f in found]
        if not versions:
            raise ValueError(f"no line runs in {path}")
        about = json.loads(spark.read.text(f"{path}/manifest-{max(versions)}").first()[0])
        runs = cls(spark, about["fanout"], path)
        runs.buckets, runs.levels, runs.kept, runs.version = about["buckets"], about["levels"], about["kept"], max(versions)
        return runs

    def _commit(self) -> None:
        """Write the next manifest; only what it names counts."""
        self.version += 1
        about = {"fanout": self.fanout, "buckets": self.buckets, "levels": self.levels, "kept": self.kept}
        line = self.spark.range(1).select(F.lit(json.dumps(about)).alias("value"))
        line.write.text(f"{self.path}/manifest-{self.version}")

    def _run(self, name: str) -> DataFrame:
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(_KEY)
            self.spark.sql(
                f"CREATE TABLE {name} (k1 BIGINT, k2 BIGINT, n BIGINT, top BIGINT) USING parquet CLUSTERED BY ({columns}) "
                f"SORTED BY ({columns}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'"
            )
        return self.spark.table(name)

    def runs(self) -> list[DataFrame]:
        return [self._run(name) for level in self.levels for name in level]

    def _write(self, counted: DataFrame, level: int) -> str:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        sorted_run = counted.write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY)
        sorted_run.format("parquet").option("path", f"{self.path}/{name}").saveAsTable(name)
        self.levels[level].append(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_tree(self.spark, f"{self.path}/{name}")

    def novel(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` whose key is in no run: merge-anti-joins, one run after the other."""
        return _unseen(keys, self.runs())

    def add(self, keys: DataFrame) -> None:
        """Add the run of a batch (rows doc_id, k1, k2; one per document and key) and the keepers of its novel keys."""
        older = self.runs()
        own = self._run(self._write(keys.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("top")), 0))
        # read back, so that the anti-joins take counted keys: Spark would push them below the count
        keepers = f"keepers-{uuid.uuid4().hex}"
        novel = _unseen(own, older).select(*_KEY, F.col("top").alias("keep_id"))
        novel.write.parquet(f"{self.path}/{keepers}")
        self.kept.append(keepers)
        level, merged = 0, []
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged([self._run(name) for name in full]), level + 1)
            merged += full
            level += 1
        self._commit()
        for name in merged:
            self._drop(name)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            joined = a.join(b.select(*_KEY, F.col("n").alias("more")).hint("merge"), _KEY, "full")
            return joined.select(*_KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))

        return reduce(both, runs).select(*_KEY, "n").withColumn("top", F.lit(None).cast("long"))

    def repeated(self, min_docs: int) -> DataFrame:
        """(k1, k2, keep_id) of the keys found in at least ``min_docs`` documents."""
        if not self.kept:
            return self.spark.createDataFrame([], "k1 long, k2 long, keep_id long")
        often = self._merged(self.runs()).filter(F.col("n") >= min_docs).select(*_KEY)
        keepers = self.spark.read.schema("k1 long, k2 long, keep_id long").parquet(*(f"{self.path}/{k}" for k in self.kept))
        return often.join(keepers, _KEY)

    def drop(self) -> None:
        """Delete the folder."""
        for level in self.levels:
            for name in level:
                self._drop(name)
        delete_tree(self.spark, self.path)


def _ranges(low: int | None, high: int | None, n: int) -> list[tuple[int, int]]:
    """Up to ``n`` ranges of equal width that cover low..high, in descending order."""
    if low is None:
        return []
    width = -(-(high - low + 1) // n)
    return [(max(low, top - width + 1), top) for top in range(high, low - 1, -width)]


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Remove lines that many documents share.

    Returns the columns of ``docs`` with the lines removed from ``text``, and
    n_lines (before), n_dropped.  A line is dropped if its key has at least
    ``min_chars`` code points and stands in at least ``min_docs`` documents,
    except in the document(s) of the largest id that hold it.

    Ids are integers.  Null text is one empty line and becomes empty text.  Rows
    are documents: a repeated row counts again, and rows that share an id are
    judged alike.  A
    null id counts as the smallest: its lines go if the key also stands under
    another id, and stay if only null ids hold it.  Input columns named
    n_lines or n_dropped are replaced.  An empty table stays empty.
    """
    spark = docs.sparkSession
    keys = stored(line_keys(docs, min_chars, doc_id, text), "line-keys")
    low, high, without_id = keys.agg(F.min("doc_id"), F.max("doc_id"), F.count_if(F.isnull("doc_id"))).first()
    runs = LineRuns(spark)
    # equal ranges of ids, the largest first; null ids, which count as the smallest, come last
    for bounds in _ranges(low, high, batches):
        runs.add(keys.filter(F.col("doc_id").between(*bounds)))
    if without_id:
        runs.add(keys.filter(F.col("doc_id").isNull()))
    repeated = stored(runs.repeated(min_docs).select(F.struct(*_KEY).alias("k"), "keep_id", F.lit(True).alias("often")), "line-often")
    found = join_per_key(keys.withColumn("k", F.struct(*_KEY)), repeated, "k", F.xxhash64("c1", "c2"))
    gone = found.filter(F.col("often") & ~F.col("keep_id").eqNullSafe(F.col("doc_id")))
    dropped, own_text, g1_name, g2_name = (unused(docs, n) for n in ("dropped", "own_text", "g1", "g2"))
    c1_name, c2_name = (unused(docs, n) for n in ("own_c1", "own_c2"))
    # documents of equal id and text are one group: they lose the same lines
    per_doc = stored(
        gone.groupBy(F.col("c1").alias(c1_name), F.col("c2").alias(c2_name)).agg(F.collect_set("k").alias(dropped)),
        "line-drops",
    )
    for table in (keys, repeated):
        drop_stored(table)
    runs.drop()

    rest = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema)
    c1, c2 = content_keys(doc_id, F.col(text))
    joined = docs.select(*rest, text).join(per_doc, (c1 == F.col(c1_name)) & (c2 == F.col(c2_name)), "left")
    joined = joined.select(
        *rest, F.col(text).alias(own_text), F.col(dropped).k1.alias(g1_name), F.col(dropped).k2.alias(g2_name)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for t, g1, g2 in zip(*(batch.column(n) for n in (own_text, g1_name, g2_name))):
                t = t.as_py() or ""
                if not g1.is_valid:
                    texts.append(t)
                    n_lines.append(t.count("\n") + 1)
                    n_dropped.append(0)
                    continue
                pairs = pa.array([v for p in zip(g1.as_py(), g2.as_py()) for v in p], pa.int64())
                raw = pairs.buffers()[1].to_pybytes()
                gone = {raw[i : i + 16] for i in range(0, 8 * len(pairs), 16)}
                lines = t.encode().split(b"\n")
                kept = [x for x in lines if line_key(x, min_chars) not in gone]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            cols = [batch.column(n) for n in batch.schema.names if n not in (own_text, g1_name, g2_name)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*rest, text, "n_lines", "n_dropped"],
            )

    return joined.mapInArrow(cut, f"{fields}, `{text}` string, n_lines long, n_dropped long").select(
        *[c for c in docs.columns if c in rest or c == text], "n_lines", "n_dropped"
    )
