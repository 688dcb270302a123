"""Seeded samples without replacement: fixed size, and fixed size per group.

Rows are ranked by a hash of (seed, id), so a sample is reproducible and
independent of partitioning and arrival order.  The default hash is
``xxhash64(seed, id)`` (cheap: one call on the integer id per row);
``hashing="md5"`` ranks by ``md5("<seed>:<id>")`` instead - slower, but
portable, so another engine can draw the very same sample (the registered
queries use it for their SQL checks).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.forum import DEFAULT_LANG_SPREAD
from tessera.session import check_state, committed

DEFAULT_SEED = 42
HASHES = ("xxhash64", "md5")


def sample_key(id_col: str = "id", seed: int = DEFAULT_SEED, hashing: str = "xxhash64") -> Column:
    if hashing == "xxhash64":
        return F.xxhash64(F.lit(seed), F.col(id_col))
    if hashing == "md5":
        return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    raise ValueError(f"hashing must be one of {HASHES}")


def sample_fixed(
    df: DataFrame, n: int, seed: int = DEFAULT_SEED, id_col: str = "id", hashing: str = "xxhash64"
) -> DataFrame:
    """Exactly ``min(n, count)`` rows.

    Planned as TakeOrderedAndProject: every task keeps its ``n`` best rows,
    so only ``n`` rows per task travel.
    """
    return df.orderBy(sample_key(id_col, seed, hashing), F.col(id_col)).limit(n)


def sample_per_group(
    df: DataFrame,
    group_col: str,
    k: int,
    seed: int = DEFAULT_SEED,
    id_col: str = "id",
    hashing: str = "xxhash64",
) -> DataFrame:
    """Up to ``k`` rows of every group, adds ``sample_rank`` (1..k).

    The rank filter is planned as a WindowGroupLimit below the shuffle, so
    a group of any size sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(group_col).orderBy(sample_key(id_col, seed, hashing), F.col(id_col))
    return df.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)


def group_sketch(
    df: DataFrame,
    group_col: str,
    k: int,
    seed: int = DEFAULT_SEED,
    id_col: str = "id",
    hashing: str = "xxhash64",
) -> DataFrame:
    """The ``k`` rows of every group that :func:`sample_per_group` draws, with their ``sample_key``.

    Sketches made with the same parameters can be merged (:func:`merge_sketches`)
    and cut to any smaller number of rows, without the rows they were made from.
    """
    keyed = df.withColumn("sample_key", sample_key(id_col, seed, hashing))
    return _lowest(keyed, group_col, k, id_col).drop("sample_rank")


def _lowest(keyed: DataFrame, group_col: str, k: int, id_col: str) -> DataFrame:
    w = Window.partitionBy(group_col).orderBy("sample_key", id_col)
    return keyed.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= k)


def merge_sketches(a: DataFrame, b: DataFrame, group_col: str, k: int, id_col: str = "id") -> DataFrame:
    """The sketch of all rows behind two sketches: the ``k`` lowest keys of each group."""
    return _lowest(a.unionByName(b), group_col, k, id_col).drop("sample_rank")


def sketch_sample(sketch: DataFrame, group_col: str, k: int, id_col: str = "id") -> DataFrame:
    """Up to ``k`` rows of every group with ``sample_rank``, as :func:`sample_per_group` of all rows behind the sketch."""
    return _lowest(sketch, group_col, k, id_col).drop("sample_key")


class SketchStore:
    """A sketch kept in a folder and extended batch by batch.

    Each batch is reduced to its own sketch, merged with the stored one and
    written as the next version; earlier batches are not read again.  A batch
    has a name: adding it again changes nothing, so a failed run can be repeated.
    Versions are whole once their batch list, written last, is there.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        group_col: str,
        k: int,
        seed: int = DEFAULT_SEED,
        id_col: str = "id",
        hashing: str = "xxhash64",
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.group_col, self.k, self.seed, self.id_col, self.hashing = group_col, k, seed, id_col, hashing
        about = {"group": group_col, "k": k, "seed": seed, "id": id_col, "hash": hashing}
        check_state(spark, f"{self.path}/about", about)

    def _version(self) -> int:
        n = 0
        while committed(self.spark, f"{self.path}/batches-{n + 1}"):
            n += 1
        return n

    def batches(self) -> list[str]:
        """Names of the batches the sketch holds, in order."""
        n = self._version()
        return json.loads(self.spark.read.text(f"{self.path}/batches-{n}").first()[0]) if n else []

    def sketch(self) -> DataFrame:
        n = self._version()
        if not n:
            raise ValueError(f"no batch was added to {self.path}")
        return self.spark.read.parquet(f"{self.path}/sketch-{n}")

    def add(self, batch: DataFrame, name: str) -> None:
        """Merge a batch into the stored sketch, unless one of that name is in it."""
        n, names = self._version(), self.batches()
        if name in names:
            return
        new = group_sketch(batch, self.group_col, self.k, self.seed, self.id_col, self.hashing)
        if n:
            new = merge_sketches(self.sketch(), new, self.group_col, self.k, self.id_col)
        new.write.mode("overwrite").parquet(f"{self.path}/sketch-{n + 1}")
        listed = self.spark.createDataFrame([(json.dumps([*names, name]),)], "value string")
        listed.coalesce(1).write.mode("overwrite").text(f"{self.path}/batches-{n + 1}")

    def sample(self, k: int | None = None) -> DataFrame:
        """Up to ``k`` (at most the sketch's) rows of every group of all batches."""
        if k is not None and k > self.k:
            raise ValueError(f"the sketch keeps {self.k} rows of a group")
        return sketch_sample(self.sketch(), self.group_col, k or self.k, self.id_col)


def _unit_uniform(h: Column) -> Column:
    """A 64-bit hash mapped to a uniform double strictly inside (0, 1)."""
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(2**53)


def _copy_uniform(seed: int, hashing: str) -> Column:
    """Uniform in (0, 1) for copy ``j`` of point ``(x, y)``."""
    if hashing == "xxhash64":
        return _unit_uniform(F.xxhash64(F.lit(seed), F.col("x"), F.col("y"), F.col("j")))
    if hashing == "md5":
        text = F.concat_ws(":", F.lit(str(seed)), F.col("x"), F.col("y"), F.col("j"))
        digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")  # 52 bits
        return (digits.cast("double") + 0.5) / float(2**52)
    raise ValueError(f"hashing must be one of {HASHES}")


def sample_weighted(
    weighted: DataFrame,
    group_col: str | None,
    k: int,
    seed: int = DEFAULT_SEED,
    hashing: str = "xxhash64",
) -> DataFrame:
    """Up to ``k`` copies per group from weighted rows ``x, y, n``, as rows
    ``x, y, sample_rank`` - uniform without replacement over the multiset.

    Every copy of every point conceptually gets an independent uniform key
    and the ``k`` smallest keys of a group win.  Only a point's ``min(n, k)``
    smallest keys can matter, and those are generated directly as order
    statistics: ``1 - U(j) = prod_{i<=j} V_i ** (1 / (n - i + 1))`` with
    ``V_i`` hashed from (seed, x, y, i) (``xxhash64``, or the first 52
    bits of ``md5("seed:x:y:i")`` for other engines).  So the sample reads
    only the weighted table (bounded by the number of distinct points),
    never the per-row vectors.  ``group_col=None`` samples ``k`` from
    everything.
    """
    m = F.least(F.col("n"), F.lit(k)).cast("int")
    copies = weighted.select("x", "y", "n", F.explode(F.sequence(F.lit(1), m)).alias("j"))
    v = _copy_uniform(seed, hashing)
    step = F.log(v) / (F.col("n") - F.col("j") + 1).cast("double")
    # copies of one point: at most k rows per window partition
    within = Window.partitionBy("x", "y").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    keyed = copies.select("x", "y", "j", (-F.sum(step).over(within)).alias("key"))
    order = [F.col("key"), F.col("x"), F.col("y"), F.col("j")]
    if group_col is None:
        # TakeOrderedAndProject keeps k rows per task; the numbering window
        # then sees at most k rows
        top = keyed.orderBy(*order).limit(k)
        ranked = top.withColumn("sample_rank", F.row_number().over(Window.orderBy(*order)))
        return ranked.select("x", "y", "sample_rank")
    w = Window.partitionBy(group_col).orderBy(*order)
    ranked = keyed.withColumn("sample_rank", F.row_number().over(w))
    return ranked.where(F.col("sample_rank") <= k).select("x", "y", "sample_rank")


def sample_vectors(
    vectors: DataFrame,
    n_languages: int,
    kernels: int,
    lang_spread: int = DEFAULT_LANG_SPREAD,
    seed: int = DEFAULT_SEED,
    hashing: str = "xxhash64",
) -> DataFrame:
    """Initial k-means centroids ``cluster, x, y`` (``kernels`` rows).

    With a spread of 500 or more, ``kernels / n_languages`` vectors are
    drawn from every language (column ``x``); otherwise ``kernels`` vectors
    from the whole space.  Clusters are numbered by (x, rank).  Fails
    unless exactly ``kernels`` centroids come out.  Raw vectors (with
    ``id``) are ranked by the id hash; weighted rows ``x, y, n`` are
    sampled by :func:`sample_weighted`.
    """
    if n_languages <= 0 or kernels % n_languages != 0:
        raise ValueError("kernels must be a positive multiple of the number of languages")
    per_lang = kernels // n_languages
    if "n" in vectors.columns and "id" not in vectors.columns:
        if lang_spread < 500:
            picked = sample_weighted(vectors, None, kernels, seed, hashing)
        else:
            picked = sample_weighted(vectors, "x", per_lang, seed, hashing)
    elif lang_spread < 500:
        picked = sample_fixed(vectors, kernels, seed, hashing=hashing).withColumn(
            "sample_rank", F.row_number().over(Window.orderBy(sample_key("id", seed, hashing), "id"))
        )
    else:
        picked = sample_per_group(vectors, "x", per_lang, seed, hashing=hashing)
    # at most `kernels` rows reach this single-partition numbering window
    out = picked.select(
        (F.row_number().over(Window.orderBy("x", "sample_rank")) - 1).cast("int").alias("cluster"),
        "x",
        "y",
    )
    return out


def collect_centroids(centroids: DataFrame, kernels: int) -> list[tuple[int, int]]:
    """Bring at most ``kernels`` centroid rows to the driver, checked."""
    rows = centroids.orderBy("cluster").limit(kernels + 1).collect()
    if len(rows) != kernels:
        raise ValueError(
            f"expected {kernels} initial centroids, got {len(rows)}: "
            "every language needs at least kernels / languages vectors"
        )
    return [(int(r["x"]), int(r["y"])) for r in rows]
