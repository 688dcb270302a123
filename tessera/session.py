"""Session and storage helpers.

Library code never creates a session.  These helpers are for tests, the
bench script and command-line runs on a single machine.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int | None = None,
    scratch: str | None = None,
    app_name: str = "tessera",
    event_log: bool = False,
) -> SparkSession:
    """Local-mode session with the UI off and AQE on.

    ``scratch`` is a fresh per-run folder for local spill files (and the
    event log, if asked for).  The checkpoint folder is whatever the
    configuration names in ``spark.checkpoint.dir``; only when it names
    none does this local helper fall back to a folder below ``scratch``.
    """
    if scratch is None:
        scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .config("spark.local.dir", os.path.join(scratch, "local"))
    )
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", os.path.join(scratch, "events")
        )
        os.makedirs(os.path.join(scratch, "events"), exist_ok=True)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None:  # only where the environment names none
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, or None if unset."""
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        spark.sparkContext.setCheckpointDir(path)
        return spark.sparkContext.getCheckpointDir()
    return None


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session that names none gets one of its own."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def delete_tree(spark: SparkSession, path: str) -> None:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df: DataFrame, name: str = "intermediate") -> DataFrame:
    """Cut lineage of a reused intermediate result.

    With a shared checkpoint folder configured (``spark.checkpoint.dir``),
    the result is written there once as a parquet table and read back:
    one job, columnar, and it survives executor loss without recomputing
    its lineage.  Without one the result is computed now and persisted to
    memory and disk; a lost block is then recomputed from lineage.  The returned
    frame owns the table: :func:`release` it when no result reads it any more.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if base is None:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()  # compute now, while whatever it reads is still available
        return out
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.parquet(path)
    out._written_path = path  # owned by this frame object, not by its address
    return out


def owning(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df``, which reads a materialised ``table``; releasing it releases the table."""
    df._owned_table = table
    return df


@contextmanager
def at_least_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs run inside shuffle to ``n`` partitions at least; more that the session asks for stay."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), n)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def committed(spark: SparkSession, path: str) -> bool:
    """True if a Spark write to ``path`` completed (its ``_SUCCESS`` marker exists)."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def release(df: DataFrame) -> None:
    """Drop a materialised intermediate (cached blocks or written table), or the one that ``df`` owns."""
    df = getattr(df, "_owned_table", df)
    path = getattr(df, "_written_path", None)
    if path is None:
        df.unpersist()
        return
    delete_tree(df.sparkSession, path)


def input_fingerprint(df: DataFrame) -> str:
    """Digest of what ``df`` reads: its files with length and change time, or else its rows.

    Files are only listed, not read.  A frame without files (made from local
    rows) is summed up in one pass.
    """
    files = sorted(df.inputFiles())
    if not files:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("h")).first()
        return f"rows {row['n']} {row['h']}"
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256()
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        status = path.getFileSystem(conf).getFileStatus(path)
        digest.update(f"{f} {status.getLen()} {status.getModificationTime()}\n".encode())
    return digest.hexdigest()


def check_state(spark: SparkSession, path: str, about: dict) -> None:
    """Record at ``path`` what a state folder belongs to, or refuse if it belongs to something else."""
    text = json.dumps(about, sort_keys=True, default=str)
    if committed(spark, path):
        if spark.read.text(path).first()["value"] != text:
            raise ValueError(f"the state recorded next to {path} belongs to other input or parameters")
        return
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def scale_settings(
    largest_shuffle_bytes: int,
    total_cores: int,
    partition_bytes: int = 128 * 1024 * 1024,
    split_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Session settings sized so every task's slice fits executor memory.

    The initial shuffle partition count is the largest expected shuffle
    divided by ``partition_bytes`` (at least two waves of tasks); AQE then
    coalesces small partitions toward the same advisory size and splits
    skewed join partitions.  File splits of ``split_bytes`` bound what a scan
    task reads.  Apply with ``SparkSession.builder.config(map=...)`` or
    ``spark.conf.set`` before running the jobs.
    """
    parts = max(2 * total_cores, -(-largest_shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }
