"""Session set-up, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

# Spark's default size of a scan split.
SPLIT_BYTES = 128 * 1024 * 1024


def build_session(app: str = "chatweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides them.

    Shuffle partitions are left to the caller: AQE merges small ones, and a
    cluster wants a far higher start value than a laptop.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.compress": "true",
        # Files of a lineage cut go when nothing refers to it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster
    a missing setting is an error, as a machine-local folder dies with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="chatweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder, in whatever file system it is; nothing may read it any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so later reads see the same rows
    in the same partitions even after executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Arrow batches of about ``size`` bytes at most in what is run inside, as a worker and its executor hold
    one or two for each task, and more in passing. A limit that the session has set holds instead."""
    if BATCH_CONF in spark.conf.getAll:
        yield
        return
    spark.conf.set(BATCH_CONF, size)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_CONF)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small input over the cores before CPU-heavy row-local work.

    A small file is one scan task whatever its rows cost. Inputs with at least one
    full-size split per core (by the optimizer's size estimate) come back unchanged,
    so no cluster-sized table is shuffled for this.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= cores * SPLIT_BYTES:
        return df
    return df.repartition(cores, *keys)
