"""Session construction and shared scratch space.

Library code never creates a session; it receives one.  ``get_session`` is for
tests, the bench and the command line.  Scratch output (round-trip sinks,
saved models in checks, lineage cuts) goes below ``spark.checkpoint.dir``,
the shared folder the cluster names; a private folder is chosen only when the
session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, app: str = "tripwise", shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """A session; master, partitions and memory are those it is started with unless given here."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Generated methods above 8 KB of bytecode are never JIT-compiled by
        # HotSpot and would run interpreted; let such stages use the
        # non-fused operators instead (3-4x faster on the feature stage).
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.  Only a session on one machine gets one of its own when it is unset:
    on a cluster, executors would write where the others cannot read."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="tripwise-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


_space: ContextVar[str | None] = ContextVar("scratch_space", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the checkpoint folder, in the innermost open ``scratch_space``."""
    below = _space.get() or f"{checkpoint_root(spark).rstrip('/')}/tripwise"
    return f"{below}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[str]:
    """Scratch tables of the block go below one folder, which is deleted when the block ends or fails.

    What outlives the block has to be written, to a path from outside it: a frame that still reads scratch tables
    cannot be computed any more.  Spaces nest.  Without one, scratch is left to the cluster's own cleaning.
    """
    path = scratch_path(spark, "space")
    outer = _space.set(path)
    try:
        yield path
    finally:
        _space.reset(outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: HotSpot does not compile methods of more bytes of code; Spark would by default run them interpreted.
COMPILED = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Stages that begin in the block run operator by operator where their one generated method would be interpreted, also in
    a session that has not set ``spark.sql.codegen.hugeMethodLimit`` as ``get_session`` does.  Rows are the same."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df, *by):
    """Rows dealt over all cores, by ``by`` or one by one.  Small files and row groups read back as few tasks, however much
    is computed on each row; two tasks a core are two files a core when they are stored."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *(by or [F.monotonically_increasing_id()]))


def stored(df, name: str, path: str | None = None):
    """``df`` written once below the checkpoint folder (or at ``path``) and read back from there: one copy, no cache.
    Later jobs (a long grid search) read it, so a lost executor costs a re-read, not a re-run of the plan."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
