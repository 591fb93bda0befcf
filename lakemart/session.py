"""Session helpers: build a session, find the shared checkpoint folder, make scratch paths.

Every job keeps ANSI mode on and pins the session time zone to UTC where it builds the
session itself. The library's own time arithmetic works on ``timestamp_ntz`` values, so the
results do not depend on the caller's session time zone either.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings used when this package builds the session (tests, bench). A cluster deployment
# passes its own values through spark-submit; nothing here overrides an explicit setting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "lakemart", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session; this package's defaults fill in only what the caller, spark-submit
    and the cluster's defaults leave unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = dict(extra or {})
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    SparkContext._ensure_initialized()   # so that SparkConf sees what spark-submit was given
    submitted = SparkConf()
    for k, v in DEFAULT_CONF.items():
        if k not in given and not submitted.contains(k):
            given[k] = v
    for k, v in given.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is chosen only when nothing is configured and the master is local
    (tests); on a cluster an unset folder is an error, because a machine-local folder would
    not survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this job")
        configured = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for tables a job writes and reads back.

    Returned DataFrames read these folders lazily, so they are not removed by the library, but for those of a
    ``step_scratch``.
    """
    base = _STEP.get() or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakemart-scratch"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_STEP: ContextVar[str | None] = ContextVar("step", default=None)   # the folder of the step that runs
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def step_scratch(spark: SparkSession):
    """Scratch folders that are made inside are deleted at the end, so nothing that reads them may leave the step;
    meanwhile Spark deletes the shuffle files of each query when the query ends, not when the driver has collected
    its garbage."""
    path, before = scratch_path(spark, "step"), spark.conf.get(_CLEANUP, "false")
    outer = _STEP.set(path)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        _STEP.reset(outer)
        spark.conf.set(_CLEANUP, before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def together(*steps):
    """Run independent steps at the same time, each submitting its Spark jobs from its own thread; their results."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, s) for s in steps]]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
