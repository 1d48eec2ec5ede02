"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Safe on any session: none of these change results, only how shuffles are sized and split and how tables are packed and written
# (a task whose rows go to two or three folders, as those of the log do, keeps all open instead of sorting; with more it sorts), and that rows
# which lie sorted by their key are grouped as they come. Spark takes a file's packed bytes for the size of its rows, down to a hundredth of what a
# broadcast of them holds on the driver: what lies in files is broadcast up to a quarter of a megabyte, what a shuffle has measured up to ten.
RUNTIME_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings that results or skew handling rely on."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app_name: str = "millrace", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    partitions = str(cores) if str(cores).isdigit() else str(os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is chosen only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder the cluster already set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def together(spark: SparkSession, *actions: Callable[[], object]) -> list[object]:
    """Submit independent jobs at once, so that small ones share the executors; results in order."""
    with ThreadPoolExecutor(len(actions)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [job.result() for job in started]
