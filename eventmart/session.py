"""Session construction and the shared scratch area.

Every job runs with the session zone pinned to UTC (a UTC day must not split
across two partitions), AQE on (runtime partition coalescing, skew-join
splitting, broadcast conversion from real sizes) and the UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Deduplication state grows with the key space of a replay window; RocksDB
    # keeps it off-heap and checkpoints it incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "eventmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    initial_shuffle_partitions: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are left to the cluster manager when
    not given; locally tests pass ``local[*]`` and a small number.
    ``shuffle_partitions`` also fixes the state partitions of a new streaming
    checkpoint, so keep it moderate. For large batch jobs pass
    ``initial_shuffle_partitions`` of about (shuffled bytes / 128 MB): AQE
    starts every batch shuffle that wide and coalesces it down to ~128 MB
    partitions at runtime (it can merge partitions, not split them, except
    for skewed joins).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_shuffle_partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_shuffle_partitions)
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(128 * 1024 * 1024)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local
    (tests) a private folder is created and registered, so
    ``DataFrame.checkpoint()`` and every scratch table of this library land in
    the same place. A cluster session without it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application folder; its parent is the
        # shared root that was asked for.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        # a machine-local folder would not survive the loss of this host and
        # is not visible to executors elsewhere
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                           "object store) for this cluster session")
    local = tempfile.mkdtemp(prefix="eventmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/eventmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


def run_together(spark: SparkSession, calls: Sequence[Callable[[], object]], at_once: int = 8) -> list:
    """Results of independent calls, in their order; their jobs share the cluster.

    Each call's jobs run in a scheduler pool of its own, so that with
    ``spark.scheduler.mode=FAIR`` none waits for another's last stage. All calls
    end before the first failure is raised.
    """
    def in_pool(number: int, call: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"eventmart-{number % at_once}")
        return call()

    with ThreadPoolExecutor(max(1, min(at_once, len(calls)))) as pool:
        # the wrapper copies the caller's local properties (job group, description) to the thread
        started = [pool.submit(inheritable_thread_target(spark)(in_pool), i, c) for i, c in enumerate(calls)]
    return [f.result() for f in started]
